"""JSON, BibTeX, Markdown and small YAML documents as tables."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.sources.files import binary

MOST_BYTES = 10 * 1024 * 1024


class UnsafePath(ValueError):
    """A path outside the folder it was to be in, or of another kind than asked for."""


def json_documents(spark: SparkSession, path, schema: str, fail_fast: bool = False) -> DataFrame:
    """Whole JSON documents; ones that don't parse are kept in ``_corrupt_record``, or raise with ``fail_fast``."""
    reader = spark.read.option("multiLine", True)
    if fail_fast:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    return reader.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def bounded_text(spark: SparkSession, path, most: int = MOST_BYTES) -> DataFrame:
    """``(path, text)`` of files, none over the bound: a larger one raises before any is read as text."""
    files = binary(spark, path)
    large = files.where(F.col("length") > most).select("path", "length").head(1)
    if large:
        raise ValueError(f"{large[0]['path']} has {large[0]['length']} bytes; {most} are allowed")
    return files.select("path", F.decode("content", "UTF-8").alias("text"))


def confined(root: str, name: str) -> str:
    """The real path of a regular ``.json`` file inside ``root``."""
    base, target = Path(root).resolve(), (Path(root) / name).resolve()
    if not target.is_relative_to(base) or target.suffix != ".json" or not target.is_file():
        raise UnsafePath(name)
    return str(target)


def submissions_envelope(spark: SparkSession, path: str, schema: str, version: str = "1.0.0") -> DataFrame:
    """Rows of ``{schema_version, submissions: [...]}``; another version or a repeated revision raises."""
    envelope = json_documents(spark, path, f"schema_version string, submissions array<struct<{_struct(schema)}>>", fail_fast=True)
    if envelope.where(~F.col("schema_version").eqNullSafe(F.lit(version))).head(1):
        raise ValueError(f"schema_version must be {version}")
    rows = envelope.select(F.explode("submissions").alias("s")).select("s.*")
    if rows.groupBy("submission_id", "revision").count().where("count > 1").head(1):
        raise ValueError("a submission revision stands twice")
    return rows


def _struct(ddl: str) -> str:
    """``a int, b string`` as the inside of a struct type: ``a:int,b:string``."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = ddl[start:i].strip().split(None, 1)
            out.append(f"{name}:{kind}")
            start = i + 1
    return ",".join(out)


def bibliography(texts: DataFrame, column: str = "text") -> DataFrame:
    """``(cite_key, doi, authors)`` of BibTeX; of entries with one key the last counts.

    A file is cut before each line that begins with an at sign; an entry's head is what stands before its first comma, and
    its fields begin where a name is followed by an equals sign.
    """
    cut = F.filter(F.split(column, r"(?m)^(?=[ \t]*@)"), lambda e: F.ltrim(e).startswith("@") & F.contains(e, F.lit("{")) & F.contains(e, F.lit(",")))
    entries = texts.select(F.posexplode(cut).alias("ord", "entry"))
    key = F.trim(F.substring_index(F.substring_index("entry", ",", 1), "{", -1))
    field = lambda name: F.regexp_extract("entry", rf"""(?i)\b{name}\s*=\s*(?:\{{((?:[^{{}}\n]|\{{[^{{}}\n]*\}})*)\}}|"([^"\n]*)")""", 0)
    inner = lambda f: F.trim(F.regexp_replace(F.regexp_replace(f, r"(?s)^[^=]*=\s*", ""), r"""^[{"]|[}"]$""", ""))
    doi = F.nullif(F.lower(F.trim(inner(field("doi")))), F.lit(""))
    authors = F.split(inner(field("author")), r"(?i)\s+and\s+")
    rows = entries.select("ord", key.alias("cite_key"), doi.alias("doi"), F.filter(F.transform(authors, tx.collapse), lambda a: a != "").alias("authors")).where("cite_key <> ''")
    return rows.groupBy("cite_key").agg(F.max_by(F.struct("doi", "authors"), "ord").alias("e")).select("cite_key", "e.*")


#: Names of the page directives that aren't prose.
DIRECTIVES = r"(?sm):::\{(?:trust-claim|human-reviews|authorship-explorer|evidence-explorer)\}.*?^:::\s*$"


def paragraphs(texts: DataFrame, file: str = "file", column: str = "text") -> DataFrame:
    """``(file, paragraph_index, text)``: prose only, numbered from 1 without directives, anchors, headings and emphasised captions."""
    parts = F.transform(F.split(F.regexp_replace(column, DIRECTIVES, ""), r"\r?\n\s*\r?\n"), lambda v: F.trim(v))
    prose = F.filter(parts, lambda p: (p != "") & ~p.rlike(r"^(?:\([^\n]+\)=|#{1,6}\s|\*[^\n]+\*$)"))
    bare = texts.select(F.col(file).alias("file"), tx.nfkc_each(F.transform(prose, tx.strip_inline_markdown)).alias("texts"))
    kept = F.filter(F.transform("texts", tx.collapse), lambda v: v != "")
    return bare.select("file", F.posexplode(kept).alias("i", "text")).select("file", (F.col("i") + 1).alias("paragraph_index"), "text")


def directives(texts: DataFrame, name: str = "trust-claim", file: str = "file", column: str = "text") -> DataFrame:
    """``(file, ord, options)`` of each ``:::{name}`` block; of options with one key the last counts."""
    blocks = F.regexp_extract_all(column, F.lit(rf"(?sm):::\{{{name}\}}\s*\r?\n(.*?)^:::\s*$"), F.lit(1))
    rows = texts.select(F.col(file).alias("file"), F.posexplode(blocks).alias("ord", "block"))
    lines = rows.select("file", "ord", F.posexplode_outer(F.split("block", r"\r?\n")).alias("line_no", "line"))
    option = r"(?i)^:([a-z0-9-]+):\s*(.*?)\s*$"
    keyed = lines.select("file", "ord", "line_no", F.regexp_extract("line", option, 1).alias("k"), tx.unquoted(F.regexp_extract("line", option, 2)).alias("v"))
    last = keyed.groupBy("file", "ord", "k").agg(F.max_by("v", "line_no").alias("v"))
    named = F.filter(F.collect_list(F.struct("k", "v")), lambda e: e["k"] != "")
    return last.groupBy("file", "ord").agg(F.map_from_entries(F.array_sort(named)).alias("options"))


def headings(texts: DataFrame, file: str = "file", column: str = "text") -> DataFrame:
    """``(file, heading_id, title, level)``."""
    lines = texts.select(F.col(file).alias("file"), F.explode(F.split(column, r"\r?\n")).alias("line")).where(F.col("line").rlike(r"^#{1,6}\s"))
    title = F.trim(F.regexp_replace("line", r"^#{1,6}\s+", ""))
    return lines.select("file", tx.stable_token(title, "section").alias("heading_id"), title.alias("title"), F.length(F.regexp_extract("line", "^#+", 0)).alias("level"))


def has_figures(texts: DataFrame, file: str = "file", column: str = "text") -> DataFrame:
    return texts.select(F.col(file).alias("file"), F.col(column).rlike(r"!\[[^\]]*\]\([^)]+\)|:::\{figure\}|```\{figure\}").alias("has_figures"))


def sections(spark: SparkSession, folder: str, schema: str, names: list[str]) -> DataFrame:
    """Section packages under any of the accepted name forms, the first form winning; ``{n}`` stands for the section's number.

    Whatever sections there are, are read; missing ones aren't an error.
    """
    rows = None
    for rank, form in enumerate(names):
        pattern = form.replace("{n}", "*")
        if not any(Path(folder).glob(pattern)):
            continue
        number = form.split("{n}")[0]
        read = json_documents(spark, os.path.join(folder, pattern), schema).withColumn("_file", F.input_file_name())
        read = read.withColumn("section", F.regexp_extract("_file", rf"{number}0*(\d+)", 1).cast("int")).withColumn("_rank", F.lit(rank))
        rows = read if rows is None else rows.unionByName(read)
    if rows is None:
        return spark.createDataFrame([], f"{schema}, _corrupt_record string, section int")
    first = F.row_number().over(Window.partitionBy("section").orderBy("_rank"))
    return rows.withColumn("_n", first).where("_n = 1").drop("_n", "_rank", "_file")


def numbered_texts(spark: SparkSession, pattern: str) -> DataFrame:
    """``(file, section, text)`` of whole files whose names begin with a number, such as ``content/[0-9][0-9]_*.md``."""
    rows = spark.read.text(pattern, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col("value").alias("text"))
    return rows.select("file", F.regexp_extract("file", r"^(\d+)", 1).try_cast("int").alias("section"), "text").where("section is not null")


def knowledge(rows: DataFrame, records: DataFrame, key: str = "claim_id") -> DataFrame:
    """Rows with the record that their key names; a missing one is null."""
    known = records.select(key, F.struct(*records.columns).alias("record"))
    return rows.join(known, key, "left")


# --- the small YAML subset of contributor files (a dimension of a few hundred lines, read on the driver) --------


def small_yaml(text: str):
    """Mappings, lists, quoted and plain scalars by indentation; anchors, tags and flow mappings aren't part of it."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]
    value, at = _block(lines, 0, lines[0][0] if lines else 0)
    if at != len(lines):
        raise ValueError(f"unexpected indentation: {lines[at][1]}")
    return value


def _scalar(raw: str):
    raw = raw.strip()
    if len(raw) >= 2 and raw[0] == raw[-1] and raw[0] in "\"'":
        return raw[1:-1]
    if raw.startswith("[") and raw.endswith("]"):
        return [_scalar(x) for x in raw[1:-1].split(",") if x.strip()]
    return {"true": True, "false": False, "null": None, "~": None, "": None}.get(raw.lower(), int(raw) if raw.lstrip("-").isdigit() else raw)


def _block(lines: list[tuple[int, str]], at: int, depth: int):
    if at < len(lines) and lines[at][1].startswith("- "):
        out: list = []
        while at < len(lines) and lines[at][0] == depth and lines[at][1].startswith("-"):
            rest = lines[at][1][1:].lstrip()
            inner = depth + len(lines[at][1]) - len(rest)
            if ":" in rest and not rest.startswith(("'", '"')) and (rest.endswith(":") or ": " in rest):
                lines[at] = (inner, rest)
                value, at = _block(lines, at, inner)
            else:
                value, at = _scalar(rest), at + 1
            out.append(value)
        return out, at
    found: dict = {}
    while at < len(lines) and lines[at][0] == depth and not lines[at][1].startswith("- "):
        key, _, rest = lines[at][1].partition(":")
        at += 1
        if rest.strip():
            found[key.strip()] = _scalar(rest)
        elif at < len(lines) and (lines[at][0] > depth or lines[at][0] == depth and lines[at][1].startswith("- ")):
            found[key.strip()], at = _block(lines, at, lines[at][0])
        else:
            found[key.strip()] = None
    return found, at
