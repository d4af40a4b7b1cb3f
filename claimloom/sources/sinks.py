"""Published forms: stable JSON, Markdown tables, JSON-LD, indexes, error documents."""

from __future__ import annotations

import hashlib
import json
import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import text as tx
from claimloom.functions import values as vl

#: Predicates of claim relations and types of capsule roles.
PREDICATES = {"supports": "https://schema.org/citation", "contradicts": "http://purl.org/spar/cito/disputes", "qualifies": "http://purl.org/spar/cito/qualifies"}
ROLE_TYPES = {"code": "SoftwareSourceCode", "data": "Dataset", "environment": "SoftwareApplication", "output": "CreativeWork"}
STATUS_IRIS = {"passed": "http://schema.org/CompletedActionStatus", "failed": "http://schema.org/FailedActionStatus", "blocked": "http://schema.org/PotentialActionStatus"}


def stable_json(value) -> str:
    """Two spaces, keys as they come, a line feed at the end: the bytes that digests cover."""
    return json.dumps(value, indent=2, ensure_ascii=False) + "\n"


def digest(value) -> str:
    return hashlib.sha256((value if isinstance(value, str) else stable_json(value)).encode()).hexdigest()


def publish(value, target: str | None = None) -> None:
    """To a file, or to standard output without one; a document, never an unbounded table."""
    text = value if isinstance(value, str) else stable_json(value)
    if target is None:
        sys.stdout.write(text)
    else:
        Path(target).parent.mkdir(parents=True, exist_ok=True)
        Path(target).write_text(text, encoding="utf-8")


def fail_safe(target: str | None, make) -> bool:
    """Publish what ``make()`` gives; if it raises, a ``failed_safe`` document instead. Returns whether it went well."""
    try:
        publish(make(), target)
        return True
    except Exception as e:
        publish({"schema_version": "1.0.0", "status": "failed_safe", "error": str(e)[:500], "proposals": []}, target)
        return False


def markdown_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One ``line`` for each row, cells escaped."""
    cells = [tx.markdown_cell(c) for c in columns]
    return df.select("*", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def markdown_table(df: DataFrame, columns: list[str], order: str) -> str:
    """A whole table as text, for results of document size."""
    head = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(head + [r["line"] for r in markdown_rows(df, columns).orderBy(order).select("line").toLocalIterator()]) + "\n"


def nanopublications(claims: DataFrame, base: str, release: str) -> DataFrame:
    """A JSON-LD node for each claim; relations stand under the IRI of their predicate."""
    uri = lambda c: tx.claim_uri(F.lit(base), F.lit(release), c)
    targets = lambda p: F.transform(F.filter("relations", lambda r: r["predicate"] == p), lambda r: uri(r["target_claim_id"]))
    node = F.struct(
        uri(F.col("claim_id")).alias("@id"), F.lit("Claim").alias("@type"), F.col("claim_text").alias("text"), F.array_sort("citation_keys").alias("citation"),
        F.struct(F.col("trust.rubric_version").alias("rubricVersion"), F.col("trust.overall_score").alias("overallScore"), F.col("trust.trust_label").alias("label")).alias("assessment"),
        *[targets(p).alias(iri) for p, iri in PREDICATES.items()],
    )
    return claims.select("claim_id", F.to_json(node, {"ignoreNullFields": "false"}).alias("node"))


def crate_nodes(capsule: DataFrame, files: DataFrame) -> DataFrame:
    """Nodes of a research-object crate: descriptor, root, action and files by path, as JSON rows in order.

    ``capsule`` is one row (capsule_id, created_at, status, license, command), ``files`` (path, role, media_type, bytes, sha256).
    """
    ref = lambda c: F.struct(c.alias("@id"))
    of = lambda role: F.array_sort(F.collect_list(F.when(F.col("role") == role, F.col("path"))))
    parts = files.agg(F.array_sort(F.collect_list("path")).alias("paths"), *[of(r).alias(r) for r in ROLE_TYPES])
    head = capsule.select(F.lit(0).alias("ord"), F.lit("").alias("path"), F.to_json(F.struct(F.lit("ro-crate-metadata.json").alias("@id"), F.lit("CreativeWork").alias("@type"), ref(F.lit("./")).alias("about"))).alias("node"))
    root = capsule.crossJoin(parts).select(F.lit(1).alias("ord"), F.lit("").alias("path"), F.to_json(F.struct(F.lit("./").alias("@id"), F.lit("Dataset").alias("@type"), F.col("capsule_id").alias("identifier"), F.col("created_at").alias("datePublished"), ref(F.col("license")).alias("license"), F.transform("paths", ref).alias("hasPart"))).alias("node"))
    inputs = F.transform(F.concat("data", "environment"), ref)
    action = capsule.crossJoin(parts).select(F.lit(2).alias("ord"), F.lit("").alias("path"), F.to_json(F.struct(F.lit("#execution").alias("@id"), F.lit("CreateAction").alias("@type"), ref(vl.lookup(STATUS_IRIS, F.col("status"))).alias("actionStatus"), F.transform("code", ref).alias("instrument"), inputs.alias("object"), F.transform("output", ref).alias("result"))).alias("node"))
    each = files.select(F.lit(3).alias("ord"), "path", F.to_json(F.struct(F.col("path").alias("@id"), F.array(F.lit("File"), vl.lookup(ROLE_TYPES, F.col("role"))).alias("@type"), F.col("media_type").alias("encodingFormat"), F.col("bytes").alias("contentSize"), F.col("sha256").alias("sha256"))).alias("node"))
    return head.unionByName(root).unionByName(action).unionByName(each).orderBy("ord", "path")


def capsule_problems(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Roles without a file, and files whose digest isn't the expected one (path, expected_sha256)."""
    roles = files.sparkSession.createDataFrame([(r,) for r in ROLE_TYPES], "role string").join(files.select("role").distinct(), "role", "left_anti").select(F.concat(F.lit("no file of role "), "role").alias("problem"))
    wrong = expected.join(files.select("path", "sha256"), "path", "left").where(~F.col("sha256").eqNullSafe(F.col("expected_sha256"))).select(F.concat(F.lit("digest of "), "path").alias("problem"))
    return roles.unionByName(wrong)


def gate_document(name: str, results: DataFrame) -> dict:
    """``{gate, status, checks, failures}`` of a table (check_name, passed); checks are a fixed list."""
    rows = results.groupBy("check_name").agg(F.bool_and("passed").alias("passed")).orderBy("check_name").collect()
    failed = [r["check_name"] for r in rows if not r["passed"]]
    return {"gate": name, "status": "failed" if failed else "passed", "checks": {r["check_name"]: r["passed"] for r in rows}, "failures": failed}


def to_json_stable(x: Column) -> Column:
    return F.to_json(x, {"ignoreNullFields": "false"})


def _quoted(x: Column) -> Column:
    """A text as JSON writes it; control characters without a short form have lower-case digits."""
    out = F.to_json(F.struct(x.alias("v")))
    out = F.substr(out, F.lit(6), F.length(out) - 6)
    lowered = out
    for high in "01":
        for low in "ABCDEF":
            lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*)\\u00{high}{low}", rf"$1\\u00{high}{low.lower()}")
    return F.when(F.contains(out, F.lit("\\u00")), lowered).otherwise(out)  # few texts have such digits


def _whole_number(x: Column) -> Column:
    """A number as JSON writes it from a double: whole ones without a fraction; null where it isn't finite."""
    whole = (F.abs(x) < 1e15) & (x % 1 == 0)
    return F.when(whole, x.cast("bigint").cast("string")).when(~F.isnan(x) & (F.abs(x) != float("inf")), x.cast("string"))


def canonical_json(x: Column, kind: T.DataType, indent: int = 2, deep: int = 0) -> Column:
    """The text of :func:`stable_json` (without its last line feed) as a Column, for values of any nested type.

    Two spaces a level, members in the order of the struct's fields or the map's entries, null for null, dates and other types as
    their text. What the driver does for one document is done for each row where the row is. Doubles are written as whole numbers
    where they are whole; beyond seven digits before or after the point they may be written in another form than elsewhere.
    """
    pad, end = " " * (indent * (deep + 1)), "\n" + " " * (indent * deep)

    def block(items: Column, opening: str, closing: str) -> Column:
        joined = F.array_join(F.transform(items, lambda i: F.concat(F.lit(pad), i)), ",\n")
        return F.when(F.size(items) == 0, opening + closing).otherwise(F.concat(F.lit(opening + "\n"), joined, F.lit(end + closing)))

    inner = lambda v, t: canonical_json(v, t, indent, deep + 1)
    if isinstance(kind, T.StructType):
        members = [F.concat(F.lit(pad + json.dumps(f.name, ensure_ascii=False) + ": "), inner(x[f.name], f.dataType)) for f in kind.fields]
        text = F.concat(F.lit("{\n"), F.concat_ws(",\n", *members), F.lit(end + "}")) if members else F.lit("{}")
    elif isinstance(kind, T.ArrayType):
        text = block(F.transform(x, lambda v: inner(v, kind.elementType)), "[", "]")
    elif isinstance(kind, T.MapType):
        text = block(F.transform(F.map_entries(x), lambda e: F.concat(_quoted(e["key"].cast("string")), F.lit(": "), inner(e["value"], kind.valueType))), "{", "}")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        text = x.cast("string")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = _whole_number(x.cast("double"))
    else:
        text = _quoted(x.cast("string"))
    return F.when(x.isNull(), "null").otherwise(F.coalesce(text, F.lit("null")))


def canonical_digest(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``df`` with the SHA-256 of each row's canonical JSON document of ``columns``, which is :func:`digest` of the same document."""
    kinds = {f.name: f for f in df.schema.fields}
    text = canonical_json(F.struct(*columns), T.StructType([kinds[c] for c in columns]))
    return df.withColumn(name, F.sha2(F.concat(text, F.lit("\n")), 256))
