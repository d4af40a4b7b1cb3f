"""Benchmark decontamination with one Aho-Corasick automaton over normalised item windows.

Items (questions and answers) and documents are normalised alike: A-Z lower-cased, words
of ASCII letters, digits and anything beyond ASCII, joined by single spaces. A window is
``width`` consecutive words of an item, or the whole item if it has fewer. All windows go
into one automaton; each text is scanned once, and hits are mapped back to offsets (code
points) in the original text.

The item table is a test suite, whose size doesn't grow with the documents. It is measured
all the same: windows are a stored table, and where they have more than ``most_chars``
characters in all, they are dealt by their hash to groups of about that size. One group after
the other is brought to the driver, sent to the workers and dropped again, so that neither
ever holds more than one group; hit words of all groups are then united for each row.

Defined results: null text or item has no words; very long texts are scanned whole, one to a
block; empty tables give no hits; an item repeated under one id counts once, an item without
id marks words but is no item found; equal windows of several items count for each; repeated
rows each get a row, null or repeated ids too; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import map_blocks, stored

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal(text: str | None) -> str:
    return b" ".join((text or "").encode().translate(words.ALNUM).split()).decode()


def windows(items: list[tuple[str, str | None]], width: int) -> dict[str, tuple[int, set[str]]]:
    """Window text -> (its number of words, the items that have it)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        ws = normal(text).split(" ") if normal(text) else []
        for i in range(max(1, len(ws) - width + 1) if ws else 0):
            part = ws[i : i + width]
            found.setdefault(" ".join(part), (len(part), set()))[1].add(item)
    return found


_WINDOW = "text string, n int, item string"


def window_rows(items: DataFrame, width: int, item_col: str, item_text: str) -> DataFrame:
    """``(text, n, item)``: the distinct windows of all items, with their numbers of words."""

    def read(block: pa.Table) -> pa.Table:
        rows = [(text, n, item) for pair in zip(block["item"].to_pylist(), block["text"].to_pylist()) for text, (n, who) in windows([pair], width).items() for item in who]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int32(), pa.string()))], names=["text", "n", "item"])

    named = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    return stored(map_blocks(named, read, _WINDOW).distinct(), "windows")


_built: dict[str, object] = {}


def automaton(key: str, group: list[tuple[str, int, tuple[str, ...]]]):
    """The group's automaton, built once for each worker process, which keeps one at a time; a pattern holds a space at both ends, so that only whole words match."""
    import ahocorasick

    if key not in _built:
        _built.clear()
        built = ahocorasick.Automaton()
        for text, n, items in group:
            built.add_word(f" {text} ", (n, items))
        built.make_automaton()
        _built[key] = built if group else None
    return _built[key]


_HIT = "struct<first:bigint,last:bigint,start:bigint,end:bigint>"
_SCANNED = f"row bigint, doc_id bigint, n_words bigint, items array<string>, hits array<{_HIT}>"


def _scan(rows: DataFrame, group: list[tuple[str, int, tuple[str, ...]]]) -> DataFrame:
    """Each row's words, the items found and runs of hit words (first, last exclusive, start, end) of one group of windows."""
    sent = rows.sparkSession.sparkContext.broadcast(group)
    key = uuid.uuid4().hex

    def scan(block: pa.Table) -> pa.Table:
        found = automaton(key, sent.value)
        n_words, names, hits = [], [], []
        for original in block["text"].to_pylist():
            text = normal(original)
            total = text.count(" ") + 1 if text else 0
            joined = f" {text} "
            who: set[str] = set()
            marks: list[tuple[int, int]] = []
            for end, (n, of) in found.iter(joined) if found else ():
                who.update(of)
                marks.append((end, n))
            n_words.append(total)
            names.append(sorted(who))
            if not marks:
                hits.append([])
                continue
            gaps = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), "<u4") == 32)
            change = np.zeros(total + 1, np.int64)
            for end, n in marks:
                last = int(np.searchsorted(gaps, end))
                change[last - n] += 1
                change[last] -= 1
            hit = (np.cumsum(change[:-1]) > 0).astype(np.int8)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
            places = [m.span() for m in _WORD.finditer(original)]
            hits.append([{"first": a, "last": b, "start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))
        return pa.table({"row": block["row"], "doc_id": block["doc_id"], "n_words": pa.array(n_words, pa.int64()), "items": pa.array(names, pa.list_(pa.string())), "hits": pa.array(hits, kind)})

    return map_blocks(rows, scan, _SCANNED)


def _united(hits) -> Column:
    """Overlapping or adjoining runs of sorted hits made one."""
    first = F.array().cast(f"array<{_HIT}>")

    def add(acc: Column, h: Column) -> Column:
        top = F.element_at(acc, -1)
        wider = h["last"] > top["last"]
        joined = F.struct(top["first"].alias("first"), F.greatest(top["last"], h["last"]).alias("last"), top["start"].alias("start"), F.when(wider, h["end"]).otherwise(top["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["last"] >= h["first"]), F.array_append(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), joined)).otherwise(F.array_append(acc, h))

    return F.aggregate(F.array_sort(hits), first, add)


def find_items(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most_chars: int = 8 << 20) -> DataFrame:
    """For each document its words, hit words, the items with an occurring window and the hit spans."""
    every = window_rows(items, width, item_col, item_text)
    chars = every.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    groups = max(1, -(-chars // most_chars))
    of_group = F.pmod(F.xxhash64("text"), F.lit(groups))

    def group(k: int) -> list[tuple[str, int, tuple[str, ...]]]:
        rows = every.where(of_group == k).groupBy("text", "n").agg(F.array_sort(F.collect_set("item")).alias("items"))
        return [(r["text"], r["n"], tuple(r["items"])) for r in rows.toLocalIterator()]

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if groups == 1:
        found = _scan(rows.withColumn("row", F.lit(0).cast("bigint")), group(0))
    else:  # rows get stored numbers, by which the groups' hits come together
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
        parts = [stored(_scan(rows, group(k)).where(F.lit(k == 0) | (F.size("hits") > 0)), "hits") for k in range(groups)]
        one = parts[0]
        for part in parts[1:]:
            one = one.unionByName(part)
        of_row = one.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("hits")).alias("hits"))
        found = of_row.withColumn("hits", F.when(F.size("hits") > 0, _united(F.col("hits"))).otherwise(F.col("hits")))
    spans = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda acc, h: acc + h["last"] - h["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`find_items`."""
    names = F.array_join("items", ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

