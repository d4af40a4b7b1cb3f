"""Packing of token sequences into windows, by non-negative least squares.

A document's first full windows stand alone. The remainders make a histogram over
lengths below the window (its size is fixed, whatever the data). Shallow length
combinations that fill a window exactly are enumerated, repeat counts that best give
the histogram are solved with x >= 0, rounded down and held to what there is; the
residual documents are laid end to end and cut where a window fills. Only the last
sequence has padding.

Which document takes which place needs its rank among those of its length. Ranks are
taken within hash buckets of stored row numbers, and buckets follow one another, so a
length, an id or a text that a third of all rows share is still dealt to all buckets.

Pairs are enumerated from all lengths, triples with two of the ``top`` most frequent ones,
quadruples with three of the ``deep`` most frequent ones. Lengths outside any combination
lose nothing: what isn't in a filled window is a residual.

Defined results: null or empty text is the end id alone; a very long text is cut into full
windows and a remainder; rows of one length are placed in the order of (id, length, ids);
empty table, no pieces; repeated rows are packed each, null or repeated ids too; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import input_parts, map_blocks, release, stored

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def combinations(lengths: list[int], counts: np.ndarray, window: int, top: int = 48, deep: int = 12) -> list[tuple[int, ...]]:
    """Multisets of two to four present lengths that sum to the window."""
    there = set(lengths)
    out = {(a, window - a) for a in lengths if 2 * a <= window and window - a in there}
    frequent = sorted(lengths, key=lambda a: (-counts[a], a))
    for parts, most in ((2, top), (3, deep)):
        for some in itertools.combinations_with_replacement(sorted(frequent[:most]), parts):
            if window - sum(some) in there:
                out.add(tuple(sorted((*some, window - sum(some)))))
    return sorted(out)


def nnls(columns: list[dict[int, int]], target: np.ndarray, rounds: int = 60) -> np.ndarray:
    """argmin |A x - target|, x >= 0, by cyclic coordinate descent over sparse columns."""
    x = np.zeros(len(columns))
    left = target.astype(float).copy()
    sparse = [(np.fromiter(c, int), np.fromiter(c.values(), float)) for c in columns]
    norms = [float(v @ v) for _, v in sparse]
    for _ in range(rounds):
        moved = 0.0
        for j, (rows, values) in enumerate(sparse):
            step = max(-x[j], float(values @ left[rows]) / norms[j])
            if step:
                x[j] += step
                left[rows] -= step * values
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(histogram: np.ndarray, window: int):
    """From counts of remainder lengths: slots for each length, and where its residual documents begin.

    Returns ``(slots, assigned, residual_start, first_residual, total)``; ``slots[l]`` has arrays
    (first rank, repeats' first sequence, offset) and the end rank; sequences count from 0.
    """
    lengths = [int(a) for a in np.flatnonzero(histogram) if 0 < a < window]
    combos = combinations(lengths, histogram, window)
    columns = []
    for combo in combos:
        column: dict[int, int] = {}
        for a in combo:
            column[a] = column.get(a, 0) + 1
        columns.append(column)
    left = histogram.astype(np.int64).copy()
    slots: dict[int, list[tuple[int, int, int]]] = {a: [] for a in lengths}
    taken = {a: 0 for a in lengths}
    sequence = 0
    for combo, column, x in zip(combos, columns, nnls(columns, histogram)):
        repeats = min([int(x + 1e-6), *(int(left[a]) // m for a, m in column.items())])
        if repeats <= 0:
            continue
        at = 0
        for a in combo:
            slots[a].append((taken[a], sequence, at))
            taken[a] += repeats
            left[a] -= repeats
            at += a
        sequence += repeats
    residual_start, position = {}, 0
    for a in lengths:
        residual_start[a] = position
        position += a * int(left[a])
    return slots, taken, residual_start, sequence, sequence + -(-position // window)


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece; its columns are :data:`PIECES`. ``offset`` is the place in its sequence."""

    def coded(block: pa.Table) -> pa.Table:
        encoder = bpe.load(tokenizer)
        starts, ids = encoder.encode(block["text"])
        n = len(block)
        ended = np.insert(ids, starts[1:], end_id).astype("<u2" if encoder.dtype == np.uint16 else "<u4")
        bounds = (starts + np.arange(n + 1)) * ended.itemsize
        body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(ended.tobytes())])
        return pa.table({"doc_id": block["doc_id"], "n": pa.array(np.diff(starts) + 1), "width": pa.array(np.full(n, ended.itemsize, np.int32)), "ids": body})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = input_parts(docs, 16)
    coded_rows = map_blocks(rows, coded, "doc_id bigint, n bigint, width int, ids binary", limit=3 << 20).withColumn("row", F.monotonically_increasing_id())
    coded_rows = stored(coded_rows, "ids").withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")).drop("row")
    counts = stored(coded_rows.groupBy("bucket", (F.col("n") % window).alias("rest")).agg(F.count("*").alias("n"), F.sum(F.floor(F.col("n") / window)).alias("full")), "lengths")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).where("rest > 0").collect():
        histogram[r["rest"]] = r["n"]
    slots, taken, residual_start, residual_first, used = plan(histogram, window)
    slot_arrays = {a: tuple(np.array(s, np.int64).reshape(-1, 3).T) for a, s in slots.items()}

    by_length = counts.selectExpr("bucket", "rest", "sum(n) over (partition by rest order by bucket rows between unbounded preceding and 1 preceding) as before", "cast(0 as bigint) as full_before")
    full = counts.groupBy("bucket").agg(F.sum("full").alias("full")).selectExpr("bucket", "cast(-1 as bigint) as rest", "cast(0 as bigint) as before", "sum(full) over (order by bucket rows between unbounded preceding and 1 preceding) as full_before")
    before = by_length.unionByName(full).fillna(0, ["before", "full_before"])

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        base = dict(zip(right["rest"].to_pylist(), right["before"].to_pylist()))
        next_full = sum(right["full_before"].to_pylist()) + used
        out: list[tuple[int, ...]] = []
        rank: dict[int, int] = {}
        entries = sorted(zip(left["doc_id"].to_pylist(), left["n"].to_pylist(), left["width"].to_pylist(), left["ids"].to_pylist()), key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))
        for doc, n, width, raw in entries:
            ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
            pieces = []
            whole = n // window
            for k in range(whole):
                pieces.append((k * window, window, next_full, 0))
                next_full += 1
            rest = n % window
            if rest:
                mine = base[rest] + rank.get(rest, 0)
                rank[rest] = rank.get(rest, 0) + 1
                at = whole * window
                if mine < taken[rest]:
                    first, sequence, offset = slot_arrays[rest]
                    j = int(np.searchsorted(first, mine, "right")) - 1
                    pieces.append((at, rest, int(sequence[j]) + mine - int(first[j]), int(offset[j])))
                else:
                    where = residual_start[rest] + (mine - taken[rest]) * rest
                    while rest:
                        length = min(rest, window - where % window)
                        pieces.append((at, length, residual_first + where // window, where % window))
                        at, where, rest = at + length, where + length, rest - length
            out += [(doc, s, m, zlib.crc32(ids[s : s + m].tobytes()), n, q, o) for s, m, q, o in pieces]
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(names))], names=names)

    # a task for each bucket, so that a task's share doesn't grow with the input
    dealt = coded_rows.repartitionById(buckets, F.col("bucket")).groupBy("bucket").cogroup(before.repartitionById(buckets, F.col("bucket")).groupBy("bucket"))
    return dealt.applyInArrow(place, PIECES)
