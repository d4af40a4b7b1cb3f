"""Bigram language model by deleted interpolation.

P(w|h) = l2(b) c(h,w)/c(h) + l1(b) c(w)/N + l0(b)/(V+1), where the weights depend on the
bucket b = floor(log2(c(h))) of the context's frequency (one more bucket for unseen
contexts). The weights are learned by expectation-maximisation: one fold of the learning
texts is deleted from the counts, and its tokens are the held-out counts that weigh the
estimates from the rest. Scoring then uses the counts of all learning texts.

Counts cover the whole corpus. Texts are taken in blocks of bounded bytes; a block sends
its distinct words and pairs as sorted 64-bit hashes with counts (so a word or text that
fills the corpus is one entry for each block), range buckets of hashes add them up, and
each block gets its totals back in the order it sent them. No count reaches the driver:
it sees N, V and the histogram of estimates that EM needs, which has a fixed size.

A block sends to ``FAN`` ranges at most. Where the input needs more buckets, what some
``UNIT_BLOCKS`` blocks sent to one range is merged first, and the merged unit sends to finer
buckets; totals come back the same two steps. So no message shrinks to single entries as
blocks and buckets grow with the input.

Texts are read where they are stored (others are stored first), and blocks are numbered by
their task: a task that is run again after an executor was lost sends the same messages.
Ranges, units and blocks are dealt to tasks evenly by their numbers.

Hashes: counts of words, N, V and ``base_score`` rest on 64-bit hashes of words. A pair's hash
is made of its words' leading ``SHORT`` bits and has :func:`pair_bits` bits. Of 10^9 distinct
words about 4 in 10^6 share their leading bits with another, whose pairs then count as one.

Tokens: A-Z lower-cased, words between ASCII white space, then one end token. Defined
results: null text is the end token alone; a very long text is a block of its own; empty
table, empty result; with nothing to learn from every score is 0. Rows repeated are scored
each, and counted each, null or repeated ids too (a null id has the checksum of the empty
text); other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import doc_fold, input_bytes, input_parts, map_blocks, release, scanned, stored

END, START = np.uint64(0x5EED5EED00000001), np.uint64(0x5EED5EED00000002)
BLOCK = 6 << 20
#: Ranges that a block sends to; a power of two.
FAN = 4096
#: Blocks whose entries of one range are merged before they go to finer buckets.
UNIT_BLOCKS = 2048
#: Leading bits of a word's hash of which pair hashes are made.
SHORT = 48
#: A task's blocks have numbers this far apart (a prime, more than the tasks of a scan).
STRIDE = (1 << 31) - 1
#: Multiples of 2^-24 (of the golden and the plastic number) by which blocks are dealt to tasks evenly.
TURN, STEP, ONE = 10368890, 12664746, 1 << 24
#: EM sees estimates on a grid of half powers of two; cell 0 is probability zero.
GRID, BUCKETS = 160, 66
_ROW = "dest int, kind int, block bigint, bucket int, a binary, b binary, c binary, d binary, x bigint, y bigint"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_TYPES = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _ROW.split(", ")])
UNIGRAM, BIGRAM, TEXTS, HELD, TOTALS = range(5)


def deflate(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: small values cost little whatever their type."""
    values = np.ascontiguousarray(values)
    head = np.array([values.itemsize, len(values)], "<i8").tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def inflate(raw: bytes, dtype) -> np.ndarray:
    size, n = np.frombuffer(raw[:16], "<i8")
    body = zstandard.ZstdDecompressor().decompress(raw[16:], max_output_size=max(1, int(size * n)))
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(int(size), int(n)).T).view(dtype).reshape(-1)


def small(counts: np.ndarray) -> np.ndarray:
    return counts.astype("<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8")


def pair_bits(input_bytes: int) -> int:
    """Bits of a pair's hash: so many that below one pair in 100,000 shares its hash by chance, at a pair for each 8 bytes of input."""
    return min(64, max(40, (input_bytes // 8).bit_length() + 17))


def short(hashes: np.ndarray) -> np.ndarray:
    """The leading bits of word hashes, of which pair hashes are made."""
    return hashes >> np.uint64(64 - SHORT)


def ranks(prev: np.ndarray, now: np.ndarray, shorts: np.ndarray, bits: int):
    """Sorted hashes of distinct pairs, and for each token the rank of its pair."""
    pairs, where = np.unique(prev * len(shorts) + now, return_inverse=True)
    a, b = np.divmod(pairs, len(shorts))
    h = words.mix(shorts[a] * np.uint64(0x9E3779B97F4A7C15) + shorts[b]) >> np.uint64(64 - bits)
    order = np.argsort(h, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return h[order], rank[where]


def sequences(lengths: np.ndarray, codes: np.ndarray, end: int, start: int):
    """Tokens with ends, and each token's predecessor."""
    stops = np.cumsum(lengths)
    now = np.insert(codes, stops, end)
    prev = np.empty_like(now)
    prev[1:] = now[:-1]
    prev[np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(int)] = start
    return prev, now


def order_of(shorts: np.ndarray):
    """The order in which a block's words are sent; words whose leading bits agree stay in the order of their codes."""
    order = np.argsort(shorts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return order, rank


def block_numbers() -> Callable[[], int]:
    """Numbers of a task's blocks: the task's own and every ``STRIDE``-th after it, so that a task that runs again gives them again."""
    seen = {"attempt": None, "at": 0}

    def number() -> int:
        task = TaskContext.get()
        if seen["attempt"] != task.taskAttemptId():
            seen.update(attempt=task.taskAttemptId(), at=0)
        seen["at"] += 1
        return task.partitionId() + (seen["at"] - 1) * STRIDE

    return number


def home(block: int, parts: int) -> int:
    """The task of ``parts`` that a block's own rows go to; tasks of a scan and their blocks fall evenly, which hashes wouldn't."""
    return (block % STRIDE * TURN + block // STRIDE * STEP) % ONE * parts // ONE


def homes(df: DataFrame, parts: int):
    """Groups of blocks, each at its :func:`home`: one exchange."""
    task = F.expr(f"cast((block % {STRIDE} * {TURN} + block div {STRIDE} * {STEP}) % {ONE} * {parts} div {ONE} as int)")
    return df.withColumn("task", task).repartitionById(parts, F.col("task")).groupBy("task", "block")


def read_block(table: pa.Table, block: int, buckets: int, bits: int, parts: int) -> pa.Table:
    """Count one block of texts; column ``part`` is 0 for texts to learn from, 1 for EM's held-out part of them, 2 for others."""
    ids, folds = table["doc_id"], table["part"].to_numpy()
    starts, codes, uniques = words.split(table["text"], words.LOWER)
    hashes = np.concatenate([words.hashes(uniques), [END, START]]).astype(np.uint64)
    end, start = len(hashes) - 2, len(hashes) - 1
    lengths = np.diff(starts)
    prev, now = sequences(lengths, codes, end, start)
    token_fold = np.repeat(folds, lengths + 1)
    kept, deleted = token_fold == 0, token_fold == 1
    out: list[dict] = []

    def send(kind: int, h: np.ndarray, width: int, a: np.ndarray, b: np.ndarray) -> None:
        bucket = (h >> np.uint64(width - (buckets - 1).bit_length())).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)):
            part = slice(edges[k], edges[k + 1])
            out.append({"dest": kind * buckets + int(k), "kind": kind, "block": block, "bucket": int(k), "a": deflate(np.diff(h[part], prepend=np.uint64(0))), "b": deflate(small(a[part])), "c": deflate(small(b[part]))})

    order, rank = order_of(short(hashes))
    one = lambda mask: np.bincount(rank[now[mask]], minlength=len(order))
    a, b = one(kept), one(deleted)
    a[rank[start]], b[rank[start]] = int((folds == 0).sum()), int((folds == 1).sum())
    send(UNIGRAM, hashes[order], 64, a, b)
    pair_hashes, pair = ranks(prev, now, short(hashes), bits)
    send(BIGRAM, pair_hashes, bits, np.bincount(pair[kept], minlength=len(pair_hashes)), np.bincount(pair[deleted], minlength=len(pair_hashes)))
    own = 2 * buckets + home(block, parts)  # a block's texts needn't meet others
    docs = pa.table({"doc_id": ids, "part": table["part"]}).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as w:
        w.write_table(docs)
    out.append({"dest": own, "kind": TEXTS, "block": block, "a": sink.getvalue().to_pybytes(), "b": deflate(lengths), "c": deflate(codes.astype("<u4")), "d": short(hashes).view(np.uint8).reshape(-1, 8)[:, : SHORT // 8].tobytes()})
    if deleted.any():  # each distinct pair once, with its number of deleted tokens
        pairs, first, times = np.unique(pair[deleted], return_index=True, return_counts=True)
        out.append({"dest": own, "kind": HELD, "block": block, "a": deflate(rank[prev[deleted][first]].astype("<u4")), "b": deflate(rank[now[deleted][first]].astype("<u4")), "c": deflate(pairs.astype("<u4")), "d": deflate(times.astype("<u4"))})
    return pa.Table.from_pylist(out, _ARROW)


def _read(rows: list[dict], name: str) -> np.ndarray:
    parts = [inflate(r[name], "<u4" if np.frombuffer(r[name][:8], "<i8")[0] == 4 else "<u8") for r in rows]
    return np.concatenate([x.astype(np.int64) for x in parts] or [np.zeros(0, np.int64)])


def _summed(rows: list[dict]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each row's hashes, all distinct ones, the places of the former among the latter, and the distinct ones' kept and deleted counts."""
    hashes = [np.cumsum(inflate(r["a"], "<u8"), dtype=np.uint64) for r in rows]
    distinct, where = np.unique(np.concatenate(hashes), return_inverse=True)
    kept, deleted = (np.bincount(where, weights=_read(rows, c)).astype(np.int64) for c in "bc")
    return hashes, distinct, where, kept, deleted


def add_up(group: pa.Table) -> pa.Table:
    """Totals of a bucket's hashes, handed back to each sender; texts pass through."""
    release()
    rows = group.to_pylist()
    if rows[0]["kind"] >= TEXTS:
        return group
    hashes, distinct, where, kept, deleted = _summed(rows)
    total = kept + deleted
    out, at = [], 0
    for r, h in zip(rows, hashes):
        mine = where[at : at + len(h)]
        at += len(h)
        out.append({"kind": r["kind"], "block": r["block"], "bucket": r["bucket"], "a": deflate(small(kept[mine])), "b": deflate(small(total[mine]))})
    if rows[0]["kind"] == UNIGRAM:
        word = distinct != START
        for name, counts in enumerate((kept[word], total[word])):
            out.append({"kind": TOTALS, "bucket": name, "x": int(counts.sum()), "y": int((counts > 0).sum())})
    return pa.Table.from_pylist(out, _ARROW)


def merged(buckets: int, bits: int):
    """What a unit's blocks sent to one range, made one message for each of ``buckets`` finer buckets."""

    def merge(group: pa.Table) -> pa.Table:
        release()
        rows = group.to_pylist()
        kind = rows[0]["kind"]
        _, distinct, _, kept, deleted = _summed(rows)
        width = 64 if kind == UNIGRAM else bits
        bucket = (distinct >> np.uint64(width - (buckets - 1).bit_length())).astype(np.int64)
        out = []
        for k in np.unique(bucket):
            part = slice(*np.searchsorted(bucket, (k, k + 1)))
            out.append({"dest": kind * buckets + int(k), "kind": kind, "block": rows[0]["unit"], "bucket": int(k), "a": deflate(np.diff(distinct[part], prepend=np.uint64(0))), "b": deflate(small(kept[part])), "c": deflate(small(deleted[part]))})
        return pa.Table.from_pylist(out, _ARROW)

    return merge


def give_back(left, right):
    """A unit's totals, handed on to the blocks that it was merged from."""
    release()
    rows = left.to_pylist()
    if not rows:
        return pa.Table.from_pylist([], _ARROW)
    hashes, _, where, _, _ = _summed(rows)
    told = sorted(right.to_pylist(), key=lambda r: r["bucket"])
    kept, total = _read(told, "a"), _read(told, "b")
    out, at = [], 0
    for r, h in zip(rows, hashes):
        mine = where[at : at + len(h)]
        at += len(h)
        out.append({"kind": r["kind"], "block": r["block"], "bucket": r["bucket"], "a": deflate(small(kept[mine])), "b": deflate(small(total[mine]))})
    return pa.Table.from_pylist(out, _ARROW)


def totalled(sent: DataFrame, buckets: int, bits: int, parts: int) -> DataFrame:
    """Blocks' messages answered with the corpus's totals, by way of units where there are more than ``FAN`` buckets."""
    if buckets <= FAN:
        return sent.repartitionById(parts, F.col("dest")).groupBy("dest").applyInArrow(add_up, _ROW)
    sent = stored(sent, "sent")
    counts = sent.where(F.col("kind") <= BIGRAM)
    units = max(1, counts.select("block").distinct().count() // UNIT_BLOCKS)
    counts = counts.withColumn("unit", F.col("dest").cast("bigint") * units + F.pmod(F.xxhash64("block"), F.lit(units)))
    in_turn = lambda df: df.withColumn("task", F.pmod("unit", F.lit(parts)).cast("int")).repartitionById(parts, F.col("task")).groupBy("task", "unit")
    finer = in_turn(counts).applyInArrow(merged(buckets, bits), _ROW)
    told = stored(finer.repartitionById(parts, F.col("dest")).groupBy("dest").applyInArrow(add_up, _ROW), "units")
    of_unit = told.where(F.col("kind") <= BIGRAM).withColumnRenamed("block", "unit")
    back = in_turn(counts).cogroup(in_turn(of_unit)).applyInArrow(give_back, _ROW)
    return back.unionByName(told.where(F.col("kind") == TOTALS)).unionByName(sent.where(F.col("kind") >= TEXTS))


def _totals(rows: list[dict], column: str) -> tuple[np.ndarray, np.ndarray]:
    """A block's counts of words and of pairs, in its own order."""
    of = lambda kind: sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
    return _read(of(UNIGRAM), column), _read(of(BIGRAM), column)


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(int) + 1, 0)


def cell(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(np.round(-2 * np.log2(np.maximum(p, 1e-300))) + 1, 1, GRID - 1).astype(int), 0)


def held_out_cells(n: int):
    """Histogram over (context bucket, cell of the pair estimate, cell of the word estimate) of a block's deleted tokens."""

    def count(group: pa.Table) -> pa.Table:
        release()
        rows = group.to_pylist()
        word, pair = _totals(rows, "a")
        cells = times = np.zeros(0, np.int64)
        for r in rows:
            if r["kind"] == HELD:
                prev, now, both, times = (inflate(r[k], "<u4").astype(np.int64) for k in "abcd")
                context = word[prev]
                p2 = pair[both] / np.maximum(context, 1)
                cells = (bucket_of(context) * GRID + cell(p2)) * GRID + cell(word[now] / max(n, 1))
        at, where = np.unique(cells, return_inverse=True)
        counts = np.bincount(where, weights=times, minlength=len(at)).astype(np.int64)
        return pa.table({"cell": pa.array(at, pa.int64()), "n": pa.array(counts, pa.int64())})

    return count


def expectation_maximisation(cells: dict[int, int], vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Weights ``[bucket, order]``; one pseudo-token for each order keeps every weight above zero."""
    value = np.concatenate([[0.0], 2.0 ** (-(np.arange(1, GRID) - 1) / 2)])
    at = np.array(sorted(cells), np.int64)
    n = np.array([cells[c] for c in at.tolist()], float)
    bucket, p2, p1 = at // GRID**2, value[at // GRID % GRID], value[at % GRID]
    weights = np.full((BUCKETS, 3), 1 / 3)
    estimates = np.stack([np.full(len(at), 1 / (vocabulary + 1)), p1, p2], 1) if len(at) else np.zeros((0, 3))
    for _ in range(rounds):
        share = weights[bucket] * estimates
        share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
        found = np.ones((BUCKETS, 3))
        np.add.at(found, bucket, share)
        weights = found / found.sum(1, keepdims=True)
    for b in range(1, BUCKETS):  # buckets without held-out tokens take the next lower one's
        if not (bucket == b).any() and b > 1:
            weights[b] = weights[b - 1]
    return weights


def score_block(weights: np.ndarray, n: int, v: int, bits: int):
    def score(group: pa.Table) -> pa.Table:
        release()
        rows = group.to_pylist()
        word, pair = _totals(rows, "b")
        tables = []
        for r in rows:
            if r["kind"] != TEXTS:
                continue
            docs = pa.ipc.open_stream(r["a"]).read_all()
            lengths, codes = inflate(r["b"], "<i8"), inflate(r["c"], "<u4").astype(np.int64)
            wide = np.zeros((len(r["d"]) * 8 // SHORT, 8), np.uint8)
            wide[:, : SHORT // 8] = np.frombuffer(r["d"], np.uint8).reshape(-1, SHORT // 8)
            shorts = wide.view("<u8").reshape(-1)
            prev, now = sequences(lengths, codes, len(shorts) - 2, len(shorts) - 1)
            _, rank = order_of(shorts)
            _, both = ranks(prev, now, shorts, bits)
            count, context = word[rank[now]], word[rank[prev]]
            w = np.where((context > 0)[:, None], 1, [1, 1, 0]) * weights[bucket_of(context)]
            if not n:
                w = w * [1, 0, 0]
            w = w / w.sum(1, keepdims=True)
            p = w[:, 0] / (v + 1) + w[:, 1] * count / max(n, 1) + w[:, 2] * pair[both] / np.maximum(context, 1)
            doc = np.repeat(np.arange(len(lengths)), lengths + 1)
            add = lambda x: np.bincount(doc, weights=x, minlength=len(lengths))
            tables.append(pa.table({
                "doc_id": docs["doc_id"], "held_out": pa.array(docs["part"].to_numpy() == 2), "n_tokens": pa.array(lengths + 1, pa.int64()), "n_known": pa.array(add(count > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(lengths), n, np.int64)), "base_score": pa.array(add(np.log10((count + 1) / (n + v + 1)))), "score": pa.array(add(np.log10(p))),
            }))
        return pa.concat_tables(tables)

    return score


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, learn_not: int = 2, held: int = 3) -> DataFrame:
    """Scores of every text; texts whose fold is ``learn_not`` aren't learned from.

    Fold ``held`` is EM's held-out part.
    """
    parts, buckets = input_parts(docs, 16), 1 << max(3, math.ceil(math.log2(input_parts(docs, 4))))
    bits = pair_bits(input_bytes(docs))
    fold = doc_fold(folds)
    part = F.when(fold == learn_not, 2).when(fold == held, 1).otherwise(0)
    rows = scanned(docs.select(id_col, text_col), "texts").select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("part", part.cast("int"))
    number = block_numbers()
    sent = map_blocks(rows, lambda t: read_block(t, number(), min(buckets, FAN), bits, parts), _ROW, limit=BLOCK)
    counted = stored(totalled(sent, buckets, bits, parts), "lm")
    totals = {r["bucket"]: (r["n"], r["v"]) for r in counted.where(F.col("kind") == TOTALS).groupBy("bucket").agg(F.sum("x").alias("n"), F.sum("y").alias("v")).collect()}
    (kept_n, kept_v), (n, v) = totals.get(0, (0, 0)), totals.get(1, (0, 0))
    counts = counted.where(F.col("kind") <= BIGRAM)
    estimates = homes(counts.unionByName(counted.where(F.col("kind") == HELD)).select(*_NAMES[1:8]), parts).applyInArrow(held_out_cells(kept_n), "cell bigint, n bigint")
    cells = {r["cell"]: r["n"] for r in estimates.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    weights = expectation_maximisation(cells, kept_v)
    result = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    texts = counted.where(F.col("kind") == TEXTS)
    return homes(counts.unionByName(texts).select(*_NAMES[1:8]), parts).applyInArrow(score_block(weights, n, v, bits), result)
