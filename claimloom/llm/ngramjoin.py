"""Near-duplicate classes: an exact Jaccard join of word shingles by parity sketches.

A document's sketch has ``p`` words of 64 bits; each shingle XORs its hash into one of
them. So the number of words in which two sketches differ is at most the size of the sets'
symmetric difference, which for Jaccard J >= 0.8 is at most d = (|A|+|B|) / 9. Sizes fall
into bands of a factor two with one p > d for each; a set is also entered in the next band
where a larger partner may lie there. By the pigeonhole principle a linked pair agrees in
at least p - d words, and agreeing words are found by an equi-join on (band, word number,
word). A second sketch of 512 single bits, whose Hamming distance is bounded alike, and
then the sets themselves verify the candidates.

Skew: equal sets are one node, merged within a block of texts before anything is shuffled.
Words are ordered by the number of sets that share them. A set may leave out its
p - d - 1 most shared words (and empty ones): of the p - d that a linked pair has in common,
the least shared one is then still entered by both. So passages found in many documents
lead to no pairs. Within the runs of equal words that are left, members are first compared
with one hub, the member found in most runs, and only members whose classes still differ
matter from there on. Sets left in runs of more than ``LIGHT`` members, those of large
groups of near copies, are entered again with four times as many, smaller words, which
parts sets that differ by more than d. Pairs of differing classes left in small runs are
then compared one by one; those in larger runs block against block by their bit sketches,
so that only pairs that may link become rows.

A word that very many sets share would fill one worker with its bucket. Buckets of more than
``HOT`` entries are therefore dealt to chunks by node, which count their keys apart; the keys'
totals then go back to each chunk, so that no worker holds a bucket's members. Joins on the
runs' keys deal large runs to several tasks.

Rows without an id take part through their text, as bridges too: texts of nodes are found again by
a hash of the text, not by the id. A class of rows without ids alone has no id.

Exactness: links are verified on the sets' 64-bit shingle hashes. Nodes are 64-bit digests of
sets, and sets of one digest count as equal: among n distinct sets about n^2 / 2^65 pairs are
expected to agree by chance, 0.03 pairs at 10^9 sets and 3 at 10^10. Two differing shingles of
a pair of sets have one hash with a chance of 2^-64 for each pair of shingles.

Defined results: null, empty or blank text has no shingles, links with nothing and is its
own class; fewer than five words make one shingle; very long texts are read whole, one to a
block; repeated rows, and repeated ids, are rows each, in the class of their own text; empty
table, empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words
from .common import drop_stored, input_parts, map_blocks, reclaim, release, stored
from .graph import components
from .lm import deflate, inflate

WIDTH, LIGHT, BITS = 5, 8, 512
#: Sketch words of the second level for each one of the first.
FINER = 4
#: Members of a large run that are compared with as many others at once.
BLOCK_MEMBERS = 1024
#: Rows of a run that one task joins; larger runs are dealt to several.
RUN_ROWS = 1024
#: Entries (key, node) of a bucket that one worker holds; larger buckets are dealt to chunks.
HOT = 4 << 20
#: Hashes (8 bytes each) that may be broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_SKETCH = [f"s{i}" for i in range(BITS // 64)]
_BLOB = "kind int, bucket int, a binary, b binary, c binary, doc_id bigint, tid bigint, n bigint, sid bigint, room0 bigint, room1 bigint, " + ", ".join(f"{s} bigint" for s in _SKETCH)
_TYPES = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _BLOB.split(", ")])


def sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    starts, codes, uniques = words.split(texts, words.LOWER)
    h = words.hashes(uniques)[codes]
    n = np.diff(starts)
    step = np.uint64(0x9E3779B97F4A7C15)
    grams = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):
        grams = grams * step + h[j : len(h) - width + 1 + j] if len(grams) else grams
    grams = words.mix(grams + np.uint64(width))
    out = []
    for i, m in zip(starts.tolist(), n.tolist()):
        if m >= width:
            out.append(np.unique(grams[i : i + m - width + 1]))
        elif m:
            whole = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in h[i : i + m]:
                    whole = whole * step + x
            out.append(words.mix(np.array([whole + np.uint64(m << 32)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band_of(size: int) -> int:
    return size.bit_length() - 1


def parts_of(band: int, finer: int = 1) -> int:
    """p of a band, whose larger sets have up to 2^(band+1) - 1 elements: the largest d, one more, and some to spare."""
    d = 2 * ((2 << band) - 1) // 9
    return finer * (d + 1 + (1 + math.ceil(0.1 * d) if d else 0))


def keys_of(members: np.ndarray, band: int, finer: int = 1) -> tuple[np.ndarray, int]:
    """Join keys of a set's sketch words in a band, and how many more of them it may leave out.

    Empty words are left out where the set can do without them.
    """
    p = parts_of(band, finer)
    part = ((members >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    part, member = part[order], members[order]
    edges = np.flatnonzero(np.diff(part, prepend=np.uint64(p)))
    word = np.zeros(p, np.uint64)
    if len(member):
        word[part[edges].astype(np.int64)] = np.bitwise_xor.reduceat(member, edges)
    s = len(members)
    larger = min(s * 5 // 4, (2 << band) - 1)
    room = p - (s + larger) // 9 - 1
    number = np.arange(p, dtype=np.uint64)
    full = np.zeros(p, bool)
    full[part[edges].astype(np.int64)] = True
    empty = p - int(full.sum())
    if empty <= room:
        word, number, room = word[full], number[full], room - empty
    else:
        room = 0
    keys = words.mix(word + words.mix(number * np.uint64(64) + np.uint64(band)))
    return (keys >> np.uint64(6)) | np.uint64(band << 58), room


def sketch(members: np.ndarray) -> np.ndarray:
    bits = (np.bincount((members & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def digest(members: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).astype(np.int64))


def packed(key: np.ndarray, owner: np.ndarray) -> dict[str, bytes]:
    """Sorted keys and the nodes that hold them, as three compact columns."""
    nodes, local = np.unique(owner, return_inverse=True)
    return {"a": deflate(np.diff(key, prepend=np.uint64(0))), "b": deflate(local.astype("<u4")), "c": nodes.tobytes()}


def unpacked(a: bytes, b: bytes, c: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(inflate(a, "<u8"), dtype=np.uint64), np.frombuffer(c, np.int64)[inflate(b, "<u4")]


def read_block(table: pa.Table, buckets: int, finer: int = 1) -> pa.Table:
    """Kind 0: one row for each document; kind 1: a block's join keys for one bucket."""
    docs: dict[str, list] = {f.name: [] for f in _ARROW}
    known: dict[int, tuple] = {}
    keys, owners = [], []
    for doc, tid, members in zip(table["doc_id"].to_pylist(), table["tid"].to_pylist(), sets(table["text"])):
        s = len(members)
        sid = digest(members)
        if sid not in known:
            rooms = [0, 0]
            if s:
                band = band_of(s)
                for k, b in enumerate([band] + [band + 1] * (band_of(max(1, s * 5 // 4)) > band)):
                    own, rooms[k] = keys_of(members, b, finer)
                    keys.append(own)
                    owners.append(np.full(len(own), sid, np.int64))
            known[sid] = (*rooms, *sketch(members).tolist())
        for name, value in zip(("kind", "doc_id", "tid", "n", "sid", "room0", "room1", *_SKETCH), (0, doc, tid, s, sid, *known[sid])):
            docs[name].append(value)
    n = len(docs["kind"])
    tables = [pa.table([pa.array(docs[f.name] if docs[f.name] else [None] * n, f.type) for f in _ARROW], schema=_ARROW)]
    if keys:
        key, owner = np.concatenate(keys), np.concatenate(owners)
        bucket = (key & np.uint64(buckets - 1)).astype(np.int64)
        order = np.lexsort((key, bucket))
        key, owner, bucket = key[order], owner[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        blobs = []
        for k in np.flatnonzero(np.diff(edges)):
            part = slice(edges[k], edges[k + 1])
            blobs.append({"kind": 1, "bucket": int(k), "n": len(key[part]), **packed(key[part], owner[part])})
        tables.append(pa.Table.from_pylist(blobs, _ARROW))
    return pa.concat_tables(tables)


RUNS = "key bigint, sid bigint, size bigint, band int"


def _entries(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (key, node) of a group, in order."""
    release()
    parts = [unpacked(*x) for x in zip(*(group[c].to_pylist() for c in "abc"))]
    key, node = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    return key[first], node[first]


def _rows(key: np.ndarray, node: np.ndarray, size: np.ndarray) -> pa.Table:
    return pa.table({"key": pa.array(key.view(np.int64)), "sid": pa.array(node), "size": pa.array(size, pa.int64()), "band": pa.array((key >> np.uint64(58)).astype(np.int32))})


def runs(group: pa.Table) -> pa.Table:
    """Of a bucket's keys, those that two or more nodes share."""
    key, node = _entries(group)
    _, where, size = np.unique(key, return_inverse=True, return_counts=True)
    keep = size[where] > 1
    return _rows(key[keep], node[keep], size[where][keep])


def hot_runs(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """:func:`runs` of the buckets in ``hot`` (bucket, chunks), no worker holding more than a chunk's entries and the keys' counts.

    A node is wholly in one chunk, so that chunks' counts add up.
    """

    def deal(batches):
        for batch in batches:
            for r in batch.to_pylist():
                key, owner = unpacked(r["a"], r["b"], r["c"])
                chunk = (words.mix(owner.view(np.uint64)) % np.uint64(r["chunks"])).astype(np.int64)
                found = [{"bucket": r["bucket"], "chunk": int(k), **packed(key[chunk == k], owner[chunk == k])} for k in np.unique(chunk)]
                yield pa.RecordBatch.from_pylist(found, pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *((c, pa.binary()) for c in "abc")]))

    def count(key, group):
        keys, n = np.unique(_entries(group)[0], return_counts=True)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([deflate(np.diff(keys, prepend=np.uint64(0)))]), "counts": pa.array([deflate(n.astype("<u8"))])})

    def total(key, group):
        keys, where = np.unique(np.concatenate([np.cumsum(inflate(x, "<u8"), dtype=np.uint64) for x in group["keys"].to_pylist()]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([inflate(x, "<u8") for x in group["counts"].to_pylist()])).astype("<u8")
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([deflate(np.diff(keys[n > 1], prepend=np.uint64(0)))]), "counts": pa.array([deflate(n[n > 1])])})

    def members(left, right):
        if not len(left):
            return _rows(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        key, node = _entries(left)
        keys, n = np.cumsum(inflate(right["keys"][0].as_py(), "<u8"), dtype=np.uint64), inflate(right["counts"][0].as_py(), "<u8")
        at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        keep = keys[at] == key if len(keys) else np.zeros(len(key), bool)
        return _rows(key[keep], node[keep], n[at[keep]].astype(np.int64) if len(keys) else np.zeros(0, np.int64))

    blobs = "keys binary, counts binary"
    dealt = stored(rows.join(hot, "bucket").mapInArrow(deal, "bucket int, chunk int, a binary, b binary, c binary"), "chunks")
    totals = stored(dealt.groupBy("bucket", "chunk").applyInArrow(count, f"bucket int, {blobs}").groupBy("bucket").applyInArrow(total, f"bucket int, {blobs}"), "totals")
    sent = totals.join(hot, "bucket").select("bucket", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "keys", "counts")
    return dealt.groupBy("bucket", "chunk").cogroup(sent.groupBy("bucket", "chunk")).applyInArrow(members, RUNS)


def with_key(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows of runs (key, sid, size) with the one row of their key in ``keyed`` (key, size); rows whose key has none go."""
    salts = F.ceil(F.col("size") / RUN_ROWS).cast("int")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("sid"), salts).cast("int"))
    return dealt.join(keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("size"), ["key", "salt"]).drop("salt")


def entered(rows: DataFrame, buckets: int, finer: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents ``(doc_id, n, sid)``, nodes, and the runs' rows ``(key, sid, weight, size)`` that count.

    ``weight`` is the number of runs that a node is in, ``size`` the number of members that a run keeps.
    """
    read = stored(map_blocks(rows, lambda t: read_block(t, buckets, finer), _BLOB, limit=4 << 20), "sketches")
    listed = read.where("kind = 0").select("doc_id", "tid", "n", "sid", "room0", "room1", *_SKETCH)
    blobs = read.where("kind = 1").select("bucket", "a", "b", "c")
    hot = stored(read.where("kind = 1").groupBy("bucket").agg(F.ceil(F.sum("n") / HOT).cast("int").alias("chunks")).where("chunks > 1"), "hot")
    is_hot = bool(hot.head(1))
    run = (blobs.join(hot, "bucket", "left_anti") if is_hot else blobs).repartitionById(buckets, F.col("bucket")).groupBy("bucket").applyInArrow(runs, RUNS)
    run = stored(run.unionByName(hot_runs(blobs, hot)) if is_hot else run, "runs")
    nodes = stored(listed.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first_doc"), F.min("tid").alias("tid"), *[F.first(c).alias(c) for c in ("n", "room0", "room1", *_SKETCH)]), "nodes")
    listed = stored(listed.select("doc_id", "n", "sid"), "documents")
    drop_stored(read)
    reclaim(run)
    own_band = F.floor(F.log2("n") + 1e-9).cast("int")
    room = F.when(F.col("band") == own_band, F.col("room0")).otherwise(F.col("room1"))
    of_node = Window.partitionBy("sid")
    ranked = (
        run.join(nodes.select("sid", "n", "room0", "room1"), "sid")
        .withColumn("weight", F.count("*").over(of_node))
        .withColumn("place", F.row_number().over(Window.partitionBy("sid", "band").orderBy(F.desc("size"), "key")))
        .where(F.col("place") > room)
        .select("key", "sid", "weight", "size")
    )
    ranked = stored(ranked, "ranked")
    shared = ranked.groupBy("key").agg(F.first("size").alias("size"), F.count("*").alias("left")).where("left > 1")
    kept = stored(with_key(ranked, shared).select("key", "sid", "weight", F.col("left").alias("size")), "kept")
    drop_stored(run)
    drop_stored(ranked)
    return listed, nodes, kept


def picked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``tid`` is in ``ids``: broadcast only after their number is known."""
    ids = stored(ids.distinct(), "picked")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "tid", "left_semi")


def _verified(pairs: DataFrame, nodes: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that link: first by sizes and bit sketches, then by the sets."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("sid").alias(side), F.col("n").alias(f"n_{side}"), *[F.col(s).alias(f"{s}_{side}") for s in _SKETCH]), side)
    differ = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in _SKETCH), F.lit(0))
    total, low, high = F.col("n_a") + F.col("n_b"), F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    pairs = pairs.where((low * 100 >= high * percent) & (differ * (100 + percent) <= total * (100 - percent))).select("a", "b", "n_a", "n_b")
    for side in "ab":
        pairs = pairs.join(members.select(F.col("sid").alias(side), F.col("members").alias(f"m_{side}")), side)

    def check(block: pa.Table) -> pa.Table:
        keep = []
        for a, b, na, nb in zip(*(block[c].to_pylist() for c in ("m_a", "m_b", "n_a", "n_b"))):
            both = len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
            keep.append(100 * both >= percent * (na + nb - both))
        return block.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_blocks(pairs, check, "a bigint, b bigint", column="m_a")


class _Classes:
    """Links found so far and the classes that they make."""

    def __init__(self, nodes: DataFrame, members: DataFrame, percent: int):
        self.nodes, self.members, self.percent = nodes, members, percent
        self.links = nodes.sparkSession.createDataFrame([], "a bigint, b bigint")
        self.label = nodes.sparkSession.createDataFrame([], "sid bigint, label bigint")

    def add(self, pairs: DataFrame) -> None:
        found = _verified(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), self.nodes, self.members, self.percent)
        self.links = stored(self.links.unionByName(found), "links")
        self.label = stored(components(self.links).withColumnRenamed("node", "sid"), "labels")
        reclaim(self.label)

    def mixed(self, kept: DataFrame) -> DataFrame:
        """Rows of the runs in which classes still differ."""
        rows = kept.select("key", "sid", "weight", "size").join(self.label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
        keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.first("size").alias("size")).where("low <> high").select("key", "size")
        return stored(with_key(rows, keys), "mixed")

    def meet_hubs(self, rows: DataFrame) -> None:
        """Compare each run's members with the member that is in most runs."""
        hub = rows.groupBy("key").agg(F.max_by(F.struct(F.col("sid").alias("y"), F.col("label").alias("of")), F.struct("weight", "sid")).alias("h"), F.first("size").alias("size")).select("key", "size", "h.*")
        self.add(with_key(rows, hub).where("label <> of").select(F.col("sid").alias("x"), "y"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Pairs of a run's members whose classes differ; for runs of ``LIGHT`` members at most."""
    return rows.alias("l").join(rows.alias("r"), F.expr("l.key = r.key and l.label < r.label")).select(F.col("l.sid").alias("x"), F.col("r.sid").alias("y"))


def near(label_a, n_a, bits_a, label_b, n_b, bits_b, percent: int) -> np.ndarray:
    """Which pairs of two blocks differ in class and may link by sizes and bit sketches."""
    differ = np.bitwise_count(bits_a[:, None, :] ^ bits_b[None, :, :]).sum(2, dtype=np.int64)
    low, high = np.minimum(n_a[:, None], n_b[None, :]), np.maximum(n_a[:, None], n_b[None, :])
    return (label_a[:, None] != label_b[None, :]) & (low * 100 >= high * percent) & (differ * (100 + percent) <= (low + high) * (100 - percent))


def _close_pairs(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of larger runs that sizes and bit sketches leave, found block against block: no pair is a row before it passed."""
    blocks = F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    dealt = rows.join(nodes.select("sid", "n", *_SKETCH), "sid").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "sid", "label", "n", *_SKETCH)

    def compare(group: pa.Table) -> pa.Table:
        column = lambda c: group[c].to_numpy()
        own, sid, label, n = (column(c) for c in ("own", "sid", "label", "n"))
        bits = np.stack([column(c) for c in _SKETCH], 1).view(np.uint64)
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        a, b = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        x, y = [], []
        for at in range(0, len(a), 64):
            part = a[at : at + 64]
            i, j = np.nonzero(near(label[part], n[part], bits[part], label[b], n[b], bits[b], percent))
            x.append(sid[part[i]])
            y.append(sid[b[j]])
        x, y = np.concatenate(x or [sid[:0]]), np.concatenate(y or [sid[:0]])
        found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pa.table({"x": pa.array(found[:, 0], pa.int64()), "y": pa.array(found[:, 1], pa.int64())})

    return dealt.groupBy("key", "lo", "hi").applyInArrow(compare, "x bigint, y bigint")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; linked are sets with Jaccard >= percent / 100 (80: the bounds above)."""
    if percent != 80:
        raise ValueError("the bands' bounds are those of a similarity of 0.8")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tid", F.xxhash64("text"))
    buckets = 1 << max(3, math.ceil(math.log2(input_parts(docs))))
    listed, nodes, kept = entered(rows, buckets)

    def collect(block: pa.Table) -> pa.Table:
        found = sets(block["text"])
        return pa.table({"sid": pa.array([digest(m) for m in found], pa.int64()), "members": pa.array([m.astype("<u8").tobytes() for m in found], pa.binary())})

    texts_of = lambda sids: sids.select("sid").distinct().join(nodes.select("sid", "tid"), "sid").select("tid")
    members = stored(map_blocks(picked(rows, texts_of(kept)), collect, "sid bigint, members binary").dropDuplicates(["sid"]), "members")
    classes = _Classes(nodes, members, percent)
    left = classes.mixed(kept)
    classes.meet_hubs(left)
    left = classes.mixed(left)
    rest = _pairs(left.where(F.col("size") <= LIGHT))
    crowded = left.where(F.col("size") > LIGHT)
    if crowded.head(1):
        _, _, finer = entered(picked(rows, texts_of(crowded)), buckets, FINER)
        finer = classes.mixed(finer)
        rest = rest.unionByName(_pairs(finer.where(F.col("size") <= LIGHT))).unionByName(_close_pairs(finer.where(F.col("size") > LIGHT), nodes, percent))
    classes.add(rest)

    root = nodes.select("sid", "first_doc").join(classes.label, "sid", "left").select("sid", "first_doc", F.coalesce("label", "sid").alias("label"))
    least = root.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    found = root.join(least, "label").select("sid", "component_id")
    return listed.join(found, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
