"""Exact top-k by inner product: a ball tree in each shard, searched by branch and bound.

Components become the integers floor(scale * x), so scores are exact. Rows are dealt to cells
by the nearest of ``cells`` pivot rows (a bounded sample; any choice gives the same results),
and a cell's rows to shards by a hash of their id, so that a shard lies together in space and
its size is bounded, whatever is equal among vectors; each shard builds a ball tree. Queries
come in blocks, likewise by cells. A block first searches a shard of its own cell. Its queries'
kth scores are then held against the roots of all other shards, whose centres and radii are
read in pages; vectors are joined only for the pairs of block and shard in which some query's
upper bound reaches its kth score. In a shard, nodes are taken in the order of their upper
bounds q.c + |q| r, a node is opened only for queries whose kth score doesn't exceed its bound,
and the kth scores rise from leaf to leaf. Only shards' survivors are shuffled for the final
ranking.

Defined results: vectors that are null, hold a null or a non-finite component, or have no
id take no part; vectors of different lengths are not compared; rows that repeat an id count
once (the smallest vector), and an id is no candidate of its own query; ties go to the
smaller id; scores beyond 64 bits are held to that range; fewer than k candidates give all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

LEAF = 128
#: Roots of shards that one row holds.
PAGE = 4096
#: Rows for each pivot, at least.
PIVOT_ROWS = 1024
_PACKED = "dim int, part int, ids binary, vectors binary, bounds binary, centre binary, radius double, reach double"
_SHIFT = 1 << 20
FOUND = "query_id bigint, vec_id bigint, score bigint"


def _matrix(table: pa.Table, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their integer vectors; of rows with one id the smallest vector stays."""
    ids = table["vec_id"].to_numpy()
    x = np.floor(table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), dim) * scale)
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], x[first]


def _narrow(x: np.ndarray) -> bytes:
    kind = "<i2" if not x.size or np.abs(x).max() < 1 << 15 else "<f8"
    return kind.encode() + x.astype(kind).tobytes()


def _wide(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw[3:], raw[:3].decode()).astype(np.float64).reshape(n, dim)


class BallTree:
    """Nodes over a permutation of the rows; ``left[i] < 0`` marks a leaf."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.order = np.arange(len(ids))
        self.lo, self.hi, self.left, self.right, self.centre, self.radius = [], [], [], [], [], []
        self._split(x, 0, len(ids))
        for lo, hi, left in zip(self.lo, self.hi, self.left):
            if left < 0:
                self.order[lo:hi] = np.sort(self.order[lo:hi])  # by id, as the rows are
        self.ids, self.x = ids[self.order], x[self.order]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _split(self, x: np.ndarray, lo: int, hi: int) -> int:
        node = len(self.lo)
        own = x[self.order[lo:hi]]
        centre = own.mean(0)
        distance = np.sqrt(((own - centre) ** 2).sum(1))
        self.lo.append(lo)
        self.hi.append(hi)
        self.left.append(-1)
        self.right.append(-1)
        self.centre.append(centre)
        self.radius.append(distance.max() * (1 + 1e-9) + 1e-6)
        if hi - lo > LEAF:
            one = own[distance.argmax()]
            two = own[((own - one) ** 2).sum(1).argmax()]
            middle = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argsort(own @ (two - one), kind="stable")]
            self.left[node] = self._split(x, lo, lo + middle)
            self.right[node] = self._split(x, lo + middle, hi)
        return node

    def search(self, ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids ``[query, k]``, best first, of rows that reach the bounds; unfilled places score -inf."""
        top = np.full((len(q), k), -np.inf)
        who = np.full((len(q), k), np.iinfo(np.int64).max)
        kth = bounds.astype(float).copy()
        norm = np.sqrt((q**2).sum(1))
        largest = np.abs(q).max(initial=0) * np.abs(self.x).max(initial=0) * max(1, q.shape[1])
        exact = largest < 2**53
        slack = 1e-3 + 1e-9 * norm * np.sqrt((self.x**2).sum(1)).max(initial=0)
        upper = q @ self.centre.T + norm[:, None] * self.radius + slack[:, None]
        stack = [0]
        while stack:
            node = stack.pop()
            active = np.flatnonzero(upper[:, node] >= kth)
            if not len(active):
                continue
            if self.left[node] >= 0:
                pair = (self.left[node], self.right[node])
                stack += sorted(pair, key=lambda c: upper[active, c].mean())  # the better one is taken next
                continue
            rows = slice(self.lo[node], self.hi[node])
            if exact:
                scores = q[active] @ self.x[rows].T
            else:
                ints = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
                scores = np.clip(ints(q[active]) @ ints(self.x[rows]).T, -(2**63), 2**63 - 1024).astype(float)
            scores = np.where(self.ids[rows] == ids[active, None], -np.inf, scores)
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            all_scores = np.concatenate([top[active], np.take_along_axis(scores, best, 1)], 1)
            all_ids = np.concatenate([who[active], self.ids[rows][best]], 1)
            chosen = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            top[active], who[active] = np.take_along_axis(all_scores, chosen, 1), np.take_along_axis(all_ids, chosen, 1)
            kth[active] = np.maximum(kth[active], top[active, k - 1])
        return top, who


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Pairs of a shard and a query block, taken one by one; a shard's tree is built once for the pairs that follow one another."""

    def run(batches):
        held: tuple = (None, None)
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["dim"], r["part"])
                if held[0] != key:
                    rows = np.frombuffer(r["ids"], np.int64)
                    held = (key, BallTree(rows, _wide(r["vectors"], len(rows), r["dim"])))
                ids = np.frombuffer(r["q_ids"], np.int64)
                bounds = np.frombuffer(r["q_bounds"], np.float64)
                scores, who = held[1].search(ids, _wide(r["q_vectors"], len(ids), r["dim"]), bounds, k)
                good = (scores > -np.inf) & (scores >= bounds[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, good.sum(1))), pa.array(who[good]), pa.array(scores[good].astype(np.int64))], names=["query_id", "vec_id", "score"])

    conf = pairs.sparkSession.conf
    before = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # a row holds a whole shard
    try:
        return stored(pairs.mapInArrow(run, FOUND), "found")
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def _cells(df: DataFrame, pivots: dict[int, np.ndarray], scale: int) -> DataFrame:
    """``df`` (vec_id, dim, vector, ...) with the number of the nearest pivot; vectors of another length than any pivot's are in cell 0."""
    sent = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                centres = sent.value.get(int(dim))
                if centres is None or not dim:
                    continue
                at = np.flatnonzero(dims == dim)
                flat = batch.column("vector").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                x = np.clip(np.floor(flat.astype(np.float64) * scale), -1e100, 1e100).reshape(len(at), dim)
                cell[at] = ((centres**2).sum(1)[None, :] - 2 * (x @ centres.T)).argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return df.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", cell int")


def _pages(trees: DataFrame) -> DataFrame:
    """Roots of shards, ``PAGE`` of them to a row."""
    heads = trees.select("dim", "part", "centre", "radius", "reach")
    number = F.floor((F.row_number().over(Window.partitionBy("dim", F.pmod(F.xxhash64("part"), F.lit(64))).orderBy("part")) - 1) / PAGE)
    paged = heads.withColumn("page", F.concat_ws("/", F.pmod(F.xxhash64("part"), F.lit(64)).cast("string"), number.cast("string")))
    return paged.groupBy("dim", "page").agg(F.collect_list(F.struct("part", "centre", "radius", "reach")).alias("heads"))


def _open(pairs: DataFrame) -> DataFrame:
    """``(dim, block, part)`` of shards in which a query of the block may have a candidate that reaches its kth score."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                bounds = np.frombuffer(r["q_bounds"], np.float64)
                q = _wide(r["q_vectors"], len(bounds), r["dim"])
                centres = np.stack([np.frombuffer(h["centre"], np.float64) for h in r["heads"]])
                radius, reach = (np.array([h[c] for h in r["heads"]]) for c in ("radius", "reach"))
                norm = np.sqrt((q**2).sum(1))[:, None]
                upper = q @ centres.T + norm * radius + 1e-3 + 1e-9 * norm * reach
                hit = ((upper >= bounds[:, None]) | ~np.isfinite(upper)).any(0)
                parts = [h["part"] for h, ok in zip(r["heads"], hit) if ok and h["part"] != r["own"]]
                yield pa.RecordBatch.from_arrays([pa.array([r["dim"]] * len(parts), pa.int32()), pa.array([r["block"]] * len(parts), pa.int32()), pa.array(parts, pa.int32())], names=["dim", "block", "part"])

    return pairs.mapInArrow(run, "dim int, block int, part int")


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 16384, block_rows: int = 1024, cells: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its k best rows of ``vectors``."""

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("dim", F.size("vector"))

    def once(rows: DataFrame) -> DataFrame:
        """Of rows with one id (and length) the smallest integer vector; only ids are moved to find out which repeat."""
        repeated = stored(rows.groupBy("vec_id", "dim").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
        if not repeated.head(1):
            return rows
        key = F.transform("vector", lambda x: F.floor(x * scale))
        least = rows.join(repeated, ["vec_id", "dim"], "left_semi").groupBy("vec_id", "dim").agg(F.min_by("vector", key).alias("vector"))
        return rows.join(repeated, ["vec_id", "dim"], "left_anti").unionByName(least)

    def packed(df: DataFrame, bounds: bool) -> DataFrame:
        def pack(key, table):
            dim, part = key[0].as_py(), key[1].as_py()
            ids, x = _matrix(table, dim, scale)
            least = b""
            if bounds:
                of = dict(zip(table["vec_id"].to_pylist(), table["bound"].to_pylist()))
                least = np.array([of[i] for i in ids.tolist()], np.float64).tobytes()
            centre = x.mean(0)
            radius = float(np.sqrt(((x - centre) ** 2).sum(1)).max() * (1 + 1e-9) + 1e-6)
            reach = float(np.sqrt((x**2).sum(1)).max())
            return pa.table({"dim": pa.array([dim], pa.int32()), "part": pa.array([part], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([_narrow(x)], pa.binary()), "bounds": pa.array([least], pa.binary()), "centre": pa.array([centre.tobytes()], pa.binary()), "radius": pa.array([radius]), "reach": pa.array([reach])})

        return df.groupBy("dim", "part").applyInArrow(pack, _PACKED)

    def dealt(df: DataFrame, most: int, name: str) -> tuple[DataFrame, DataFrame]:
        """Rows with their part (cell and a hash's number), and the number of parts of each cell."""
        placed = stored(_cells(df, pivots, scale), name)
        of_cell = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
        part = F.col("cell") * _SHIFT + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
        return placed.join(F.broadcast(of_cell) if of_cell.count() <= 100_000 else of_cell, ["dim", "cell"]).withColumn("part", part.cast("int")).drop("cell", "parts"), of_cell

    rows, asked = once(usable(vectors)), once(usable(queries))
    wanted = max(1, min(cells, rows.count() // PIVOT_ROWS))
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("dim", "vector").collect()
    pivots = {d: np.clip(np.floor(np.array([r["vector"] for r in found if r["dim"] == d]) * scale), -1e100, 1e100) for d in {r["dim"] for r in found}}
    placed, shards = dealt(rows, shard_rows, "placed")
    trees = stored(packed(placed, False).drop("bounds"), "shards")
    blocked, _ = dealt(asked, block_rows, "queries")
    blocked = stored(blocked, "blocks")

    def blocks_of(df: DataFrame) -> DataFrame:
        blocks = packed(df, True).select("dim", F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("bounds").alias("q_bounds"))
        cell = F.floor(F.col("block") / _SHIFT).cast("int")
        home = blocks.withColumn("cell", cell).join(shards, ["dim", "cell"], "left")
        return home.withColumn("own", (F.col("cell") * _SHIFT + F.pmod(F.col("block") % _SHIFT, F.col("parts"))).cast("int")).drop("cell", "parts")

    tree = trees.select("dim", "part", "ids", "vectors")
    first = _search(blocks_of(blocked.withColumn("bound", F.lit(float("-inf")))).withColumn("part", F.col("own")).join(tree, ["dim", "part"]), k)
    bound = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound"))
    bounded = blocked.join(bound.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").fillna(float("-inf"), ["bound"])
    blocks = stored(blocks_of(bounded).withColumn("own", F.coalesce("own", F.lit(-1))), "bounded")
    conf = rows.sparkSession.conf
    before = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # a row holds a block and a page
    try:
        opened = stored(_open(blocks.select("dim", "block", "own", "q_vectors", "q_bounds").join(_pages(trees), "dim")), "opened")
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    second = _search(opened.join(blocks.drop("own"), ["dim", "block"]).join(tree, ["dim", "part"]), k)
    ranked = first.unionByName(second).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
