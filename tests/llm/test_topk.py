"""Exact top-k against brute force in integers."""

import math
import random

import numpy as np
import pytest

from claimloom.llm import topk

SCHEMA = "embedding array<float>, vec_id bigint, dim string, part string, score string"


@pytest.mark.parametrize("shard_rows,block_rows,pivot_rows", [(10_000, 1000, 1024), (150, 7, 1024), (60, 7, 50)])
def test_against_brute_force(spark, monkeypatch, shard_rows, block_rows, pivot_rows):
    monkeypatch.setattr(topk, "PIVOT_ROWS", pivot_rows)
    monkeypatch.setattr(topk, "PAGE", 3)
    rng = random.Random(2)
    vectors = {i: [rng.choice([-1.5, 0.1, 0.25, rng.gauss(0, 1)]) for _ in range(6)] for i in range(0, 1200, 2)}
    vectors |= {i: vectors[50] for i in range(1, 300, 2)}
    odd = [(None, 9000), ([0.1, None, 0.0, 0.0, 0.0, 0.0], 9050), ([math.nan] * 6, 9100), ([math.inf] * 6, 9150), ([1.0] * 3, 9200), ([], 9250), ([1.0] * 6, None)]
    rows = [(v, i, "", "", "") for i, v in vectors.items()] + [(v, i, "", "", "") for v, i in odd] + [(vectors[100], 100, "", "", "")] * 7
    table = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in topk.top_inner_products(table, table.where("vec_id % 50 = 0"), shard_rows=shard_rows, block_rows=block_rows).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ints = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in vectors.items()}
    for q in [i for i in ints if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert not got


def test_far_shards_stay_closed_and_repeated_ids_count_once(spark, monkeypatch):
    """Clusters in opposite directions: results equal brute force though most pairs of block and shard are never opened."""
    monkeypatch.setattr(topk, "PIVOT_ROWS", 40)
    opened = []
    original = topk._open
    monkeypatch.setattr(topk, "_open", lambda pairs: opened.append((pairs.count(), original(pairs))) or opened[-1][1])
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 20
    x = np.concatenate([c + rng.normal(size=(60, 8)) * 0.2 for c in centres])
    rows = [([float(v) for v in r], i) for i, r in enumerate(x)] + [([float(v) for v in x[7] + 50], 7), ([float(v) for v in -x[20]], 20)]
    table = spark.createDataFrame(rows, "embedding array<double>, vec_id bigint")
    got = {}
    for r in topk.top_inner_products(table, table.where("vec_id % 50 = 0"), shard_rows=64, block_rows=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ints = {}
    for v, i in rows:
        w = [math.floor(256 * c) for c in v]
        ints[i] = min(ints.get(i, w), w)
    for q in range(0, len(x), 50):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert not got
    _, pairs = opened[0]
    assert pairs.count() < 0.5 * 12 * 12


def test_few_rows_large_values_and_empty(spark):
    table = spark.createDataFrame([([3e30], 0, "", "", ""), ([1.0], 1, "", "", "")], SCHEMA)
    assert [(r.query_id, r.rank, r.vec_id) for r in topk.top_inner_products(table, table.where("vec_id = 0")).collect()] == [(0, 1, 1)]
    assert topk.top_inner_products(table.limit(0), table).count() == 0
