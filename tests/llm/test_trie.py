"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from claimloom.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, family=20, most=4):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda key: len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
    out = []
    for key, members in nodes.items():
        kids = [k for k in nodes if len(k) == len(key) + 1 and k[:-1] == key]
        under = [k for k in nodes if k[: len(key)] == key]
        leaves = [k for k in under if not any(len(x) == len(k) + 1 and x[:-1] == k for x in nodes)]
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids), len(leaves), sum((len(nodes[k]) - 1) * words(k) for k in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, **more):
    return sorted((tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **more).collect()), key=repr)


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(-25, 30), 400, 9000, 9001]:
        # long shared beginnings, copies, and an own end for some
        n = rng.choice([1, 2, 3, 5, 9, 14])
        for i in range(n):
            rows.append((c, i if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]) if i == n - 1 else "user", f"step {i} " + ("x y z" if rng.random() < 0.95 else str(c))))
    rng.shuffle(rows)
    for most in (1, 4):
        assert got(spark, rows, most=most) == plain(rows, most=most)


def test_copies_over_several_runs_of_ids(spark):
    ids = [1, 2, 5000, 5001, 123456, 10**12, -7]
    rows = [(c, t, "user", f"t{t}") for c in ids for t in range(3)] + [(77, 0, "user", "t0"), (78, 0, "user", "")]
    assert got(spark, rows, most=1) == plain(rows, most=1)


def test_one_conversation_and_none(spark):
    rows = [(7, t, "user", "same") for t in range(40)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []


def test_nulls_repeats_and_names(spark):
    rows = [(20, None, None, None), (20, 0, "user", "a"), (20, 0, "user", "a"), (21, 0, "user", "a"), (21, None, "", ""), (None, 0, "user", "a"), (43, 0, "user", "b")]
    assert got(spark, rows) == plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("depth", "what", "rep", "f0", "n", "size", "parent", "words")})
    assert sorted((tuple(r) for r in trie.prefix_trie(frame).collect()), key=repr) == plain(rows)


def test_rounds_grow_with_the_logarithm_of_shared_depth(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(trie, "drop_stored", lambda df: seen.append("end"))
    store = trie.stored
    monkeypatch.setattr(trie, "stored", lambda df, name: seen.append(name) or store(df, name))
    rows = [(c, t, "user", f"t{t}" if t < 39 else f"own {c}") for c in (100, 200) for t in range(40)]
    assert got(spark, rows, most=1) == plain(rows, most=1)
    assert seen.count("nodes") <= 8


@pytest.mark.parametrize("hot", [60])
def test_a_class_with_most_members(spark, hot):
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 7} {t}") for c in range(1000, 1000 + hot) for t in range(3)]
    assert got(spark, rows, most=1) == plain(rows, most=1)
