"""The near-duplicate join against all pairs, and its bounds on random sets."""

import random
import re

import numpy as np
import pytest

from claimloom.llm import graph, ngramjoin as nj

SCHEMA = "text string, doc_id bigint, sid string, n string, label string"


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def brute(texts):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    say = lambda n: rng.choices(vocabulary, k=n)
    shared = say(25)
    texts = [None, "", " \t", "One two", "one TWO", "one", "a b c d e", "A b c d e", " ".join(say(9000))]
    for _ in range(60):
        base = say(rng.choice([3, 6, 8, 12, 20, 60, 150, 400]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            for _ in range(rng.randint(0, max(1, len(near) // 30))):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" ".join(near))
    texts += [" ".join(shared + say(rng.randint(2, 30))) for _ in range(70)]
    base = say(150)
    for _ in range(60):  # many near copies of one text, some of them too far from it
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    chain = say(60)
    for _ in range(12):
        chain = chain[2:] + say(2)
        texts.append(" ".join(chain))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize("light, hot", [(8, 4 << 20), (1, 4 << 20), (8, 100)])
def test_classes_equal_brute_force(spark, monkeypatch, light, hot):
    monkeypatch.setattr(nj, "LIGHT", light)
    monkeypatch.setattr(nj, "HOT", hot)
    monkeypatch.setattr(nj, "RUN_ROWS", max(2, light))
    monkeypatch.setattr(nj, "BLOCK_MEMBERS", 8 * light)
    texts = corpus(light)
    docs = spark.createDataFrame([(t, i, "x", "y", "z") for i, t in texts], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(docs).collect()}
    assert got == brute(texts)


def test_rows_without_an_id_are_bridges(spark):
    """A and B are linked only through N; whatever N's id is, they are one class, and a class of rows without ids has none."""
    rng = random.Random(2)
    base = [f"v{i}" for i in rng.sample(range(10000), 300)]
    near = lambda k: " ".join([*base[:k], *(f"x{k}y{i}" for i in range(20)), *base[k + 20 :]])
    a, n, b = near(10), " ".join(base), near(200)
    assert 80 * len(shingles(a) | shingles(b)) > 100 * len(shingles(a) & shingles(b))
    for bridge in (2, None):
        rows = [(a, 1), (n, bridge), (n, bridge), (b, 3), ("quite another text than these others", None), ("quite another text than these others", None)]
        got = nj.near_duplicates(spark.createDataFrame(rows, "text string, doc_id bigint")).collect()
        assert {r.component_id for r in got if r.n_shingles > 100} == {1} and len(got) == 6
        assert {r.component_id for r in got if r.n_shingles < 100} == {None}


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([("a b", 2, "", "", ""), ("a b", 2, "", "", ""), ("a  B", 1, "", "", "")], SCHEMA)
    assert sorted(map(tuple, nj.near_duplicates(docs).collect())) == [(1, 1, 1), (2, 1, 1), (2, 1, 1)]
    assert nj.near_duplicates(docs.limit(0)).count() == 0


def test_linked_sets_share_a_key_within_their_room():
    rng = np.random.default_rng(4)
    for s in [1, 2, 4, 5, 9, 12, 17, 31, 32, 63, 64, 100, 127, 300, 511, 700]:
        for _ in range(20):
            a = rng.integers(0, 2**63, s, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            b = a.copy()
            while True:
                c = b.copy()
                if rng.random() < 0.5 and len(c) > 1:
                    c = np.delete(c, rng.integers(len(c)))
                else:
                    c = np.append(c, rng.integers(0, 2**63, dtype=np.int64).astype(np.uint64))
                if 100 * len(np.intersect1d(a, c)) < 80 * len(np.union1d(a, c)):
                    break
                b = c
            band = nj.band_of(max(len(a), len(b)))
            (ka, ra), (kb, rb) = nj.keys_of(np.sort(a), band), nj.keys_of(np.sort(b), band)
            assert len(np.intersect1d(ka, kb)) > max(ra, rb) >= 0
            (ka, ra), (kb, rb) = (nj.keys_of(np.sort(x), band, nj.FINER) for x in (a, b))
            assert len(np.intersect1d(ka, kb)) > max(ra, rb) >= 0
            differ = int(np.unpackbits((nj.sketch(a) ^ nj.sketch(b)).view(np.uint8)).sum())
            assert differ <= len(np.setxor1d(a, b)) <= (len(a) + len(b)) // 9


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a bigint, b bigint")
    assert {(r.node, r.label) for r in graph.components(edges).collect()} == {*((i, 0) for i in range(51)), (100, 100), (101, 100)}
