"""The language model against a dictionary-based re-computation."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from claimloom.llm import lm

SCHEMA = "doc_id bigint, text string, fold string, kind string, block string"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def corpus():
    rng = random.Random(5)
    vocabulary = ["the", "The", "cat", "sat", "É", "on", "mat x", "dog", "ran", "far"]
    texts = [" ".join(rng.choices(vocabulary, weights=range(10, 0, -1), k=rng.randint(0, 60))) for _ in range(400)]
    return [None, "", " \n ", "same same", "same same", "w " * 5000, *texts]


@pytest.mark.parametrize("fan", [256, 2])
def test_counts_base_and_model(spark, monkeypatch, fan):
    seen = {}
    learn = lm.expectation_maximisation
    monkeypatch.setattr(lm, "expectation_maximisation", lambda *a: seen.setdefault("weights", learn(*a)))
    monkeypatch.setattr(lm, "BLOCK", 4000)
    monkeypatch.setattr(lm, "FAN", fan)  # with 2, eight buckets are reached by way of units of four blocks
    monkeypatch.setattr(lm, "UNIT_BLOCKS", 4)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "f", "k", "b") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in lm.lm_scores(docs).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in range(len(texts))}
    count, pair, context = Counter(), Counter(), Counter()
    for i, t in enumerate(texts):
        if fold[i] != 2:
            ts = tokens(t)
            count.update(ts)
            pair.update(zip(["<s>", *ts], ts))
            context.update(["<s>", *ts[:-1]])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ts, r = tokens(t), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i] == 2, len(ts), sum(count[x] > 0 for x in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts))
        expected = 0
        for h, x in zip(["<s>", *ts], ts):
            w = seen["weights"][math.floor(math.log2(context[h])) + 1 if context[h] else 0].copy()
            if not context[h]:
                w[2] = 0
                w /= w.sum()
            expected += math.log10(w[0] / (v + 1) + w[1] * count[x] / n + w[2] * pair[h, x] / max(context[h], 1))
        assert r.score == pytest.approx(expected)
    held = [r for i, r in got.items() if r.held_out and len(tokens(texts[i])) > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_whole_held_fold_reaches_the_weights(spark, monkeypatch):
    seen = {}
    learn = lm.expectation_maximisation
    monkeypatch.setattr(lm, "expectation_maximisation", lambda cells, *a: learn(seen.setdefault("cells", cells), *a))
    monkeypatch.setattr(lm, "BLOCK", 4000)
    texts = corpus()
    lm.lm_scores(spark.createDataFrame([(i, t, "f", "k", "b") for i, t in enumerate(texts)], SCHEMA))
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in range(len(texts))}
    count, pair = Counter(), Counter()
    for i, t in enumerate(texts):
        if fold[i] not in (2, 3):
            ts = tokens(t)
            count.update(["<s>", *ts])
            pair.update(zip(["<s>", *ts], ts))
    n = sum(count.values()) - count["<s>"]
    expected = Counter()
    for i, t in enumerate(texts):
        if fold[i] == 3:
            ts = tokens(t)
            for h, x in zip(["<s>", *ts], ts):
                context, p2, p1 = (lm.np.array([v]) for v in (count[h], pair[h, x] / max(count[h], 1), count[x] / n))
                expected[int(((lm.bucket_of(context) * lm.GRID + lm.cell(p2)) * lm.GRID + lm.cell(p1))[0])] += 1
    assert seen["cells"] == expected


def test_weights_equal_a_plain_expectation_maximisation():
    """Token by token, with no histogram of distinct cells."""
    rng = random.Random(6)
    held = [(rng.choice([0, 1, 4]), rng.randint(0, 40), rng.randint(1, 60)) for _ in range(300)]
    value = lambda c: 2.0 ** (-(c - 1) / 2) if c else 0.0
    weights = {b: [1 / 3] * 3 for b in (0, 1, 4)}
    for _ in range(60):
        mass = {b: [1.0] * 3 for b in weights}
        for b, p2, p1 in held:
            parts = [w * p for w, p in zip(weights[b], (1 / 101, value(p1), value(p2)))]
            for j in range(3):
                mass[b][j] += parts[j] / sum(parts)
        weights = {b: [m / sum(ms) for m in ms] for b, ms in mass.items()}
    found = lm.expectation_maximisation(Counter((b * lm.GRID + p2) * lm.GRID + p1 for b, p2, p1 in held), 100)
    for b, ws in weights.items():
        assert found[b].tolist() == pytest.approx(ws)
    assert found[2].tolist() == found[1].tolist() and found[9].tolist() == found[4].tolist()


def test_blocks_fall_evenly_on_tasks():
    for tasks, blocks, parts in ((8, 17, 31), (32, 5, 31), (200, 3, 190), (7000, 5, 6400)):
        n = Counter(lm.home(p + q * lm.STRIDE, parts) for p in range(tasks) for q in range(blocks))
        assert set(n) == set(range(parts)) and max(n.values()) <= 2 * tasks * blocks / parts


def test_a_task_that_runs_again_sends_the_same_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 4000)
    path = f"file://{tmp_path}/d"
    spark.createDataFrame([(i, t, 0) for i, t in enumerate(corpus())], "doc_id bigint, text string, part int").repartition(3).write.parquet(path)
    rows = spark.read.parquet(path).fillna("", "text")

    def sent():
        number = lm.block_numbers()
        return lm.map_blocks(rows, lambda t: lm.read_block(t, number(), 8, 40, 5), lm._ROW, limit=lm.BLOCK)

    one, two = (sorted((r.dest, r.kind, r.block, bytes(r.a), bytes(r.b)) for r in sent().collect()) for _ in range(2))
    assert one == two and len({r[2] for r in one}) > 3


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, "a b"), (5, "b a c")], "doc_id bigint, text string")
    got = lm.lm_scores(docs).collect()
    assert len(got) == 4 and sorted(r.n_tokens for r in got) == [3, 3, 3, 4]


def test_empty_table_and_nothing_to_learn(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lm.lm_scores(docs).count() == 0
    only_held_out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.lm_scores(spark.createDataFrame([(only_held_out, "a b", "f", "k", "b")], SCHEMA)).collect()[0]
    assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_interpolation_weights_follow_held_out_counts():
    strong = {(5 * lm.GRID + 1) * lm.GRID + 30: 1000}
    weak = {(5 * lm.GRID + 0) * lm.GRID + 10: 1000}
    assert lm.expectation_maximisation(strong, 1000)[5, 2] > 0.9
    assert lm.expectation_maximisation(weak, 1000)[5, 1] > 0.9
