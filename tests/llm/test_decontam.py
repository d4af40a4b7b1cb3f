"""Decontamination against a word-by-word brute force."""

import hashlib
import random
import re

import pytest

from claimloom.llm import decontam

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCS = "text string, doc_id bigint, items string, spans string, item_id bigint"
ITEMS = "item_id bigint, text string, doc_id string"


def ws(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width):
    out = {}
    for d, text in docs:
        words, hit, who = ws(text), set(), set()
        for i, item in items:
            want = ws(item)
            n = min(width, len(want))
            for a in range(len(want) - n + 1 if want else 0):
                for b in range(len(words) - n + 1):
                    if words[b : b + n] == want[a : a + n]:
                        hit.update(range(b, b + n))
                        who.add(str(i))
        out[d] = (len(words), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("most_chars", [1 << 20, 200])
def test_against_brute_force(spark, most_chars):
    rng = random.Random(1)
    vocabulary = ["the", "Thé", "a", "b2", "x", "NO", " nb"]
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=n))
    items = [(1, say(4)), (2, say(2)), (3, None), (4, ""), (5, "!?"), (6, say(30)), (7, say(30)), (16, say(3)), (6, say(5)), (None, say(30))]
    items.append((17, items[5][1]))
    docs = [(0, None), (1, ""), (2, "..."), (3, say(3000)), *((i, say(rng.randint(1, 60)) + ". " + (items[5][1] if i % 3 else "")) for i in range(4, 40))]
    spark_docs = spark.createDataFrame([(t, d, "x", "y", 0) for d, t in docs], DOCS)
    spark_items = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    found = decontam.find_items(spark_docs, spark_items, width=3, most_chars=most_chars)
    expected = brute(docs, [x for x in items if x[0] is not None], 3)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.digest(found).collect()}
    nameless = brute(docs, items, 3)
    assert {d: (v[0], *v[2:4]) for d, v in got.items()} == {d: (v[0], *v[2:4]) for d, v in expected.items()}
    assert {d: (v[1], v[4]) for d, v in got.items()} == {d: (v[1], v[4]) for d, v in nameless.items()}
    texts = dict(docs)
    for r in found.collect():
        assert sum(len(ws(texts[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([("a b", 1, "", "", 0)], DOCS), spark.createDataFrame([], ITEMS)
    assert decontam.digest(decontam.find_items(docs, items)).collect()[0].contaminated is False
    assert decontam.find_items(docs.limit(0), items).count() == 0
