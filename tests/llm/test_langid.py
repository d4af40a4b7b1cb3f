"""Language identification: held-out accuracy, rejection and odd rows."""

import math
import os
import random

import pytest

from claimloom.llm import langid

SCHEMA = "text string, doc_id bigint, lang string, score string, rejected string"
WORDS = {"en": "the and of that which with from having house water", "de": "der und die nicht sich auch werden straße haus über", "fr": "les des une dans être où français maison eau très"}


def rows(n, seed):
    rng = random.Random(seed)
    return [(" ".join(rng.choices(WORDS[lang].split(), k=rng.randint(4, 40))), i, lang, "", "") for i, lang in enumerate(rng.choices(list(WORDS), k=n))]


def test_learned_languages_and_odd_texts(spark):
    model = langid.fit(spark.createDataFrame([*rows(300, 1), (None, 900, "en", "", ""), ("x", 901, None, "", "")], SCHEMA), sample=120)
    tests = rows(90, 2)
    odd = [None, "", " \n", "123 !? …", "ЖЖЖЖ ЩЩЩЩ ЮЮЮЮ ЯЯЯЯ", "a", "the " * 30000]
    docs = spark.createDataFrame(tests + [(t, 1000 + i, None, "", "") for i, t in enumerate(odd)], SCHEMA)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == lang and 0 < got[i].score <= 1 for _, i, lang, _, _ in tests)
    assert sum(got[i].rejected for _, i, *_ in tests) <= 5
    assert [got[1000 + i].lang_pred for i in range(4)] == ["und"] * 4 and got[1003].score == 0
    assert got[1004].lang_pred in WORDS and got[1004].rejected and got[1004].lang_open == "und"
    assert got[1006].lang_pred == "en"


def test_predictions_equal_a_text_by_text_computation(spark):
    """Trigrams, TF-IDF, cosines and rejection, recomputed with dictionaries from the model's centroids."""
    model = langid.fit(spark.createDataFrame(rows(200, 3), SCHEMA), sample=120)
    tests = [(t, i) for t, i, *_ in rows(60, 4)] + [(None, 500), ("", 501), ("Ünd 1 x", None), ("a", 503), ("the " * 3000 + "und", 502)]

    def plain(text):
        raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (" " + (text or "").lower() + " ").encode())
        counts = {}
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            if b != 32 or (a != 32 and c != 32):
                h = ((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> (32 - langid.DIMS_LOG2)
                counts[h] = counts.get(h, 0) + 1
        x = {h: (1 + math.log(n)) * float(model["idf"][h]) for h, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        cosines = [sum(v / norm * float(c[h]) for h, v in x.items()) for c in model["centres"]]
        return cosines

    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(tests, "text string, doc_id bigint"), model).collect()}
    for text, i in tests:
        if any(c.isalpha() for c in text or ""):
            cosines = plain(text)
            best = max(cosines)
            assert got[i].score == pytest.approx(min(1.0, max(0.0, best)), abs=1e-4)
            own = {model["langs"][model["of"][k]] for k, c in enumerate(cosines) if c > best - 1e-5}
            assert got[i].lang_pred in own
            reach = model["reach"][model["langs"].index(got[i].lang_pred)]
            assert abs(1 - best - reach) < 1e-4 or got[i].rejected == (1 - best > reach)
        else:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)


def test_centroids_are_the_means_of_their_rows():
    """Each centroid is the scaled mean of the rows that are nearest to it."""
    x = langid.np.abs(langid.np.random.default_rng(1).normal(size=(90, 12))).astype("float32")
    x /= langid.np.sqrt((x**2).sum(1, keepdims=True))
    c = langid._k_means(x, 3, rounds=60)
    own = (x @ c.T).argmax(1)
    for j in range(3):
        mean = x[own == j].mean(0)
        assert langid.np.allclose(c[j], mean / langid.np.sqrt((mean**2).sum()), atol=1e-4)


def test_nothing_to_learn_from_and_empty(spark):
    docs = spark.createDataFrame(rows(3, 1), SCHEMA)
    model = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, model).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/documents.parquet"), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    from claimloom.llm.queries import op1_language_id

    found = op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
