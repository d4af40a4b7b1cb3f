"""Token ids, cached counts and packing against the library and a plain re-reading of the pieces."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from claimloom.llm import bpe, packing, tokencounts  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "text string, doc_id bigint, digest string, n int, bucket string, ids string, n_tokens string"


def rows(texts):
    return [(t, i, "x", 1, "b", "i", "t") for i, t in enumerate(texts)]


TEXTS = [None, "", "  ", "Hello,  World's end.\n\n", "a<|endoftext|>b <|ENDOFTEXT|>", "word " * 9000, "Thing thing", "Thing thing", "İz é ñ日本"]


def library_ids(text):
    return bpe.load(PATH).library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library_on_random_texts():
    rng = random.Random(7)
    alphabet = [*"aAbzZİßéêΣσς'smd0 9.,!|<>\n\t\x1c\x85日ñ̸́ ", "<|endoftext|>", "'s", "'re", " ", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    starts, ids = bpe.load(PATH).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library_ids(t) for t in texts]


def test_other_tokenizer_files_take_the_plain_path():
    encoder = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    text = "It's  two\n words"
    assert encoder.encode(pa.array([text]))[1].tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_counts_and_appended_cache(spark, tmp_path):
    cache = f"file://{tmp_path}/cache"
    docs = spark.createDataFrame(rows(TEXTS), SCHEMA)
    for _ in range(2):
        got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencounts.token_counts(docs, PATH, cache).collect()}
        assert got == {i: (len((t or "").encode()), len(library_ids(t))) for i, t in enumerate(TEXTS)}
        stored = spark.read.parquet(cache).count()
        assert stored == 6  # one for each distinct normalised text; the second run adds none
    more = spark.createDataFrame(rows(["brand new", "Thing   thing"]), SCHEMA)
    assert tokencounts.token_counts(more, PATH, cache).count() == 2
    assert spark.read.parquet(cache).count() == stored + 1
    assert tokencounts.token_counts(docs.limit(0), PATH, cache).count() == 0


def test_white_space_counts_where_the_tokenizer_keeps_it(spark, tmp_path):
    texts = ["a  b\n\n\nc    d", "a b c d", " a b c d ", "a b c d", None]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        library = bpe.load(path).library
        expected = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
        for _ in range(2):  # with an empty cache, then with a warm one; both tokenizers share the table
            assert {r.doc_id: r.n_tokens for r in tokencounts.token_counts(docs, path, f"file://{tmp_path}/cache").collect()} == expected
    assert spark.read.parquet(f"file://{tmp_path}/cache").groupBy("tokenizer").count().count() == 2


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_only_misses_of_a_warm_cache_are_taken(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(tokencounts, "BROADCAST_DIGESTS", most)
    path, cache = public_tokenizers.path("word_bpe_49k.json"), f"file://{tmp_path}/cache"
    seen = [f"text number {i}" for i in range(50)]
    tokencounts.token_counts(spark.createDataFrame(rows(seen), SCHEMA), path, cache)
    docs = spark.createDataFrame(rows([*seen, "fresh one", "fresh one", None, "fresh two"]), SCHEMA).select("text", F.lit(b"x").alias("other"))
    docs = docs.withColumn("digest", tokencounts.content_digest(F.col("text"), True))
    known = spark.read.parquet(cache).select("digest")
    taken = tokencounts.unseen(docs, known)
    assert sorted(r.text or "" for r in taken.collect()) == ["", "fresh one", "fresh one", "fresh two"]
    if most:  # cached texts meet the misses where they are: no exchange stands below the join
        plan = taken._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def check_pieces(pieces, texts, window):
    ids = {i: np.array([*library_ids(t), 2], "<u4") for i, t in enumerate(texts)}
    held, by_sequence = {}, {}
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        held.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(held) == set(ids)
    for doc, parts in held.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc])
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at
    assert padding < window


@pytest.mark.parametrize("window", [16, 4096])
def test_packing_holds_each_id_once(spark, window):
    rng = random.Random(3)
    texts = [*TEXTS, *["the cat sat " * rng.randint(0, 30) for _ in range(300)], *["same length here"] * 200]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    check_pieces(packing.pack(docs, PATH, window).collect(), texts, window)


def test_packing_of_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_least_squares_finds_exact_fillings():
    histogram = np.zeros(10, np.int64)
    histogram[[3, 7, 5, 2]] = [40, 40, 20, 10]
    slots, taken, _, sequences, total = packing.plan(histogram, 10)
    assert sum(a * n for a, n in taken.items()) == sequences * 10
    assert total * 10 - int((histogram * np.arange(10)).sum()) < 10


def test_the_most_frequent_lengths_are_combined_deepest():
    """Against all multisets of up to four lengths."""
    counts = np.ones(64, np.int64)
    counts[16] = 1000
    counts[10], counts[22] = 500, 400
    lengths = list(range(1, 64))
    found = set(packing.combinations(lengths, counts, 64, top=8, deep=4))
    deep = sorted(sorted(lengths, key=lambda a: (-counts[a], a))[:4])
    wide = sorted(sorted(lengths, key=lambda a: (-counts[a], a))[:8])
    every = {(a, 64 - a) for a in lengths if 2 * a <= 64}
    every |= {tuple(sorted((a, b, 64 - a - b))) for a in wide for b in wide if 64 - a - b > 0}
    every |= {tuple(sorted((a, b, c, 64 - a - b - c))) for a in deep for b in deep for c in deep if 64 - a - b - c > 0}
    assert found == every and (16, 16, 16, 16) in found


def test_one_id_and_one_text_for_most_rows(spark):
    docs = spark.createDataFrame([(None, "the same text over and over")] * 300 + [(7, "other words here")] * 50 + [(8, "x " * 5000)], "doc_id bigint, text string")
    pieces = packing.pack(docs, PATH, 64).collect()
    assert sum(p.length for p in pieces) == 300 * (len(library_ids("the same text over and over")) + 1) + 50 * (len(library_ids("other words here")) + 1) + len(library_ids("x " * 5000)) + 1
    used = {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]


def test_forgetting_keeps_ids_right(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    encoder = bpe.WordIds(PATH)
    rng = random.Random(5)
    for _ in range(30):
        texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 9) + rng.choice(["", ".", "é", "***"]) for _ in range(20)) for _ in range(4)]
        starts, ids = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [library_ids(t) for t in texts]
