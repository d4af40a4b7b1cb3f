"""The pipeline's stages on a planted corpus, and the operators' SQL oracles."""

import os
import random
import sys

import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402
from claimloom.llm import bpe, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, keep string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ri", "sto", "ma", "ple", "den", "ko", "va") for b in ("ver", "ne", "rit", "la", "dom", "sel", "tan")]
    say = lambda n: " ".join(rng.choice(words) + (". " if i % 9 == 8 else "") for i in range(n))
    item = " ".join(rng.choices(words, k=30))
    clean = {i: say(rng.randint(20, 200)) for i in range(200)}
    planted = {
        300: clean[7], 301: clean[8] + " added words", 302: say(30) + " " + item + " " + say(10), 303: "AKIA" + "Q" * 16 + " " + say(30), 304: " | ".join(say(60).split()), 305: " ".join(w.upper() + "!!" for w in say(60).split()),
        306: None, 307: "", 308: 'x password: "hunter22hunter" ' + say(40), 309: say(5000),
    }
    rows = [(i, t, "en", "s", len(t or ""), "e", "k") for i, t in (clean | planted).items()]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCS).write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 100)] + [(304, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"file://{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"file://{folder}/benchmark.parquet")
    return f"file://{folder}", clean


def test_stages_keep_clean_documents(spark, corpus):
    folder, clean = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = [{304, 305, 306, 307}, {300, 301}, {302}, set()]
    left = set(clean) | {*range(300, 310)}
    for (name, stage), out in zip(corpus_pipeline.STAGES, gone):
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        left -= out
        assert docs.columns == corpus_pipeline.COLUMNS
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
    texts = {r.doc_id: r for r in docs.collect()}
    assert texts[303].text.startswith("[SECRET] ") and texts[308].text.startswith("x [SECRET]") and texts[303].n_chars == len(texts[303].text)
    assert all(texts[i].text == t for i, t in clean.items())
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    encoder = bpe.load(__import__("public_tokenizers").path("word_bpe_49k.json"))
    assert total == {i: len(encoder.library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in texts.items()}


def test_run_equals_the_stages(spark, corpus):
    folder, _ = corpus
    assert len({r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}) == 203


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c", "en", "s", 5, "e", "k")] * 2 + [(2, "d e f", "en", "s", 5, "e", "k"), (3, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == [1, 2, 3]
    assert corpus_pipeline.near_duplicate_stage(spark, docs.limit(0), "").count() == 0


def test_rows_without_id_or_with_one_id_are_told_apart(spark, corpus):
    folder, clean = corpus
    row = lambda i, t: (i, t, "en", "s", len(t or ""), "e", "k")
    rows = [row(None, clean[20]), row(None, clean[21]), row(7, clean[22]), row(7, clean[23]), row(8, clean[24]), row(8, clean[24]), row(6, clean[22]), row(None, clean[23]), row(None, clean[20])]
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, DOCS), folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, clean[20]), (0, clean[21]), (6, clean[22]), (7, clean[23]), (8, clean[24])])

    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    planted = {r.doc_id: r.text for r in docs.where("doc_id >= 300").collect()}
    more = spark.createDataFrame([row(None, planted[304] + " |"), row(None, clean[25]), row(150, planted[305]), row(None, planted[302])], DOCS).select(*corpus_pipeline.COLUMNS)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.quality_stage(spark, docs.unionByName(more), folder).collect()]
    assert (None, clean[25]) in kept and (150, clean[150]) in kept
    assert (None, planted[304] + " |") not in kept and (150, planted[305]) not in kept
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.decontamination_stage(spark, more, folder).collect()]
    assert (None, clean[25]) in kept and (None, planted[302]) not in kept


def test_each_stage_on_awkward_tables(spark, corpus):
    """Null ids and texts, empty and long texts, repeated rows, extra columns and empty tables; what stays is what a plain reading of the rules leaves."""
    folder, clean = corpus
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    long = " ".join(clean.values()) * 3
    row = lambda i, t: (i, t, None, "s", len(t or ""), "e", "k")
    rows = [row(None, None), row(1, ""), row(1, " \n"), row(None, clean[30]), row(None, clean[30]), row(2, clean[30]), row(2, clean[31]), row(2, clean[31]), row(3, long), row(None, item + " " + clean[32]), row(4, clean[33] + " AKIA" + "Z" * 20)]
    docs = spark.createDataFrame(rows, DOCS)
    bag = lambda frame: sorted((r.doc_id or 0, r.text or "") for r in frame.select("doc_id", "text").collect())
    of = lambda *at: sorted((rows[i][0] or 0, rows[i][1] or "") for i in at)
    stages = dict(corpus_pipeline.STAGES)
    assert bag(stages["quality"](spark, docs, folder)) == of(3, 4, 5, 6, 7, 8, 9, 10)
    assert bag(stages["near_duplicates"](spark, docs, folder)) == of(0, 1, 2, 5, 6, 8, 9, 10)
    assert bag(stages["decontamination"](spark, docs, folder)) == of(0, 1, 2, 3, 4, 5, 6, 7, 8, 10)
    masked = stages["secrets"](spark, docs, folder)
    assert bag(masked) == sorted(of(0, 1, 2, 3, 4, 5, 6, 7, 8, 9) + [(4, clean[33] + " [SECRET]")]) and masked.where("text is null").count() == 1
    encoder = bpe.load(__import__("public_tokenizers").path("word_bpe_49k.json"))
    total = sum(p.length for p in stages["packing"](spark, docs, folder).collect())
    assert total == sum(len(encoder.library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_row_numbers_are_unique_and_the_same_in_every_scan(spark, tmp_path):
    from claimloom.llm.common import numbered

    spark.range(1000).repartition(7).write.parquet(f"file://{tmp_path}/t")
    rows = numbered(spark.read.parquet(f"file://{tmp_path}/t"), "row_no")
    first = {r.id: r.row_no for r in rows.collect()}
    assert len(set(first.values())) == 1000 and {r.id: r.row_no for r in rows.where("id % 3 = 0").collect()} == {i: n for i, n in first.items() if i % 3 == 0}
    assert numbered(spark.range(5).toDF("id"), "row_no").select("row_no").distinct().count() == 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    oracle.same(queries.queries()[name](spark, SF), oracle.connection(SF), queries.ORACLES[name])
