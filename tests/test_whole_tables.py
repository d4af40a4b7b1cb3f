"""Queries over whole tables, on rows that a remainder of the id would leave out."""

import os
import random
import re

import pytest

from claimloom.plans import driver_queries as dq


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("whole")
    save = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"file://{out}/{name}.parquet")
    # orders 1, 2 and 3 link suppliers 1-20, 20-21 and 21-22; parts 1, 2, 7 and 9
    lines = [(1, 1, 1, 1, 10), (1, 2, 2, 20, 10), (2, 1, 7, 20, 1), (2, 2, 9, 21, 1), (3, 1, 1, 21, 5), (3, 2, 2, 22, 5)]
    save("lineitem", lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity int")
    save("orders", [(1, "1-URGENT"), (2, "1-URGENT"), (3, "5-LOW")], "o_orderkey bigint, o_orderpriority string")
    save("part", [(1, 25), (2, 50), (7, 30), (8, 1), (9, 26)], "p_partkey bigint, p_size int")
    save("supplier", [(i,) for i in (1, 20, 21, 22)], "s_suppkey bigint")
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [rng.sample(words, rng.randint(5, 40)) for _ in range(25)]
    texts += [x[:-1] for x in texts[:10]] + texts[:5] + [list(reversed(texts[0]))]
    docs = [(i, " ".join(x), rng.choice(["en", None]), rng.choice("ab")) for i, x in enumerate(texts)]
    docs += [(100 + i, "same words here", "en", "a") for i in range(4)] + [(200, None, "en", "a"), (201, " ", "en", "a")]
    save("documents", docs, "doc_id bigint, text string, lang string, source string")
    return f"file://{out}", docs


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_overlaps_of_all_orders(spark, folder):
    assert rows(dq.q52_interval_overlap(spark, folder[0])) == [(1, 1, 2, 2, 11), (3, 1, 2, 2, 6)]


def test_snowball_along_all_orders(spark, folder):
    assert rows(dq.q57_snowball(spark, folder[0])) == [(1, 0), (20, 1), (21, 2)]


def test_jaccard_of_documents_equals_brute_force(spark, folder):
    sets = {}
    for i, text, *block in folder[1]:
        if (text or "").strip():
            sets.setdefault((*block, frozenset(text.split())), []).append(i)
    expected = [(min(ids), i, 1.0) for ids in sets.values() for i in ids if i != min(ids)]
    for a, x in sets.items():
        for b, y in sets.items():
            if a[:2] == b[:2] and min(x) < min(y) and len(a[2] & b[2]) / len(a[2] | b[2]) > 0.85:
                expected.append((min(x), min(y), round(len(a[2] & b[2]) / len(a[2] | b[2]), 6)))
    assert len(expected) > 6
    assert rows(dq.q39_jaccard(spark, folder[0])) == sorted(expected)


def test_near_sets_travel_to_places_and_not_with_their_pairs(spark):
    from claimloom.operators import relational as rel

    rng = random.Random(1)
    base = [rng.getrandbits(63) for _ in range(60)]
    sets = [(i, sorted({x for x in base if rng.random() > 0.02} | {rng.getrandbits(63)})) for i in range(60)] + [(100 + i, sorted(rng.getrandbits(63) for _ in range(rng.randint(1, 900)))) for i in range(12)]
    sets += [(200 + i, w[len(w) // 14 :]) for i, (_, w) in enumerate(sets[60:])]
    frame, held = spark.createDataFrame(sets, "id bigint, w array<bigint>"), {i: set(w) for i, w in sets}
    pairs = [(a, b) for a in held for b in held if a < b]
    expected = sorted((a, b, round(len(held[a] & held[b]) / len(held[a] | held[b]), 6)) for a, b in pairs if len(held[a] & held[b]) / len(held[a] | held[b]) > 0.85)
    found = rel.jaccard_pairs(frame, "id", "w", 0.85)
    assert rows(found) == expected and len(expected) > 1000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "left_w" not in plan and "array_intersect" not in plan  # words would be shuffled once for each pair
    # places of few words are parted by either id
    counted = rel._shared_words(spark.createDataFrame(pairs, "left_id bigint, right_id bigint"), frame, each=1000)
    assert rows(counted) == sorted((a, b, len(held[a]), len(held[b]), len(held[a] & held[b])) for a, b in pairs)


def test_radar_watches_large_parts_whatever_their_ids(spark, folder):
    assert rows(dq.q18_radar_equi(spark, folder[0])) == [(1, "1,2", 2), (2, "7,9", 2)]


def test_digest_index_lists_every_table(spark, tmp_path):
    for name in dq.TABLES:
        spark.range(1).coalesce(1).write.parquet(f"file://{tmp_path}/{name}.parquet")
    listed = [r.name.split("/")[0] for r in dq.q50_digest_index(spark, f"file://{tmp_path}").collect()]
    assert sorted(listed) == sorted(f"{x}.parquet" for x in dq.TABLES)


def test_contexts_are_not_shuffled_once_they_are_nested(spark):
    from claimloom import catalog

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("needs the driver's tables")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = catalog.queries()["q61_scored_claims"](spark, "/root/testdata/sf0.001")
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan, re.M)
    assert shuffled and not [x for x in shuffled if re.search(r"\b(x|contexts|citation_contexts)#", x)]


def test_scored_claims_are_made_once(spark):
    from claimloom import catalog
    from claimloom.plans import claim_queries, scoring

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("needs the driver's tables")
    sf = "/root/testdata/sf0.001"
    for name in ("q62_score_summary", "q63_components"):
        plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_orderkey#") and plan.count("collect_list(") == 1
    entries = claim_queries.bibliography(spark, sf)
    met = claim_queries.claims(spark, sf, entries=entries).select("claim_id", "entries")
    joined = scoring.with_entries(claim_queries.claims(spark, sf), entries).select("claim_id", "entries")
    told = lambda frame: {r.claim_id: r.entries or {} for r in frame.collect()}
    assert told(met) == told(joined) and any(told(met).values())


def test_stored_claims_are_met_by_claim_without_a_shuffle(spark):
    from claimloom.plans import claim_queries

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("needs the driver's tables")
    rows = claim_queries._faulty_claims(spark, "/root/testdata/sf0.001").groupBy("claim_id").count()
    assert rows.count() == 1500 + 25
    assert "Exchange" not in rows._jdf.queryExecution().sparkPlan().toString() + rows._jdf.queryExecution().executedPlan().toString()


def test_stored_records_are_compared_with_claims_made_once(spark):
    from claimloom import catalog

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("needs the driver's tables")
    frame = catalog.queries()["q67_stored_records"](spark, "/root/testdata/sf0.001")
    assert "l_orderkey" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_checks_of_stored_claims_shuffle_no_whole_claim(spark):
    from claimloom import catalog

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("needs the driver's tables")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = catalog.queries()["q66_repository_checks"](spark, "/root/testdata/sf0.001")
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan, re.M)
    assert shuffled and not [x for x in shuffled if re.search(r"\b(citation_contexts|claim_atoms|trust_score|entries|contexts)#", x)]
    stored = [x for x in shuffled if re.search(r"\bcitation_keys#", x) and "options" not in x]
    assert not stored  # directives come to the claims, not claims to the directives


def test_edges_and_pages_meet_claims_by_their_id(spark):
    from pyspark.sql import functions as F

    from claimloom.plans import repository
    from claimloom.sources import schemas

    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    types = {f.name: f.dataType for f in spark.createDataFrame([], schemas.CLAIM).schema}
    context = lambda key, role: F.struct(*[F.lit({"cite_key": key, "role": role}.get(f.name)).cast(f.dataType).alias(f.name) for f in types["citation_contexts"].elementType.fields])
    several = F.array(context("a", "background"), context("a", "direct_support"), context("b", "partial_support"), context("c", "direct_support"))
    own = spark.createDataFrame([("c1", "f1"), ("c1", "f2"), ("c2", None), (None, None)], "id string, file string")
    made = {"claim_id": F.col("id"), "source_file": F.col("file"), "claim_text": F.lit("Text."), "paragraph_index": F.lit(1), "citation_contexts": F.when(F.col("id").eqNullSafe("c2"), F.lit(None)).otherwise(several)}
    frame = own.select(*[made.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in types.items()])
    edges = spark.createDataFrame([("c1", "supports", "a", "citation", 1.0, ""), ("c1", "supports", "a", "citation", 1.0, ""), ("c1", "supports", "b", "citation", 0.5, ""), ("c1", "supports", None, "citation", 1.0, ""), ("c2", "x", "a", "claim", 2.0, ""), (None, "x", "a", "citation", 1.0, "")], schemas.EDGE)
    assert rows(repository.edge_violations(frame, edges)) == sorted(
        [("context without edge", "c1"), ("context without edge", None), ("context without edge", None), ("context without edge", None), ("edge of unknown claim", None), ("edge relation or weight", "c1"), ("edge weight", "c2"), ("edge without context", "c1")], key=str
    )
    options = lambda cid: {"claim-id": cid, "claim": "Text."}
    pages = spark.createDataFrame([("f1", 1, {"claim-id": "c1", "claim": "Other."}), ("f1", 0, options("c1")), ("f3", 0, options("c1")), (None, 0, options("c2")), ("f1", 0, {"claim": "x"})], schemas.DIRECTIVE)
    assert rows(repository.directive_problems(frame, pages)) == sorted([("c1", "no directive"), ("c2", "no directive"), (None, "no directive")], key=str)
    prose = spark.createDataFrame([("f1", 1, "So: Text."), ("f2", 1, "Nothing."), ("f4", 1, "Text.")], "file string, paragraph_index int, text string")
    stands, file = "claim stands in its paragraph", "source file"
    assert rows(repository.text_violations(frame, prose)) == sorted([(stands, "c1"), (file, "c2"), (file, None)], key=str)
    assert rows(repository.text_violations(frame, prose, prose.where("file <> 'f1'"))) == sorted([(file, "c1"), (stands, "c1"), (file, "c2"), (file, None)], key=str)
