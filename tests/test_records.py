"""Operators that the registered queries don't reach, and the scale-safe ones against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.operators import relational as rel
from claimloom.plans import authorship, contracts, evidence, releases, submissions, versions
from claimloom.plans.checks import Rejected, violations
from claimloom.sources import documents, schemas, scratch


def bag(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_sample_equals_ranking_whole_groups(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None, "c"])) for i in range(3000)] + [(5000, "few")]
    hashed = F.md5(F.col("id").cast("string"))
    frame = spark.createDataFrame(rows, "id bigint, g string")
    import hashlib

    expected = []
    for g in {g for _, g in rows}:
        ids = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, x in rows if x == g)
        expected += [(i, g) for _, i in ids[: max(5, -(-len(ids) // 10))]]
    for prefix in (1, 4):
        assert bag(rel.repeatable_sample(frame, ["g"], hashed, "id", 0.1, 5, prefix)) == sorted(expected, key=repr)


def test_places_equal_ranking_whole_groups(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab") if i % 9 else None, rng.randint(0, 50)) for i in range(800)]
    found = rel.places(spark.createDataFrame(rows, "id bigint, g string, v int"), ["g"], [F.floor(F.col("v") / 7)], ["v", "id"], "place")
    expected = []
    for g in {g for _, g, _ in rows}:
        expected += [(i, g, v, n + 1) for n, (v, i) in enumerate(sorted((v, i) for i, x, v in rows if x == g))]
    assert bag(found.select("id", "g", "v", "place")) == sorted(expected, key=repr)


def test_topics_shuffle_keys_and_no_tokens(spark):
    hays = spark.createDataFrame([(i, f"cell word{i} mitosis") for i in range(20)], "doc bigint, hay string")
    asked = spark.createDataFrame([(1, ["cell", "mitosis"]), (2, ["word3"]), (3, ["cell", "none"])], "q int, tokens array<string>")
    found = rel.topic_hits(hays, "doc", asked, ["q"])
    assert set(map(tuple, found.collect())) == {(i, 1) for i in range(20)} | {(3, 2)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and not [x for x in plan.splitlines() if "Aggregate" in x and "tokens" in x]


def test_topics_number_their_queries(spark):
    hays = spark.createDataFrame([(i, f"cell word{i}") for i in range(5)], "doc bigint, hay string")
    asked = spark.createDataFrame([("x", ["cell"]), ("x", ["word3"]), ("y", ["cell"])], "q string, tokens array<string>")
    found = rel.topic_hits(hays, "doc", asked, ["q"])
    assert sorted(map(tuple, found.collect())) == sorted([(i, q) for i in range(5) for q in "xy"] + [(3, "x")])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    numbers = re.findall(r"\b_q#\d+(L?)", plan)
    assert numbers and all(numbers)  # bigint, where a digest's text took 64 bytes a pair


def test_topics_and_quotes_equal_trying_all_pairs(spark):
    rng = random.Random(6)
    words = ["cell", "cells", "subcellular", "mitosis", "abc", "xabcx", "of", "日本語", "the"]
    texts = [(i if i % 7 else None, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(120)]
    queries = [(q, [w for w in rng.choices(words + ["ell", "none"], k=rng.randint(0, 3)) if len(w) > 2]) for q in range(25)]
    frame, asked = spark.createDataFrame(texts, "doc bigint, hay string"), spark.createDataFrame(queries, "q int, tokens array<string>")
    expected = [(i, q) for i, h in set(texts) for q, ts in queries if ts and all(x in h for x in ts)]
    assert set(bag(rel.topic_hits(frame, "doc", asked, ["q"]))) == set(expected) and expected
    quotes = [(i, rng.choice(texts)[1][rng.randint(0, 20) : rng.randint(20, 90)]) for i in range(40)] + [(90, "cell"), (91, ""), (92, "never found in any of these")]
    found = rel.quote_hits(spark.createDataFrame(texts, "doc bigint, text string"), "doc", spark.createDataFrame(quotes, "item int, quote string"), "item")
    assert set(bag(found.select("doc", "item", "text"))) == {(d, i, t) for d, t in texts for i, q in quotes if q in t}


def test_scratch_tables_need_a_shared_folder_on_a_cluster():
    class Session:
        class sparkContext:
            master = "spark://somewhere:7077"

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session)
    Session.conf.get = staticmethod(lambda key, default: "hdfs://shared/folder/")
    assert scratch.scratch_root(Session) == "hdfs://shared/folder"


def test_parameters_that_contradict(spark):
    rows = [("a", "Cover ALL of it", 5, "<2%", 2), ("b", "a short look", 5, "<2%", 0), ("c", "every relevant paper", None, None, 1), ("d", "a look", 5, None, None)]
    found = bag(evidence.parameter_problems(spark.createDataFrame(rows, "review string, prompt string, min_papers_per_cluster int, saturation_criterion string, snowball_rounds int")))
    assert [(r, p.split()[0:3]) for r, p in found] == [("a", ["an", "exhaustive", "prompt"]), ("b", ["saturation", "needs", "a"]), ("c", ["an", "exhaustive", "prompt"])]


def test_numbered_texts_and_whole_files(spark, tmp_path):
    for name in ("02_results.md", "10_end.md", "notes.md"):
        (tmp_path / name).write_text(f"# {name}\n\nline\n")
    assert bag(documents.numbered_texts(spark, f"file://{tmp_path}/*.md").select("file", "section", F.length("text"))) == [("02_results.md", 2, 22), ("10_end.md", 10, 18)]


def test_author_orders_and_members(spark):
    people = spark.createDataFrame([("Ann Lee", 0, ["a"], "2020-01"), ("Bo Ash", 1, ["a", "b"], None), ("Cy Lee", 2, None, "2019-05")], "person string, ord int, roles array<string>, joined string")
    names = lambda frame: [r.person.split()[0] for r in frame.collect()]
    assert names(authorship.by_last_name(people)) == ["Bo", "Ann", "Cy"]
    assert names(authorship.by_roles(people)) == ["Bo", "Ann", "Cy"]
    assert names(authorship.by_joining(people)) == ["Cy", "Ann", "Bo"]
    sections, figures = spark.createDataFrame([("x", "1"), ("y", "1"), ("x", "2")], "person string, section string"), spark.createDataFrame([("y", "f")], "person string, figure string")
    assert bag(authorship.section_and_figure_members(sections, figures)) == [("1", ["x", "y"], "section"), ("2", ["x"], "section"), ("f", ["y"], "figure")]


def snapshot(i, **kw):
    base = {"claim_id": f"clm_{i:016x}", "supersedes_claim_ids": [], "claim_text": "t", "citation_keys": ["k"], "evidence_basis": "{}", "human_decision_references": [], "relations": []}
    return base | {"trust": {"rubric_version": "1", "report_sha256": "a" * 64, "component_scores": dict.fromkeys(schemas.COMPONENTS, 4), "overall_score": 80, "trust_label": "moderate_trust"}} | kw


def test_snapshot_rules_name_each_fault(spark):
    anchors = lambda *rows: spark.createDataFrame([{"anchor_id": a, "selector": s, "human_decision_references": []} for a, s in rows], schemas.ANCHOR)
    good = ("x", {"kind": "claim", "claim_id": f"clm_{1:016x}"})
    faults = lambda claims, *rows: {r.check_name for r in violations(versions.snapshot_checks(spark.createDataFrame(claims, schemas.SNAPSHOT_CLAIM), anchors(*(rows or (good,))))).collect()}
    one = snapshot(1)
    assert faults([one]) == set()
    assert faults([one, one]) == {"claim id is unique"}
    assert faults([one, snapshot(2, relations=[{"predicate": "supports", "target_claim_id": "clm_9"}, {"predicate": "likes", "target_claim_id": one["claim_id"]}])]) == {"relation", "relation target exists"}
    assert faults([one], ("x", {"kind": "claim", "claim_id": f"clm_{7:016x}"})) == {"anchored claim exists"}
    assert faults([one], ("x", {"kind": "text", "source_path": "", "source_sha256": "b" * 64, "exact_quote": "q"}), good) == {"anchor selector", "anchor id is unique"}
    low = snapshot(1)
    low["trust"] = low["trust"] | {"overall_score": 101, "component_scores": dict.fromkeys(schemas.COMPONENTS, 5)}
    assert faults([low]) == {"component scores", "overall score"}


def test_frozen_report_is_compared(spark):
    told = lambda *rows: spark.createDataFrame(list(rows), f"claim_id string, component_scores struct<{','.join(f'{c}:int' for c in schemas.COMPONENTS)}>, overall_score int, trust_label string")
    claims = spark.createDataFrame([snapshot(1), snapshot(2)], schemas.SNAPSHOT_CLAIM)
    row = lambda i, score=80: (f"clm_{i:016x}", tuple([4] * 5), score, "moderate_trust")
    assert bag(versions.report_mismatches(claims, told(row(1), row(2)), "a" * 64, "1")) == []
    assert bag(versions.report_mismatches(claims, told(row(1), row(2, 75)), "a" * 64, "1")) == [(f"clm_{2:016x}",)]
    assert len(bag(versions.report_mismatches(claims, told(row(1)), "a" * 64, "1"))) == 1
    assert len(bag(versions.report_mismatches(claims, told(row(1), row(2)), "c" * 64, "1"))) == 2


def test_selector_text_keeps_places(spark):
    row = spark.createDataFrame([("  A “b”—c­ ﬁ\n",)], "t string").select(tx.selector_text("t").alias("s")).first().s
    assert row.text == 'A "b"-c fi' and row.place == [2, 3, 4, 5, 6, 7, 8, 10, 11, 11]


def test_requested_submissions_that_were_not_rendered(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "submission_id string")
    assert bag(submissions.not_rendered(ids("a", "b", "b"), ids("a", "c"))) == [("b",)]


def test_an_index_names_one_release(spark):
    release = lambda *x: spark.createDataFrame([(i,) for i in x], "release string")
    parts = spark.createDataFrame([("capsule", "r1"), ("export", "r2"), ("other", None)], "role string, release string")
    assert bag(releases.bundle_problems(release("r1", "r1"), parts)) == [("export",), ("other",)]
    for index in (release("r1", "r2"), release("r1").limit(0)):
        with pytest.raises(Rejected):
            releases.bundle_problems(index, parts)


def test_constants_are_compared_with_their_order():
    rule = contracts.compile_schema({"const": {"a": 1, "b": [True]}})
    assert rule({"a": 1, "b": [True]}, "$") == [] and rule({"b": [True], "a": 1}, "$") and rule({"a": 1, "b": [1]}, "$")
