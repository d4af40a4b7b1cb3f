"""Release contracts and projections, each rule broken once."""

import copy

import pytest
from pyspark.sql import functions as F

from claimloom.plans import releases as rl
from claimloom.plans import submissions
from claimloom.sources import schemas

SHA = "a" * 64


def failed(checks):
    return {c.name for c in checks if c.violations().head(1)}


def manifest(**kw):
    return {"release_id": "r", "released_at": "2025-01-02T00:00:00Z", "generated_at": "2025-01-01T00:00:00Z", "artifacts": [{"role": r, "path": f"{r}.x", "media_type": "a/b", "bytes": 1, "sha256": SHA} for r in rl.REQUIRED_ROLES], "gates": [{"gate_id": "g", "status": "passed"}], "accepted_submissions": [{"submission_id": "s", "revision": 1, "sha256": SHA}]} | kw


def capsule(**kw):
    release = {"review_id": "review-abc", "release_id": "release-abcdefgh", "version": "1.0.0", "manifest_sha256": SHA, "frozen_at": "2025-01-05T00:00:00Z"}
    artifacts = [{"path": f"{r}.x", "role": r, "media_type": "a/b", "expected_sha256": SHA} for r in ("code", "data", "environment", "output")]
    return {"capsule_id": "capsule-abcdefgh", "release": release, "created_at": "2025-01-04T00:00:00Z", "status": "passed", "license": "https://l.org", "execution": {"command": ["run"], "started_at": "2025-01-01T00:00:00Z", "completed_at": "2025-01-02T00:00:00Z", "exit_code": 0}, "artifacts": artifacts} | kw


@pytest.mark.parametrize("change,name", [({}, None), ({"artifacts": manifest()["artifacts"][:3]}, "required roles"), ({"artifacts": manifest()["artifacts"] * 2}, "artifact paths are unique"), ({"accepted_submissions": manifest()["accepted_submissions"] * 2}, "accepted revisions are unique"), ({"generated_at": "2026-01-01T00:00:00Z"}, "generated before release"), ({"gates": [{"gate_id": "g", "status": "failed"}]}, "gates passed")])
def test_manifests(spark, change, name):
    assert failed(rl.manifest_checks(spark.createDataFrame([manifest(**change)], rl.MANIFEST))) == ({name} if name else set())


@pytest.mark.parametrize("change,name", [({}, None), ({"capsule_id": "x"}, "capsule id"), ({"created_at": "2024-01-01T00:00:00Z"}, "times in order"), ({"license": "MIT"}, "license"), ({"status": "odd"}, "status"), ({"status": "failed"}, "exit code suits the status"), ({"artifacts": capsule()["artifacts"][1:]}, "all roles"), ({"execution": capsule()["execution"] | {"command": []}}, "command"), ({"release": capsule()["release"] | {"version": "1.0"}}, "release")])
def test_capsules(spark, change, name):
    assert failed(rl.capsule_checks(spark.createDataFrame([capsule(**copy.deepcopy(change))], rl.CAPSULE))) == ({name} if name else set())


def test_references_between_records(spark):
    rows = spark.createDataFrame([manifest()], rl.MANIFEST)
    known = lambda *x: spark.createDataFrame(list(x), "submission_id string, revision int, sha256 string")
    assert rl.submission_references(rows, known(("s", 1, SHA))).count() == 0
    assert rl.submission_references(rows, known(("s", 1, "b" * 64), ("s", 2, SHA))).count() == 1
    index = spark.createDataFrame([("r1",)], "release string")
    parts = spark.createDataFrame([("diff", "r1"), ("capsule", "r2"), ("export", None)], "role string, release string")
    assert {r.role for r in rl.bundle_problems(index, parts).collect()} == {"capsule", "export"}
    provenance = spark.createDataFrame([("https://x", "1", "2", False, ("D01", "proposed"))], "originating_repository string, rubric_version string, method_version string, adjudicated boolean, unit struct<decision_id:string,status:string>")
    make = lambda df: rl.provenance_checks(df, ["adjudicated"], {"unit": ("D01", "proposed")}, F.col("rubric_version"))
    assert failed(make(provenance)) == set()
    assert failed(make(provenance.withColumn("adjudicated", F.lit(True)).withColumn("originating_repository", F.lit("ftp://x")))) == {"adjudicated is off", "originating repository"}
    compared = spark.createDataFrame([("a--a", "unchanged"), ("none--b", "added"), ("c--none", "added")], "comparison_id string, status string")
    anchors = spark.createDataFrame([("x", "current"), ("x", "lost")], "anchor_id string, status string")
    assert failed(rl.diff_checks(compared, anchors)) == {"anchor is unique", "anchor status", "added and removed have one side"}


def test_gate_and_projections(spark):
    context = {"cite_key": "k", "doi": "10.1/a", "passages": [{"text": "p", "verification_status": "verified"}, {"text": "q"}], "supports_claim_atoms": ["a1"]}
    claims = spark.createDataFrame([{"claim_id": "c1", "citation_contexts": [context], "citation_keys": ["k"]}, {"claim_id": "c2", "citation_contexts": [], "citation_keys": ["x", "y"]}], schemas.CLAIM)
    counts = rl.evidence_counts(claims)
    assert counts == {"claims": 2, "citation_contexts": 1, "verified_passages": 1}
    good = {"status": "passed", "checks": {"a": True}, "failures": [], "counts": counts}
    assert rl.committed_gate(good, counts) == [] and rl.committed_gate(good | {"checks": {"a": 1}, "status": "failed"}, counts | {"claims": 3}) == ["not passing", "check a", "count claims"]
    assert sorted((r.claim_id, r.ord, r.cite_key, r.doi) for r in rl.references(claims).collect()) == [("c1", 0, "k", "10.1/a"), ("c2", 0, "x", None), ("c2", 1, "y", None)]
    bare = claims.where("claim_id = 'c1'").select(F.col("citation_contexts")[0].alias("c"))
    none = F.col("c").withField("passages", F.array().cast(f"array<{schemas.PASSAGE}>"))
    shown = bare.select(rl.shown_passages(F.col("c"), F.lit("old")).alias("own"), rl.shown_passages(none, F.lit("old")).alias("legacy"), rl.shown_passages(none, F.lit(None).cast("string")).alias("none")).first()
    assert (len(shown.own), [(p.text, p.verification_status) for p in shown.legacy], shown.none) == (2, [("old", "legacy")], [])
    assert rl.blinded(spark.createDataFrame([(1, "n", "w")], "id int, comparison_name string, what_it_reveals string")).columns == ["id"]
    findings = spark.createDataFrame([("c", f"k{i}", "replicated" if i % 2 else "contested", i) for i in range(8)] + [("c", "z", "unknown", 99)], "cluster string, cite_key string, replication_status string, citation_count int")
    assert {r.cite_key for r in rl.condensed(findings, 2).collect()} == {"k7", "k5", "k6", "k4"}


def test_public_submissions_and_directives(spark):
    rows = spark.createDataFrame([{"submission_id": "s", "revision": 1, "submitter": {"display_name": ""}, "target": {"review_version": "1.0.0"}, "moderation": {"state": "accepted", "events": [{"event": "submitted"}, {"event": "corrected"}]}, "content": {"title": "T"}}], schemas.SUBMISSION)
    r = submissions.public(rows).first()
    assert (r.display_name, r.visibility, r.title, r.stance, r.kind) == ("Anonymous reviewer", "pseudonymous", "T", "no_position", "comment")
    names = {c.name for c in submissions.checks(rows) if c.violations().head(1)}
    assert "accepted state has its event" in names and "state follows the last event" not in names
    options = {"claim-id": "clm_" + "a" * 16, "review-version": "1.2.0", "release-manifest-sha256": SHA, "submission-ids": "a, b"}
    make = lambda **kw: spark.createDataFrame([("f", 0, options | kw)], "file string, ord int, options map<string,string>")
    assert failed(submissions.directive_checks(make())) == set()
    assert failed(submissions.directive_checks(make(**{"review-version": "1.2", "submission-ids": "a,a"}))) == {"review version", "submission ids are unique"}


def test_canonical_json_of_every_row(spark):
    import json

    from claimloom.sources import sinks

    schema = "a string, b array<struct<x:int,y:array<string>>>, c map<string,struct<z:boolean,w:double>>, d struct<e:bigint,f:string>, g array<array<int>>"
    nasty = "q\" b\\ /\n\t\r\b\f \x01\x1f\x7f \\u001F é 漢 \U0001f600 \u2028"
    rows = [
        (nasty, [{"x": 1, "y": [nasty, None, ""]}, {"x": None, "y": []}, None], {"k\"é": {"z": True, "w": 2.5}}, {"e": -5, "f": None}, [[], [1, 2], None]),
        (None, [], {}, None, None), ("", None, None, {"e": 2**53, "f": "x"}, [[]]), ("x", [{"x": 0, "y": None}], {"b": {"z": False, "w": 40.0}}, {"e": None, "f": "\\\\u001A"}, []),
    ]
    frame = spark.createDataFrame(rows, schema)
    text = sinks.canonical_json(F.struct(*frame.columns), frame.schema)
    whole = lambda v: {k: whole(x) for k, x in v.items()} if isinstance(v, dict) else [whole(x) for x in v] if isinstance(v, list) else int(v) if isinstance(v, float) and v.is_integer() else v
    members = frame.columns
    docs = [whole(dict(zip(members, r))) for r in rows]
    got = [r.t for r in frame.select(text.alias("t")).collect()]
    assert [g + "\n" for g in got] == [sinks.stable_json(d) for d in docs]
    assert [json.loads(g) for g in got] == docs
    ordered = spark.range(1).select(F.create_map(F.lit("z"), F.lit(1), F.lit("a"), F.lit(None).cast("int")).alias("m"))
    assert ordered.select(sinks.canonical_json(F.col("m"), ordered.schema["m"].dataType)).first()[0] + "\n" == sinks.stable_json({"z": 1, "a": None})
    assert [r.h for r in sinks.canonical_digest(frame, members, "h").collect()] == [sinks.digest(d) for d in docs]


def test_named_submissions_are_digested(spark):
    from claimloom.sources import sinks

    docs = [{"submission_id": "s", "revision": 1, "body": "é"}, {"submission_id": "t", "revision": 2, "body": None}]
    there = spark.createDataFrame([d | {"sha256": "stored"} for d in docs], "submission_id string, revision int, body string, sha256 string")
    named = [(d["submission_id"], d["revision"], sinks.digest(d)) for d in docs]
    schema = "release_id string, accepted_submissions array<struct<submission_id:string,revision:int,sha256:string>>"
    columns = ["submission_id", "revision", "body"]
    assert rl.submission_references(spark.createDataFrame([("r", named)], schema), there, columns).count() == 0
    assert rl.submission_references(spark.createDataFrame([("r", named)], schema), there.withColumn("body", F.lit("changed")), columns).count() == 2


def test_canonical_json_mends_control_digits_only_where_there_are_any(spark):
    from claimloom.sources import sinks

    texts = ["plain", "a\x1fb\x0b", "back\\u001F", "\\\x1c", 'q"\n', ""]
    rows = spark.createDataFrame([(x,) for x in texts], "v string")
    text = sinks.canonical_json(F.struct("v"), rows.schema)
    assert [r.t + "\n" for r in rows.select(text.alias("t")).collect()] == [sinks.stable_json({"v": x}) for x in texts]
    assert "case when contains(" in rows.select(text.alias("t"))._jdf.queryExecution().analyzed().toString().lower()
