"""Sources, sinks, contracts, evidence, authorship and streams on small records."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators import relational as rel
from claimloom.plans import authorship, contracts, evidence
from claimloom.sources import documents, files, schemas, sinks
from claimloom.streaming import feeds

BIB = """@article{smith2020,
  title = {A},
  author = {Smith, Ann and  Lee, Bo},
  doi = {10.1000/ABC},
}

@misc{lee2021, title = "B"}
@article{smith2020, doi = "10.1000/new", author = {Solo, Han}}
"""

MARKDOWN = """# Title

First *prose* with [a link](http://x) and `code` {cite:p}`k1, k2`.

:::{trust-claim}
:claim-id: clm_1
:claim: "Quoted, here"
:claim-id: clm_2
:::

(anchor)=

Second paragraph
on two lines.

*a caption*

![fig](a.png)
"""


def test_bibliography_and_markdown(spark):
    bib = {r.cite_key: (r.doi, r.authors) for r in documents.bibliography(spark.createDataFrame([(BIB,)], "text string")).collect()}
    assert bib == {"smith2020": ("10.1000/new", ["Solo, Han"]), "lee2021": (None, [])}
    md = spark.createDataFrame([("a.md", MARKDOWN), ("b.md", "")], "file string, text string")
    got = documents.paragraphs(md).orderBy("paragraph_index").collect()
    assert [(r.file, r.paragraph_index, r.text) for r in got] == [("a.md", 1, "First prose with a link and code ."), ("a.md", 2, "Second paragraph on two lines."), ("a.md", 3, "fig")]
    assert [r.options for r in documents.directives(md).collect()] == [{"claim-id": "clm_2", "claim": "Quoted, here"}]
    assert [(r.heading_id, r.level) for r in documents.headings(md).collect()] == [("title", 1)]
    assert {r.file: r.has_figures for r in documents.has_figures(md).collect()} == {"a.md": True, "b.md": False}
    assert md.select(tx.cite_keys("text").alias("k")).first().k == ["k1", "k2"]


def test_json_files_and_confinement(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"a": 1, "b": "x"}')
    (tmp_path / "bad.json").write_text("{")
    rows = documents.json_documents(spark, f"file://{tmp_path}/*.json", "a int, b string").cache().collect()
    assert sorted((r.a, r._corrupt_record is None) for r in rows if r.a) == [(1, True)] and sum(r._corrupt_record is not None for r in rows) == 1
    with pytest.raises(Exception):
        documents.json_documents(spark, f"file://{tmp_path}/bad.json", "a int", fail_fast=True).collect()
    assert documents.confined(str(tmp_path), "good.json").endswith("good.json")
    for name in ("../x.json", "none.json", "/etc/passwd"):
        with pytest.raises(documents.UnsafePath):
            documents.confined(str(tmp_path), name)
    assert documents.bounded_text(spark, f"file://{tmp_path}/good.json").first().text.startswith("{")
    with pytest.raises(ValueError, match="allowed"):
        documents.bounded_text(spark, f"file://{tmp_path}/good.json", most=3)
    listed = files.digest_index(spark, f"file://{tmp_path}/good.json").first()
    assert (listed.bytes, listed.sha256) == (18, hashlib.sha256(b'{"a": 1, "b": "x"}').hexdigest())
    (tmp_path / "env.json").write_text(json.dumps({"schema_version": "1.0.0", "submissions": [{"submission_id": "s", "revision": 1}] * 2}))
    with pytest.raises(ValueError, match="twice"):
        documents.submissions_envelope(spark, f"file://{tmp_path}/env.json", schemas.SUBMISSION)


def test_sections_take_the_first_name_form(spark, tmp_path):
    (tmp_path / "evidence_section_02.json").write_text('{"v": "old name"}')
    (tmp_path / "package_02.json").write_text('{"v": "new name"}')
    (tmp_path / "package_03.json").write_text('{"v": "only"}')
    rows = documents.sections(spark, str(tmp_path), "v string", ["package_{n}.json", "evidence_section_{n}.json", "none_{n}.json"])
    assert {r.section: r.v for r in rows.collect()} == {2: "new name", 3: "only"}
    assert documents.sections(spark, str(tmp_path), "v string", ["absent_{n}.json"]).count() == 0


def test_small_yaml():
    text = "affiliations:\n  - id: a1\n    name: 'The: Place'\ncontributors:\n- name: Ann Lee\n  corresponding: true\n  roles: [Writing, \"Data curation\"]\n  levels:\n    - role: Writing\n      level: lead\n  left:\n"
    assert documents.small_yaml(text) == {"affiliations": [{"id": "a1", "name": "The: Place"}], "contributors": [{"name": "Ann Lee", "corresponding": True, "roles": ["Writing", "Data curation"], "levels": [{"role": "Writing", "level": "lead"}], "left": None}]}


def test_text_functions(spark):
    row = spark.createDataFrame([("On-Line  Text", "10.1/x", "https://doi.org/10.1/X ", "a | b\nc <&", "Ann Bo Lee", "https://h/p", "https://u@h/p")], "a string, b string, c string, d string, e string, f string, g string")
    got = row.select(
        tx.stable_token("a", "x"), tx.radar_doi("c"), tx.markdown_cell("d"), tx.escape_html("d"), tx.initials("e"), tx.last_name("e"), tx.safe_https("f"), tx.safe_https("g"), tx.truncate("a", 3), tx.fold_role("a"),
        tx.title_label(F.lit("data_curation OF-x")), tx.safe_relative_path(F.lit("a/b.c")), tx.safe_relative_path(F.lit("a/../b")), tx.extract_doi(F.lit("see 10.1234/ab-c, ok")), tx.split_list(F.lit(" a, ,b")), tx.title_overlap(F.lit("a b c"), F.lit("A b d")),
        tx.shared_content_words(F.lit("Cells divide with speed"), F.lit("speed of cells")), tx.ascii_fold(F.lit("Café")), tx.braces_balance(F.lit("{a}}")), tx.malformed_count(F.lit("a,, b {cite:p} x")), tx.canonical_author(F.lit("M{\\\"u}ller, J.")), tx.unquoted(F.lit("'x'")), tx.source_path(F.lit("/r/content/a/content/b.md")),
    ).first()
    assert list(got) == ["on-line-text", "10.1/x", "a \\| b c <&", "a | b\nc &lt;&amp;", "ABL", "Lee", True, False, "On-…", "on line text", "Data Curation OF X", True, False, "10.1234/ab-c", ["a", "b"], 2 / 3, 2, "Cafe", False, 2, "m u ller j", "x", "content/b.md"]
    assert tx.find_unique("aXa", "a", "", "") is None and tx.find_unique("say “it’s” so", '"it\'s"', "say", "so") == (4, 10)
    assert tx.find_unique("aaa", "aa", "", "") is None and tx.find_unique("one two one", "one", "two ", "") == (8, 11)


def test_values(spark):
    row = spark.range(1).select(vl.band_text(F.lit(None).cast("double")), vl.band_text(F.lit(70.0)), vl.multiple_of(F.lit(15), 5), vl.strict_moment(F.lit("2025-01-01")).isNull(), vl.in_order(F.lit(1), F.lit(2), F.lit(2)), vl.iso_utc(F.lit("2025-01-01T00:00:00Z").cast("timestamp")), *vl.threshold_of(F.lit("<2% new unique in last 100")), vl.or_default(F.lit(""), "d")).first()
    assert list(row) == ["pending", "moderate_trust", True, True, True, "2025-01-01T00:00:00.000Z", 0.02, 100, "d"]


SCHEMA = {
    "type": "object", "required": ["id", "kind"], "additionalProperties": False,
    "properties": {"id": {"$ref": "#/$defs/id"}, "kind": {"enum": ["a", "b"]}, "n": {"type": "integer", "multipleOf": 5, "maximum": 100}, "at": {"type": "string", "format": "date-time"}, "list": {"type": "array", "uniqueItems": True, "contains": {"const": 1}, "items": {"anyOf": [{"type": "integer"}, {"type": "null"}]}}, "x": {"oneOf": [{"type": "string"}, {"type": "integer", "minimum": 3}]}, "y": {"$ref": "other.json#/y"}},
    "if": {"properties": {"kind": {"const": "b"}}}, "then": {"required": ["n"]}, "$defs": {"id": {"type": "string", "pattern": "^i[0-9]+$", "maxLength": 4}},
}


@pytest.mark.parametrize("change,bad", [({}, False), ({"id": "x"}, True), ({"id": "i12345"}, True), ({"kind": "c"}, True), ({"kind": "b"}, True), ({"kind": "b", "n": 5}, False), ({"n": 7}, True), ({"n": 5.0}, False), ({"n": True}, True), ({"at": "2025-01-01"}, True), ({"at": "2025-01-01T00:00:00Z"}, False), ({"list": [1, None]}, False), ({"list": [1, 1]}, True), ({"list": [2]}, True), ({"list": [1, "s"]}, True), ({"x": 2}, True), ({"x": 3}, False), ({"y": "no"}, True), ({"y": False}, False), ({"z": 1}, True)])
def test_contracts(change, bad):
    rule = contracts.compile_schema(SCHEMA, {"other.json": {"y": {"type": "boolean"}}})
    assert bool(rule({"id": "i1", "kind": "a"} | change, "$")) == bad


def test_contracts_on_columns_and_unknown_keywords(spark):
    schema = {"type": "object", "properties": {"a~b": {"type": "string"}}, "allOf": [{"$ref": "#/properties/a~0b"}]}
    with pytest.raises(contracts.UnknownKeyword):
        contracts.compile_schema({"dependentRequired": {}})
    assert contracts.pointer(schema, "#/properties/a~0b") == {"type": "string"}
    rows = spark.createDataFrame([('{"a": 1}',), ('{"a": "s"}',), ("{",), (None,)], "j string")
    assert [len(r[0]) for r in rows.select(contracts.problems(F.col("j"), {"properties": {"a": {"type": "string"}}})).collect()] == [1, 0, 1, 1]


OTHERS = {"other.json": {"y": {"type": "boolean"}}}
#: Pairs of a schema and documents, for which both forms of a contract must tell the same problems.
CONTRACTS = {
    "all": (SCHEMA, [{"id": "i1", "kind": "a"} | c for c in ({}, {"id": "x"}, {"id": "i12345"}, {"id": 5}, {"kind": "c"}, {"kind": "b"}, {"kind": "b", "n": 5}, {"n": 7}, {"n": 5.0}, {"n": 5.5}, {"n": True}, {"n": 105}, {"n": None}, {"at": "2025-01-01"}, {"at": "2025-02-30T00:00:00Z"}, {"at": "2025-01-01T00:00:00.5+02:00"}, {"list": [1, None]}, {"list": [1, 1]}, {"list": [2]}, {"list": []}, {"list": [1, "s", [1]]}, {"list": {"a": 1}}, {"x": 2}, {"x": 3}, {"x": "s"}, {"x": None}, {"y": "no"}, {"y": False}, {"z": 1, "aa": {"b": 2}})] + [{}, [], "text", 5, None, {"id": "i1"}]),
    "types": ({"properties": {k: {"type": k} for k in ("object", "array", "string", "boolean", "null", "number", "integer")} | {"some": {"type": ["string", "null"]}}}, [{k: v} for k in ("object", "array", "string", "boolean", "null", "number", "integer", "some") for v in ({}, {"a": 1}, [], [1], "", "s", True, None, 0, -1, 2.0, 2.5, 1e30, 12345678901234567890)]),
    "numbers": ({"items": {"minimum": 1, "maximum": 9, "exclusiveMinimum": 1, "multipleOf": 2}}, [[0, 1, 2, 3, 9, 10, 2.5, "x", True, None, {"a": 1}], []]),
    "texts": ({"items": {"minLength": 2, "maxLength": 3, "pattern": "b"}}, [["", "a", "ab", "abc", "bbbb", "\U0001f600b", 7, None]]),
    "uris": ({"items": {"format": "uri"}}, [["https://a", "http://b", "urn:x", "ftp://c", "x", 1]]),
    "objects": ({"minProperties": 2, "propertyNames": {"pattern": "^[a-z.' ]+$"}, "additionalProperties": {"type": "integer"}, "properties": {"it's": {"const": 1}, "a.b": {"type": "string"}, "'\"": {"type": "string"}}, "required": ["a.b"]}, [{}, {"a": 1}, {"a.b": "x", "b": 2}, {"a.b": 1, "it's": 2}, {"a": {"b": "x"}, "A": 1, "B": "x"}, {"a.b": "x", "it's": 1}, {"a.b": "x", "'\"": 5}, {"a.b": "x", "'\"": "s"}]),
    "constants": ({"items": {"enum": [1, "1", True, None, [1, "a"], {"k": [1, {"x": None}]}, 2.5]}}, [[1, "1", True, None, [1, "a"], {"k": [1, {"x": None}]}, 2.5, 0, "true", False, [1], {"k": 1}, {}, 1.0]]),
    "branches": ({"oneOf": [{"type": "string"}, {"maximum": 5}], "not": {"const": 3}, "anyOf": [{"type": "integer"}, {"minLength": 2}], "allOf": [{"type": ["integer", "string", "array"]}, True]}, [1, 3, 7, "a", "ab", [1], None, 2.5]),
    "counts": ({"contains": {"minimum": 5}, "minContains": 2, "maxContains": 3, "minItems": 2, "maxItems": 4, "uniqueItems": True}, [[], [5], [5, 6], [5, 6, 7, 8], [1, 5, 6, 2, 7], [{"a": 1}, {"a": 1}, 5, 6], [5, 6, [5], [5]], "no"]),
    "conditions": ({"if": {"required": ["a"]}, "then": {"properties": {"a": {"type": "string"}}}, "else": {"required": ["b"]}}, [{"a": "x"}, {"a": 1}, {"b": 1}, {}, [], 5]),
    "nothing": ({"properties": {"a": False}, "items": False}, [{"a": 1}, {"b": 1}, [], [1, 2]]),
    "deep": ({"properties": {"rows": {"items": {"properties": {"cells": {"items": {"type": "integer"}}}, "required": ["cells"]}}}}, [{"rows": [{"cells": [1, "x"]}, {}, {"cells": [[2]]}]}, {"rows": 5}]),
}


def test_contracts_as_columns_tell_what_the_rules_tell(spark):
    rows = [(name, str(i), json.dumps(d)) for name, (_, ds) in CONTRACTS.items() for i, d in enumerate(ds)]
    told = {}
    schemas_ = {name: schema for name, (schema, _) in CONTRACTS.items()}
    found = contracts.contract_problems(spark.createDataFrame(rows, "schema string, name string, text string"), schemas_, OTHERS)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for r in found.collect():
        told.setdefault((r.schema, r.name), []).append(r.problem)
    for name, (schema, documents_) in CONTRACTS.items():
        rule = contracts.compile_schema(schema, OTHERS)
        for i, d in enumerate(documents_):
            assert sorted(told.get((name, str(i)), [])) == sorted(rule(d, "$")), (name, d)
    assert [r.problem for r in contracts.contract_problems(spark.createDataFrame([("gone", "x", "{}")], "schema string, name string, text string"), schemas_, OTHERS).collect()] == ["$: no such schema"]


def test_a_schema_that_refers_to_itself(spark):
    tree = {"$ref": "#/$defs/node", "$defs": {"node": {"type": "object", "required": ["v"], "properties": {"kids": {"items": {"$ref": "#/$defs/node"}}}}}}
    rows = spark.createDataFrame([(json.dumps({"v": 1, "kids": [{"v": 2, "kids": [{}]}]}),), ('{"v": 1}',)], "j string").select(contracts.problems(F.col("j"), tree).alias("p"))
    assert [r.p for r in rows.collect()] == [["$.kids[0].kids[0].v: missing"], []]
    with pytest.raises(contracts.UnknownKeyword):
        contracts.problems(F.lit("{}"), {"properties": {"a": {"dependentRequired": {}}}})


def test_conflict_shapes_become_one(spark):
    shapes = [{"side_a": {"claim": "A", "doi": "10.1/A"}, "side_b": "B says 10.1234/b."}, {"paper_a_claim": "A", "paper_b_claim": "B", "paper_a_doi": "10.1/a", "nature_of_conflict": "size"}, {"sides": [{"position": "A"}, {"position": "B"}], "paper_dois": ["10.1/a", "10.1/b"], "resolution_status": "resolved"}, {"position_a": "A"}]
    got = evidence.conflicts(spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)], "i int, conflict string")).orderBy("i").collect()
    assert [r.side_a for r in got] == ["A"] * 4 and [r.doi_a for r in got] == ["10.1/a", "10.1/a", "10.1/a", None]
    assert got[0].doi_b == "10.1234/b." and got[3].side_b == "—" and [r.resolution for r in got] == ["unresolved", "unresolved", "resolved", "unresolved"] and got[1].topic == "size"


def test_evidence_rollups(spark):
    findings = spark.createDataFrame([(1, "c1", "k1", "10.1/a", "x", "fulltext", "0.5", 10, "Independently replicated"), (1, "c1", "k2", "10.1/b", "y", "abstract_only", None, None, "contested"), (2, "c2", "k3", "10.1/c", "z", "fulltext", "1", 5, "odd")], "section int, cluster string, cite_key string, doi string, claim string, text_access string, effect_size string, n_sample int, replication_status string")
    empty = spark.createDataFrame([], "section int")
    packages = spark.createDataFrame([(1, 0, 7), (2, None, None), (3, 4, 1)], "section int, unique_papers int, total_findings int")
    got = {r.section: (r.n_papers, r.n_findings, r.replicated_percent) for r in evidence.section_rollup(findings, empty, empty, packages).collect()}
    assert got == {1: (7, 2, 50.0), 2: (1, 1, 0.0), 3: (4, 0, 0.0)}
    assert {r.grain: r.passed for r in evidence.rates(findings).collect()} == {"c1": True, "c2": False, "overall": True}
    groups = spark.createDataFrame([(1, "g", ["k1", "kx"], ["k2"])], "section int, group_id string, supporting_findings array<string>, counter_findings array<string>")
    assert {(r.cite_key, r.side, r.resolved) for r in evidence.argument_members(groups, findings).collect()} == {("k1", "supporting", True), ("kx", "supporting", False), ("k2", "counter", True)}
    tiers = spark.createDataFrame([("high", 0.6)], "tier string, share double")
    assert evidence.tier_floors(spark.createDataFrame([("high", 10, 5)], "tier string, target int, n int"), tiers).first().passed is False
    papers = spark.createDataFrame([("f", "EU", "x"), ("f", "US", "x")], "comparison_id string, region string, level string")
    assert evidence.homogeneous(papers, ["region", "level"]).first().mixed_fields == ["region"]
    title = "Deep cells divide in the dark"
    full = {"doi": "10.1/a", "title": title, "authors": ["Müller, J.", "Lee, Kim"], "year": 2020, "journal": "Cell & Life", "volume": "4", "pages": "1-9", "abstract": "We saw 40 % and 3.5 mV."}
    cases = {
        "same": ({}, "VERIFIED"), "form": ({"authors": ["MULLER J", "Lee Kim"], "journal": "Cell Life", "title": title.upper()}, "VERIFIED"), "no record": ({"doi": "10.1/zz"}, "HALLUCINATED"), "title": ({"title": "Deep cells of another kind sleep"}, "CHIMERIC"), "half": ({"title": "Deep cells divide in light"}, "VERIFIED"),
        "other authors": ({"authors": ["Wong, A."]}, "CHIMERIC"), "initials": ({"authors": ["Müller, K.", "Lee, Kim"]}, "MINOR"), "injected": ({"authors": ["Müller, J.", "Lee, Kim", "Wong, D."]}, "MINOR"), "missing": ({"authors": ["Müller, J."]}, "MINOR"), "year": ({"year": 2021}, "MINOR"), "journal": ({"journal": "Nature"}, "CHIMERIC"),
        "year before journal": ({"year": 2019, "journal": "Nature"}, "MINOR"), "volume": ({"volume": "5"}, "MINOR"), "pages": ({"pages": "2-9"}, "MINOR"), "number": ({"claim": "It grew by 41 %."}, "MISATTRIBUTED"), "numbers": ({"claim": "It grew by 40 % at 3.5 mV."}, "VERIFIED"), "unknown year": ({"year": None}, "VERIFIED"),
    }
    schema = "cite_key string, doi string, title string, authors array<string>, year int, journal string, volume string, pages string, claim string"
    cited = spark.createDataFrame([{"cite_key": k, "claim": "It grew."} | full | d for k, (d, _) in cases.items()], schema)
    meta = spark.createDataFrame([full], "doi string, title string, authors array<string>, year int, journal string, volume string, pages string, abstract string")
    assert {r.cite_key: r.verdict for r in evidence.citation_verdict(cited, meta).collect()} == {k: v for k, (_, v) in cases.items()}
    short = [spark.createDataFrame([("k", "10.1/a", "Deep cells", a, 2020)], "cite_key string, doi string, title string, first_author string, year int") for a in ("Müller", "Wong")]
    assert [evidence.citation_verdict(x, short[0].drop("cite_key")).first().verdict for x in short] == ["VERIFIED", "CHIMERIC"]



def test_authorship(spark):
    people = spark.createDataFrame([(0, "Ann Lee", ["Writing", "Data curation"], ["a1"], "2020-01", None), (1, "Bo Zed", ["writing"], ["a1", "a2"], "2021-01", "2022-01"), (2, "Cy Ash", [], [], None, None)], "ord int, person string, roles array<string>, affiliations array<string>, joined string, left string")
    named = authorship.affiliated(people, spark.createDataFrame([("a1", "Uni")], "id string, name string"))
    people = people.join(named, "person", "left")
    assert {r.institution: r.members for r in authorship.institutions(people).collect()} == {"Uni": ["Ann Lee", "Bo Zed"], "a2": ["Bo Zed"], "__none__": ["Cy Ash"]}
    roles = spark.createDataFrame([(0, "Writing"), (1, "Software")], "role_ord int, role string")
    assert [r.members for r in authorship.role_members(people, roles).collect()] == [["Ann Lee", "Bo Zed"]]
    edges = authorship.network(people, spark.createDataFrame([("Ann Lee", "intro"), ("Cy Ash", "intro")], "person string, section string"))
    assert {(r.i, r.j, r.weight) for r in edges.collect()} == {(0, 1, 1), (0, 2, 1)}
    stats = authorship.network_stats(people, edges).first()
    assert (stats.n_links, tuple(stats.strongest)) == (2, (0, 2))
    levels = spark.createDataFrame([("Bo Zed", "Writing", "lead"), ("Ann Lee", "writing", "supporting")], "person string, role string, level string")
    assert [r.person for r in authorship.by_level(people, levels, "Writing").collect()] == ["Bo Zed", "Ann Lee", "Cy Ash"]
    assert {r.institution: r.number for r in authorship.affiliation_numbers(people).collect()} == {"Uni": 1, "a2": 2}
    assert [(r.person, r.left_percent) for r in authorship.timeline(people, "2022-01").orderBy("person").collect()] == [("Ann Lee", 0.0), ("Bo Zed", 50.068)]
    assert [r.person for r in authorship.matches(people, "UNI").orderBy("ord").collect()] == ["Ann Lee", "Bo Zed"]


def test_sinks(spark, tmp_path, capsys):
    target = str(tmp_path / "out" / "x.json")
    assert sinks.fail_safe(target, lambda: {"b": 1, "a": "é"}) and open(target, encoding="utf-8").read() == '{\n  "b": 1,\n  "a": "é"\n}\n'
    assert not sinks.fail_safe(target, lambda: 1 / 0) and json.load(open(target))["status"] == "failed_safe"
    sinks.publish({"a": 1})
    assert capsys.readouterr().out == '{\n  "a": 1\n}\n'
    assert sinks.digest({"a": 1}) == hashlib.sha256(b'{\n  "a": 1\n}\n').hexdigest()
    rows = spark.createDataFrame([(2, "x|y"), (1, None)], "n int, t string")
    assert sinks.markdown_table(rows, ["n", "t"], "n") == "| n | t |\n| --- | --- |\n| 1 |  |\n| 2 | x\\|y |\n"
    claim = spark.createDataFrame([{"claim_id": "clm_1", "claim_text": "t", "citation_keys": ["b", "a"], "trust": {"rubric_version": "1", "overall_score": 90, "trust_label": "high_trust"}, "relations": [{"predicate": "supports", "target_claim_id": "clm_2"}]}], schemas.SNAPSHOT_CLAIM)
    node = json.loads(sinks.nanopublications(claim, "https://e.org/", "r1").first().node)
    assert node["@id"] == "https://e.org/r1/claims/clm_1" and node["https://schema.org/citation"] == ["https://e.org/r1/claims/clm_2"] and node["http://purl.org/spar/cito/disputes"] == []
    capsule = spark.createDataFrame([("c", "2025-01-01", "passed", "https://l", ["run"])], "capsule_id string, created_at string, status string, license string, command array<string>")
    listed = spark.createDataFrame([(f"{r}.x", r, "text/plain", 1, "0" * 64) for r in sinks.ROLE_TYPES], "path string, role string, media_type string, bytes int, sha256 string")
    nodes = [json.loads(r.node) for r in sinks.crate_nodes(capsule, listed).collect()]
    assert [n["@id"] for n in nodes] == ["ro-crate-metadata.json", "./", "#execution", "code.x", "data.x", "environment.x", "output.x"] and nodes[2]["result"] == [{"@id": "output.x"}]
    wrong = spark.createDataFrame([("code.x", "1" * 64)], "path string, expected_sha256 string")
    assert {r.problem for r in sinks.capsule_problems(listed.where("role <> 'data'"), wrong).collect()} == {"no file of role data", "digest of code.x"}
    gate = sinks.gate_document("g", spark.createDataFrame([("a", True), ("b", False)], "check_name string, passed boolean"))
    assert gate["status"] == "failed" and gate["failures"] == ["b"]


def test_relational_operators_hold_under_repartition(spark):
    rows = spark.range(200).select((F.col("id") % 7).alias("k"), "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("x"))
    for n in (1, 5):
        part = rows.repartition(n)
        assert [r.id for r in rel.keep_first(part, ["k"], "id").orderBy("k").collect()] == list(range(7))
        assert [r.id for r in rel.keep_most_complete(part, ["k"], ["x"], "id").orderBy("k").collect()] == [0, 15, 9, 3, 18, 12, 6]
        same = rel.version_diff(part, part, "id", ["k", "x"])
        assert same.where("status <> 'unchanged'").count() == 0
    spans = spark.createDataFrame([("p", 1, 0, 5), ("p", 2, 4, 9), ("p", 3, 9, 10), ("q", 4, 0, 9)], "p string, id int, start int, end int")
    assert [(r.left_id, r.right_id, r.clip_start, r.clip_end) for r in rel.overlaps(spans, ["p"], "id").collect()] == [(1, 2, 4, 5)]
    edges = spark.createDataFrame([(1, 2, 5.0), (1, 3, 9.0), (3, 4, 1.0), (4, 1, 1.0)], "u int, v int, s double")
    seeds = spark.createDataFrame([(1,)], "node int")
    assert {(r.node, r.round) for r in rel.snowball(seeds, edges, 3, both=False).collect()} == {(1, 0), (2, 1), (3, 1), (4, 2)}
    assert {(r.node, r.round) for r in rel.snowball(seeds, edges, 3).collect()} == {(1, 0), (2, 1), (3, 1), (4, 1)}



def test_sources_of_findings_and_coverage(spark):
    rows = [("10.1/a", "abstract_only", "We saw it.", "k"), ("10.1/a", "abstract_only", "We saw that.", "k"), ("10.1/a", "fulltext", "We saw it.", ""), ("10.1/a", "fulltext", "In the body.", None), ("10.1/a", "abstract_only", "A title", "k"), ("10.1/b", "abstract_only", "x", "k"), ("10.1/b", "fulltext", "x", "k"), ("10.1/a", "other", "We saw it.", "k")]
    papers = spark.createDataFrame([("10.1/a", "A title", "Look. We saw it. A title")], "doi string, title string, abstract string")
    got = evidence.finding_provenance(spark.createDataFrame(rows, "doi string, text_access string, claim_source_sentence string, cite_key string"), papers)
    told = {(r.doi, r.text_access, r.claim_source_sentence): (r.source_is_proven, r.source_is_not_title, r.has_cite_key) for r in got.collect()}
    assert [told[r[:3]] for r in rows] == [(True, True, True), (False, True, True), (False, True, False), (True, True, False), (True, False, True), (False, True, True), (True, True, True), (False, True, True)]
    keys = lambda *xs: spark.createDataFrame([(x,) for x in xs], "cite_key string")
    review = lambda *xs: spark.createDataFrame(list(xs), "cite_key string, classification string")
    account = lambda *xs: evidence.coverage_counts(keys("a", "b", "c", "d"), keys("a", "z"), review(*xs)).first()
    full = [("b", "SHOULD_CITE"), ("c", "WAIVED_REDUNDANT"), ("d", "WAIVED_LOW_QUALITY")]
    assert account(*full).asDict() == {"cited": 1, "should_cite": 1, "waived_out_of_scope": 0, "waived_redundant": 1, "waived_low_quality": 1, "each_once": True, "in_package": 4, "balanced": True}
    assert not any(account(*xs).balanced for xs in (full[:2], [*full, full[0]], [*full, ("a", "SHOULD_CITE")], [*full[:2], ("d", "OTHER")], [*full, ("y", "SHOULD_CITE")]))
    assert [r.cite_key for r in evidence.should_cite(review(*full, ("e", "SHOULD_CITE"), ("f", "SHOULD_CITE")), keys("e"), keys("f")).collect()] == ["b"]


def plain_snowball(seeds, edges, rounds, most, scores, accepted):
    seen, log, refused = {x: 0 for x in seeds}, [], set()
    for n in range(1, rounds + 1):
        best = sorted(seen, key=lambda x: (-scores.get(x, -1), x))[:most]
        back = {v for u, v in edges if u in best} - set(seen) - refused
        fore = {u for u, v in edges if v in best} - set(seen) - back - refused
        kept = (back | fore) & accepted
        refused |= (back | fore) - kept
        seen |= dict.fromkeys(kept, n)
        log.append((n, len(best), len(back), len(fore), len(kept), len(seen)))
    return seen, log


def test_pairs_are_dealt_to_tasks_by_their_number(spark):
    """Tasks for pairs follow from the number of pairs, not from the session's partitions; the pairs stay the same."""
    rows = [(g, m) for g in range(60) for m in range(g, g + 9)] + [(99, m) for m in range(70)]
    frame = spark.createDataFrame(rows, "g int, m int")
    plain = rel.co_members(frame, "g", "m", "n")
    dealt = rel.co_members(frame, "g", "m", "n", block=20, each=200)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    pairs = 60 * 36 + 70 * 69 // 2
    assert rel.parts_for(pairs, 200) == 23 and dealt.rdd.getNumPartitions() == 23


def test_snowball_through_groups_makes_no_edges(spark):
    """A group of a thousand members makes rows in proportion to its members, not to its pairs, and the same nodes as its edges."""
    rows = [(1, m) for m in range(1000)] + [(2, 5), (2, 2000), (3, 2000), (3, 2001), (4, 7000), (None, 0), (None, 8000), (5, None), (5, 1)]
    frame = spark.createDataFrame(rows, "g int, m int")
    reached = rel.through(frame, "g", "m")
    assert reached(spark.createDataFrame([(0,), (1,), (2,)], "node int")).count() == 1001  # group 1's members and the one of group 5
    got = rel.snowball(spark.createDataFrame([(0,)], "node int"), reached, 3)
    assert {(r.node, r.round) for r in got.collect()} == {(0, 0), *((m, 1) for m in range(1, 1000)), (2000, 2), (2001, 3)}


def test_snowball_expands_the_best_of_all_found(spark):
    rng = random.Random(6)
    edges = list({(rng.randrange(80), rng.randrange(80)) for _ in range(160)})
    scores = {x: rng.randrange(20) for x in range(70)}
    accepted = set(range(80)) - {5, 17, 33}
    frames = [spark.createDataFrame(edges, "u int, v int"), spark.createDataFrame(list(scores.items()), "node int, score int"), spark.createDataFrame([(x,) for x in accepted], "node int")]
    for most in (2, 5, None):
        seen, log = rel.snowball_rounds(spark.createDataFrame([(1,), (2,), (3,)], "node int"), frames[0], 4, most, frames[1], frames[2])
        want = plain_snowball([1, 2, 3], edges, 4, most, scores, accepted)
        assert ({r.node: r.round for r in seen.collect()}, sorted(tuple(r) for r in log.collect())) == want
    # all that a limited round finds stays, and later rounds go out from the best of the whole set
    one = spark.createDataFrame([(1, 2), (1, 3), (3, 4)], "u int, v int")
    assert {r.node for r in rel.snowball(spark.createDataFrame([(1,)], "node int"), one, 1, most_each=1).collect()} == {1, 2, 3}
    assert len(seen._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 6
    none = rel.snowball_rounds(spark.createDataFrame([], "node int"), frames[0], 2)
    assert none[0].count() == 0 and [r.cumulative_unique for r in none[1].collect()] == [0, 0]


def test_streams(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    base = {"record_id": "r1", "alert_type": "correction", "related_dois": ["10.1/ABC"], "title": "t", "observed_at": "2025-01-01T00:00:00Z", "retrieved_at": "2025-01-02T00:00:00Z", "source": {"provider": "p", "url": "https://x.org"}}
    lines = [base, base, base | {"record_id": "r2", "observed_at": "2025-01-03T00:00:00Z"}]
    (feed / "a.json").write_text("\n".join(map(json.dumps, lines)))
    config = spark.createDataFrame([("clm_1", ["https://doi.org/10.1/abc"], [])], schemas.RADAR_CLAIM)
    query = feeds.radar_hits(feeds.radar_stream(spark, f"file://{feed}"), config).writeStream.format("memory").queryName("hits").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.record_id, r.claim_id) for r in spark.sql("select * from hits").collect()] == [("r1", "clm_1")]
    events = tmp_path / "events"
    spark.createDataFrame([(1, "2025-01-01 00:01:00", "a", 2.0), (1, "2025-01-01 00:20:00", "a", 3.0), (1, "2025-01-01 05:00:00", "b", 1.0)], "user_id int, t string, event_type string, value double").select("user_id", F.col("t").cast("timestamp").alias("ts"), "event_type", "value").write.parquet(f"file://{events}")
    stream = spark.readStream.schema(spark.read.parquet(f"file://{events}").schema).parquet(f"file://{events}")
    for name, frame in (("windows", feeds.event_windows(stream)), ("sessions", feeds.sessions(stream))):
        query = frame.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"file://{tmp_path}/{name}").start()
        query.processAllAvailable()
        query.stop()
    assert [(r.event_type, r.n, r.total) for r in spark.sql("select * from windows").collect()] == [("a", 2, 5.0)]
    assert [r.n for r in spark.sql("select * from sessions").collect()] == [2]
    moments = lambda rows: spark.createDataFrame(rows, "submission_id string, t string")
    batch = moments([("s", "2025-01-01"), ("n", "2025-01-05")]).select("submission_id", F.col("t").cast("timestamp").alias("at"))
    state = moments([("s", "2025-01-02")]).select("submission_id", F.col("t").cast("timestamp").alias("latest"))
    early, merged = feeds.chronology(batch, state)
    assert [r.submission_id for r in early.collect()] == ["s"] and merged.count() == 2


def test_paragraphs_are_numbered_in_their_row(spark):
    texts = spark.createDataFrame([("a", "One.\n\n*q*x\n\n<b>\n\n# H\n\nＴｗｏ  x.\n\nThree."), ("b", None), ("c", "")], "file string, text string")
    rows = documents.paragraphs(texts)
    assert [tuple(r) for r in rows.orderBy("paragraph_index").collect()] == [("a", 1, "One."), ("a", 2, "qx"), ("a", 3, "Two x."), ("a", 4, "Three.")]
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_digests_of_files_beyond_one_value(spark, tmp_path):
    rng = random.Random(3)
    mark = b"\xef\xbb\xbf"
    made = {
        "random.parquet": rng.randbytes(1_200_000), "feeds.bin": b"\n" * 70_000, "returns.txt": b"a\r\n\r\xffb\n" * 20_000 + b"x", "mark.txt": mark + b"abc\n" * 20_000, "mark2.txt": mark + b"abc\n" * 20_000 + b"z",
        "marks.bin": mark * 2 + rng.randbytes(90_000) + b"\n", "zeros.bin": b"\0" * 300_000, "a + b%20[1].bin": rng.randbytes(200_000), "coded.gz": rng.randbytes(60_000), "small": b"abc",
    }
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 65_000)  # in place of 2 GB
    try:
        index = files.digest_index(spark, f"file://{tmp_path}", 60_000).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {r.name.split("/")[-1]: (r.bytes, r.sha256) for r in index} == {n: (len(x), hashlib.sha256(x).hexdigest()) for n, x in made.items()}
