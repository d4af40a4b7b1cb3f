"""Scoring, repository checks, radar, planner, versions and submissions on small records."""

import copy
import hashlib

import pytest
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.plans import planner, radar, repository, scoring, submissions, versions
from claimloom.plans.checks import Check, Rejected, gate, tiered_verdict
from claimloom.sources import schemas

AS_OF = "2025-06-01T00:00:00Z"


def passage(atoms, **kw):
    return {"text": "a short passage", "passage_source": "full_text", "locator": "p. 3", "verification_status": "verified", "verification_source": "https://example.org/x", "verified_at": "2025-01-01T00:00:00Z", "supports_claim_atoms": atoms} | kw


def context(key="k1", atoms=("a1", "a2"), group="g1", **kw):
    return {
        "cite_key": key, "doi": f"10.1000/{key.upper()}", "role": "direct_support", "source_type": "primary", "bibliography_status": "verified", "integrity_status": "verified_no_known_issue",
        "integrity_checked_at": "2025-01-01T00:00:00Z", "integrity_check_source": "https://example.org/i", "passages": [passage(list(atoms))], "direction_match": True, "supports_claim_atoms": list(atoms), "independence_group": group, "independence_basis": "other laboratory", "scope_match": "exact",
    } | kw


def claim(contexts, text="Cells divide twice.", **kw):
    base = {
        "claim_id": "clm_" + hashlib.sha256(f"s1\n{text}".encode()).hexdigest()[:16], "section_id": "s1", "source_file": "01.md", "paragraph_index": 1, "sentence_index": 1, "claim_text": text,
        "normalized_claim": text.lower().rstrip("."), "claim_atoms": [{"atom_id": "a1", "text": text[:3]}, {"atom_id": "a2", "text": text[-3:]}], "claim_type": "empirical", "scope_status": "matched", "wording_strength": "unqualified",
        "citation_keys": [c["cite_key"] for c in contexts], "dois": [c["doi"] for c in contexts if c["doi"]], "citation_contexts": contexts, "conflicts": [], "evidence_relation": "directly_supported",
    }
    return base | kw


def score(spark, *claims, keys=("k1", "k2")):
    bib = spark.createDataFrame([(k, f"10.1000/{k}", [f"Author {k}"]) for k in keys], schemas.BIBLIOGRAPHY)
    rows = scoring.scored(spark.createDataFrame(list(claims), schemas.CLAIM), bib, AS_OF).collect()
    return {r.claim_id: r for r in rows}


def one(spark, c, **kw):
    return score(spark, c, **kw)[c["claim_id"]]


def rules(r):
    return [r[c].rule_id.split("_")[0] for c in schemas.COMPONENTS]


CASES = {
    "one group covers both atoms": (claim([context("k1"), context("k2")]), "T4 R2 U4 S4 X4", 90, []),
    "one origin covers a method": (claim([context()], claim_type="methodological"), "T4 R4 U4 S4 X4", 100, []),
    "one atom in a single group": (claim([context("k1"), context("k2", atoms=["a1"], group="g2")]), "T4 R3 U4 S4 X4", 95, []),
    "replicated for each atom": (claim([context("k1"), context("k2", group="g2")]), "T4 R4 U4 S4 X4", 100, []),
    "passage from the future": (claim([context(passages=[passage(["a1"]), passage(["a2"], verified_at="2999-01-01T00:00:00Z")])]), "T3 R1 U0 S4 X4", 60, []),
    "overextended scope": (claim([context()], scope_status="overextended"), "T4 R2 U0 S4 X0", 50, ["overextended_scope"]),
    "retracted source": (claim([context(integrity_status="retracted")]), "T1 R0 U0 S0 X4", 25, ["unsupported_citation"]),
    "no doi on an empirical claim": (claim([context(doi=None)]), "T0 R2 U4 S1 X4", 55, ["missing_doi_empirical"]),
    "no contexts": (claim([]), "T0 R0 U0 S1 X4", 25, ["unsupported_citation", "missing_doi_empirical"]),
    "null arrays": (claim([], citation_contexts=None, citation_keys=None, dois=None, conflicts=None, claim_atoms=None), "T0 R0 U0 S1 X4", 25, ["unsupported_citation", "missing_doi_empirical"]),
    "hedged partial support": (claim([context(atoms=["a1"])], text="Cells may divide.", wording_strength="qualified"), "T3 R1 U3 S4 X4", 75, []),
    "disclosed conflict": (claim([context()], text="However, cells divide.", wording_strength="contested", conflicts=[{"conflict_type": "claim", "target_id": "x", "notes": None}]), "T4 R2 U2 S4 X4", 80, []),
    "undisclosed conflict": (claim([context()], conflicts=[{"conflict_type": "claim", "target_id": "x", "notes": None}]), "T4 R2 U0 S4 X4", 60, ["contradicted_without_caveat"]),
    "unchecked source": (claim([context(integrity_status="not_checked")]), "T1 R0 U0 S2 X4", 35, ["unsupported_citation"]),
    "wrong direction": (claim([context(direction_match=False)]), "T1 R0 U0 S0 X4", 25, ["unsupported_citation", "direction_mismatch"]),
    "invented entry": (claim([context(bibliography_status="invented")]), "T0 R0 U0 S0 X4", 20, ["unsupported_citation", "invented_reference"]),
    "scope unknown": (claim([context(scope_match="unverified")]), "T4 R2 U4 S4 X1", 75, []),
    "background only": (claim([context(role="background")], text="Cells may divide.", wording_strength="qualified"), "T1 R0 U3 S1 X4", 45, []),
}


@pytest.mark.parametrize("name", CASES)
def test_rubric(spark, name):
    c, expected, overall, reasons = CASES[name]
    r = one(spark, c)
    assert (" ".join(rules(r)), r.overall_score, r.reasons) == (expected, overall, reasons)
    assert r.trust_label == ("high_trust" if overall >= 85 else "moderate_trust" if overall >= 70 else "low_trust" if overall >= 50 else "critical_or_unreliable")


def test_attribution_wording_and_last_duplicate_context(spark):
    r = one(spark, claim([context()], text="The authors proposed a scheme that can scale.", claim_type="definition"))
    assert (r.wording.rule_id, r.wording.markers) == ("SURFACE_ATTRIBUTION", ["proposed"])
    double = claim([context(), context(doi="10.1000/other")])
    assert rules(one(spark, double))[0] == "T0"


def test_identity_and_normal_forms(spark):
    rows = [("s", " Ｃafé  x y﻿ "), ("s", "plain"), ("s", "é A—B ‘q’")]
    got = spark.createDataFrame(rows, "s string, t string").select(tx.exact_text("t"), tx.normalize_claim("t"), tx.claim_id("s", "t")).collect()
    assert [r[0] for r in got] == ["Café x y", "plain", "é A—B ‘q’"]
    assert [r[1] for r in got] == ["café x y", "plain", "é a b q"]
    assert got[1][2] == "clm_" + hashlib.sha256(b"s\nplain").hexdigest()[:16]
    again = spark.createDataFrame([(r[0],) for r in got], "t string").select(tx.exact_text("t")).collect()
    assert [r[0] for r in again] == [r[0] for r in got]


def stored_score(r):
    parts = {c: {"score": r[c].score, "rule_id": r[c].rule_id, "rationale": "why"} for c in schemas.COMPONENTS}
    score = {"components": parts, "raw_score": r.raw_score, "overall_score": r.overall_score, "trust_label": r.trust_label, "capped": r.capped, "cap_reasons": list(r.reasons)}
    return score | {"rubric_version": "2.0.0", "cap_value": 60 if r.reasons else None, "cap_reason": r.reasons[0] if r.reasons else None, "computed_from": "validator"}


TWO = [context("k1"), context("k2", group="g2")]


def of_first(**kw):
    return {"citation_contexts": [context("k1", **kw), TWO[1]]}


def with_passage(**kw):
    return of_first(passages=[passage(["a1", "a2"]), passage(["a1"], **kw)])


def score_with(**kw):
    return lambda c: {"trust_score": c["trust_score"] | kw}


def component_with(name, **kw):
    return lambda c: {"trust_score": c["trust_score"] | {"components": c["trust_score"]["components"] | {name: c["trust_score"]["components"][name] | kw}}}


A1, A2 = {"atom_id": "a1", "text": "Cel"}, {"atom_id": "a2", "text": "div"}
#: For each rule a claim that breaks it: what differs before the claim is scored (or a function of the scored claim), and all the rules that break.
FAULTS = {
    "claim id": (lambda c: {"claim_id": c["claim_id"][:-1] + "x"}, "claim id"),
    "normalized claim": ({"normalized_claim": "cells"}, "normalized claim"),
    "paragraph index": ({"paragraph_index": 0}, "paragraph index"),
    "no atoms": ({"claim_atoms": [], "citation_contexts": [context("k1", atoms=[], passages=[], role="background"), context("k2", atoms=[], passages=[], role="background")]}, "claim has atoms"),
    "atom twice": ({"claim_atoms": [A1, A2, A2]}, "atom ids unique"),
    "atom form": ({"claim_atoms": [A1, A2, {"atom_id": "b3", "text": "Cells"}]}, "atom id form"),
    "atom text": ({"claim_atoms": [A1, {"atom_id": "a2", "text": "zebra"}]}, "atom text"),
    "key cited twice": ({"citation_keys": ["k1", "k2", "k2"]}, "citation keys unique, keys in context order"),
    "key of two contexts": ({"citation_contexts": [*TWO, TWO[1]], "citation_keys": ["k1", "k2", "k2"], "dois": ["10.1000/K1", "10.1000/K2", "10.1000/K2"]}, "cite keys unique, citation keys unique, DOIs unique"),
    "DOI in two cases": ({"citation_contexts": [TWO[0], context("k2", group="g2", doi="10.1000/k1")], "dois": ["10.1000/K1", "10.1000/k1"]}, "DOIs unique, context DOI"),
    "key without context": ({"citation_keys": ["k1", "k2", "k3"]}, "keys have contexts, keys in context order"),
    "order of keys": ({"citation_keys": ["k2", "k1"]}, "keys in context order"),
    "order of DOIs": ({"dois": ["10.1000/K2", "10.1000/K1"]}, "DOIs in context order"),
    "evidence relation": (lambda c: {"evidence_relation": "conflicted"}, "evidence relation"),
    "wording strength": ({"wording_strength": "qualified"}, "wording strength"),
    "no score": (lambda c: {"trust_score": None}, "score stored"),
    **{f"{x} score": (component_with(x, score=9), f"{x} score") for x in schemas.COMPONENTS},
    "rule id missing": (component_with("robustness", rule_id=None), "rule ids"),
    "raw score": (score_with(raw_score=None), "raw score"),
    "overall score": (score_with(overall_score=1), "overall score"),
    "label": (score_with(trust_label="low_trust"), "trust label"),
    "capped": (score_with(capped=True), "capped flag"),
    "cap value": (score_with(cap_value=60), "cap value"),
    "cap reasons": (score_with(cap_reasons=None), "cap reasons"),
    "cap reason": (score_with(cap_reason="x"), "cap reason"),
    "version": (score_with(rubric_version="1.9.0"), "score version"),
    "computed from": (score_with(computed_from="writer"), "computed from"),
    "review": ({"human_review_required": True}, "review resolved"),
    "file": ({"source_file": "gone.md"}, "source file"),
    "paragraph": ({"paragraph_index": 2}, "claim stands in its paragraph"),
    "no entry": ({"citation_contexts": [TWO[0], context("k9", group="g2")], "citation_keys": ["k1", "k9"], "dois": ["10.1000/K1", "10.1000/K9"]}, "cited key without entry"),
    "entry's DOI": ({"citation_contexts": [TWO[0], context("k2", group="g2", doi="10.1000/other")], "dois": ["10.1000/K1", "10.1000/other"]}, "context DOI"),
    "unknown atom": (of_first(supports_claim_atoms=["a1", "a2", "a9"], passages=[passage(["a1", "a2", "a9"])]), "atoms exist, passage atoms exist"),
    "atoms not from verified passages": (of_first(supports_claim_atoms=["a1"]), "atoms of verified passages"),
    "status alone doesn't verify": (of_first(passages=[passage(["a1"]), passage(["a2"], locator="")]), "atoms of verified passages, passage locator"),
    "integrity time": (of_first(integrity_checked_at="2999-01-01T00:00:00Z"), "integrity time"),
    "integrity source": (of_first(integrity_check_source="http://example.org"), "integrity source"),
    "independence basis": (of_first(independence_basis="\u00a0 "), "supporting context names its independence basis"),
    "passage length": (with_passage(text="word\u2003" * 26), "passage length"),
    "passage locator": (with_passage(locator=None), "passage locator"),
    "passage without atoms": (with_passage(supports_claim_atoms=[]), "passage names atoms"),
    "passage's unknown atom": (with_passage(supports_claim_atoms=["a7"], verification_status="unverified"), "passage atoms exist"),
    "passage source": (with_passage(verification_source="http://x"), "verified passage source"),
    "passage time": (with_passage(verified_at="2999-01-01T00:00:00Z"), "verified passage time"),
    "shared author": ({"citation_contexts": [TWO[0], context("k3", group="g2")], "citation_keys": ["k1", "k3"], "dois": ["10.1000/K1", "10.1000/K3"]}, "shared author across groups"),
}


def test_each_rule_has_a_claim_that_breaks_it_alone(spark):
    bib = spark.createDataFrame([("k1", "10.1000/k1", ["A"]), ("k2", "10.1000/k2", ["B"]), ("k3", "10.1000/k3", ["C", "a."])], schemas.BIBLIOGRAPHY)
    made = {}
    for n, (name, (differs, _)) in enumerate({"sound": ({}, ""), **FAULTS}.items()):
        c = claim(TWO, text=f"Cells divide {n} times.")
        made[name] = c | {"normalized_claim": f"cells divide {n} times", "source_file": f"{n}.md"} | ({} if callable(differs) else differs)
    scores = {r.claim_id: r for r in scoring.scored(spark.createDataFrame(list(made.values()), schemas.CLAIM), bib, AS_OF).collect()}
    for name, c in made.items():
        r = scores[c["claim_id"]]
        c |= {"trust_score": stored_score(r), "evidence_relation": r.relation}
        differs = FAULTS.get(name, ({},))[0]
        c |= differs(c) if callable(differs) else {}
    prose = [(f"{n}.md", i, f"So: Cells divide {n} times. Yes." if i < 2 else "Other.") for n in range(len(made)) for i in (0, 1, 2)]
    edges = [(c["claim_id"], "supports", x["cite_key"], "citation", 1.0, None) for c in made.values() for x in {x["cite_key"]: x for x in c["citation_contexts"]}.values()]
    found = repository.validate(spark.createDataFrame(list(made.values()), schemas.CLAIM), spark.createDataFrame(edges, schemas.EDGE), bib, spark.createDataFrame(prose, "file string, paragraph_index int, text string"), AS_OF)
    got = {name: set() for name in made}
    ids = {c["claim_id"]: name for name, c in made.items()}
    for r in found.collect():
        got[ids[r.key]].add(r.check_name)
    assert got == {"sound": set(), **{name: set(rules.split(", ")) for name, (_, rules) in FAULTS.items()}}
    assert set().union(*got.values()) == set(repository.CLAIM_CHECKS)


def test_repository_checks_of_edges_and_repeats(spark):
    bib = spark.createDataFrame([("k1", "10.1000/k1", ["A"]), ("k2", "10.1000/k2", ["B"])], schemas.BIBLIOGRAPHY)
    prose = spark.createDataFrame([("01.md", 1, "So: Cells divide twice. Yes.")], "file string, paragraph_index int, text string")
    good = claim(TWO)
    good["trust_score"] = stored_score(one(spark, good))
    edges = [(good["claim_id"], "supports", k, "citation", 1.0, None) for k in ("k1", "k2")]

    def faults(c, e=edges, **more):
        frame = spark.createDataFrame(c if isinstance(c, list) else [c], schemas.CLAIM)
        return {r.check_name for r in repository.validate(frame, spark.createDataFrame(e, schemas.EDGE), bib, prose, AS_OF, **more).collect()}

    assert faults(good) == set()
    assert faults(good | {"claim_text": "Cells split."}) >= {"claim id", "claim stands in its paragraph", "normalized claim"}
    assert faults([good, good]) == {"duplicate claim"}
    assert faults(good, edges[:1]) == {"context without edge"}
    assert faults(good, [edges[0], edges[1][:3] + ("entity", 1.0, None)]) == set()  # an edge of any kind will do
    assert faults(good, edges + [("clm_x", "supports", "k9", "citation", 2.0, None)]) == {"edge weight", "edge of unknown claim"}
    assert faults(good, edges + [(good["claim_id"], "supports", "k9", "citation", 1.0, None)]) == {"edge without context"}
    assert faults(good, edges + [(good["claim_id"], "supports", "k9", "method", 1.0, None)]) == set()
    assert faults(good, [(good["claim_id"], "supports", "k1", "citation", 0.5, None), *edges[1:]]) == {"edge relation or weight"}
    assert faults([], []) == set()


def test_gate_artifacts_and_bases(spark):
    bib = spark.createDataFrame([("k1", "10.1000/k1", ["A"]), ("k2", "10.1000/k2", ["B"])], schemas.BIBLIOGRAPHY)
    prose = spark.createDataFrame([("01.md", 1, "Cells divide twice.")], "file string, paragraph_index int, text string")
    good = claim(TWO)
    good["trust_score"] = stored_score(one(spark, good))
    frame = spark.createDataFrame([good], schemas.CLAIM)
    edges = spark.createDataFrame([(good["claim_id"], "supports", k, "citation", 1.0, None) for k in ("k1", "k2")], schemas.EDGE)
    gates = lambda **kw: spark.createDataFrame([{"status": "pass", "failures": [], "checks": {"a": True}, "counts": {"claims": 1, "citation_contexts": 2, "verified_passages": 2, "failures": 0}} | kw], "status string, failures array<string>, checks map<string,boolean>, counts struct<claims:bigint,citation_contexts:bigint,verified_passages:bigint,failures:bigint>")
    faults = lambda **kw: {(r.check_name, r.key) for r in repository.validate(frame, edges, bib, prose, AS_OF, **kw).collect()}
    summary = repository.report_summary(frame)
    bases = repository.basis_records(frame, bib, AS_OF)
    assert faults(gate=gates(), scores_summary=summary, bases=bases) == set()
    assert faults(gate=gates(status="open")) == faults(gate=gates(failures=["x"])) == {("gate status", "gate")}
    assert faults(gate=gates(checks={"a": True, "b": None})) == {("gate checks", "gate")}
    assert faults(gate=gates(counts={"claims": 1, "citation_contexts": 2, "verified_passages": 3, "failures": 0})) == {("gate counts", "gate")}
    assert faults(scores_summary=summary.withColumn("capped_claims", F.lit(4))) == {("report summary", "summary")}
    basis = bases.first().score_basis
    assert [(a.atom_id, a.cite_keys) for a in basis.atom_support] == [("a1", ["k1", "k2"]), ("a2", ["k1", "k2"])] and [a.groups for a in basis.independence_groups_by_atom] == [["g1", "g2"]] * 2
    assert basis.eligible_citations[0].verified_passage_locators == ["p. 3"] and basis.derived_evidence_relation == "directly_supported" and basis.wording_basis.rule_id == "SURFACE_UNQUALIFIED"
    moved = bases.withColumn("score_basis", F.col("score_basis").withField("atom_support", F.reverse("score_basis.atom_support")))
    assert faults(bases=moved) == {("report basis", good["claim_id"])}
    told = [("graph", "2.0.0", "2.0.0"), ("seed", "2.0.0", None), ("report", "2.0.0", "1.0.0")]
    assert faults(artifacts=spark.createDataFrame(told, "name string, schema_version string, rubric_version string")) == {("artifact version", "report")}


def test_stored_records_and_directives_are_compared(spark):
    bib = spark.createDataFrame([("k1", "10.1000/k1", ["A"]), ("k2", "10.1000/k2", ["B"])], schemas.BIBLIOGRAPHY)
    prose = spark.createDataFrame([("01.md", 1, "So: Cells divide twice. Yes.")], "file string, paragraph_index int, text string")
    good = claim([context("k1"), context("k2", group="g2")], modality="stated", human_review_required=False, validation_status="validated")
    good["trust_score"] = stored_score(one(spark, good))
    frame = lambda c: spark.createDataFrame([c], schemas.CLAIM)
    edges = spark.createDataFrame([(good["claim_id"], "supports", k, "citation", 1.0, None) for k in ("k1", "k2")], schemas.EDGE)
    options = {"claim-id": good["claim_id"], "claim": good["claim_text"], "cites": "k1, k2", "claim-type": "empirical", "modality": "stated"}
    told = lambda o, ord=0: ("01.md", ord, o)

    def faults(c=good, directives=(told(options),), **kw):
        tables = {"index": repository.index_records(frame(good)), "seeds": repository.seed_records(frame(good)), "report": repository.report_records(frame(good)), "summary": repository.summary_record(frame(good))} | kw
        return {(r.check_name, r.key.split(": ")[-1] if r.check_name == "directive" else "") for r in repository.validate(frame(c), edges, bib, prose, AS_OF, directives=spark.createDataFrame(list(directives), schemas.DIRECTIVE), **tables).collect()}

    assert faults() == set()
    assert faults(good | {"sentence_index": 7}) == {("index record", "")}
    assert faults(good | {"validation_status": "open"}) == {("seed record", "")}
    assert faults(good | {"human_review_required": True}) == {("index record", ""), ("graph summary", ""), ("review resolved", "")}
    rules = copy.deepcopy(good)
    rules["trust_score"]["components"]["robustness"]["rule_id"] = "R9"
    assert faults(rules) == {("report record", ""), ("rule ids", "")}
    assert faults(good | {"trust_score": good["trust_score"] | {"raw_score": 5}}) == {("report record", ""), ("raw score", "")}
    assert faults(directives=()) == {("directive", "no directive")}
    assert faults(directives=[told(options | {"claim": "Cells"}), told(options, 1)]) == {("directive", "claim text")}
    assert faults(directives=[told(options | {"cites": "k2, k1", "claim-type": "causal", "modality": "x"})]) == {("directive", "cites"), ("directive", "claim type"), ("directive", "modality")}
    assert faults(directives=[told(options | {"score": "100", "trust-label": "", "cap-reason": "x"})]) == {("directive", f"forbidden {k}") for k in repository.FORBIDDEN_OPTIONS}
    basis = {r.component: (r.score, r.rationale) for r in repository.stored_components(frame(good)).collect()}
    assert basis.keys() == set(schemas.COMPONENTS) and all(b == (good["trust_score"]["components"][c]["score"], "why") for c, b in basis.items())


def test_shared_authors_in_canonical_form(spark):
    bib = spark.createDataFrame([("k1", "d", ["Smith, J.", "Öz"]), ("k2", "d", ["Smith J"]), ("k3", "d", ["", "\\'Eva N"]), ("k4", "d", [""]), ("k5", "d", ["Eva n."])], schemas.BIBLIOGRAPHY)
    pairs = lambda *contexts: {(r.left_key, r.right_key) for r in scoring.shared_author_pairs(spark.createDataFrame([claim(list(contexts))], schemas.CLAIM), bib).collect()}
    assert pairs(context("k1"), context("k2", group="g2")) == {("k1", "k2")}
    assert pairs(context("k1"), context("k2")) == set()
    assert pairs(context("k1", group=""), context("k2", group="g2"), context("k2", group=None)) == set()
    assert pairs(context("k3"), context("k4", group="g2"), context("k5", group="g3")) == {("k3", "k5")}
    assert pairs(context("k1", role="background"), context("k2", group="g2")) == set()


CONFIG = [("clm_" + "a" * 16, ["https://doi.org/10.1/ABC"], ["cell division"]), ("clm_" + "b" * 16, ["10.1/zzz"], ["of in"])]


def record(i, **kw):
    return {"record_id": f"r{i}", "alert_type": "new_work", "doi": None, "title": "A title", "abstract": None, "topics": [], "related_dois": [], "published_at": None, "observed_at": "2025-01-01T00:00:00Z", "source": {"provider": "p", "url": "https://example.org/r"}} | kw


def test_radar_matches_and_fails_closed(spark):
    config = spark.createDataFrame(CONFIG, schemas.RADAR_CLAIM)
    ids = config.select("claim_id")
    feed = [record(1, doi="10.1/abc"), record(2, alert_type="retraction", related_dois=["10.1/ZZZ", "10.1/abc"]), record(3, title="On Cell-Division", topics=["mitosis"]), record(4)]
    status, found = radar.run(config, spark.createDataFrame(feed, schemas.RADAR_RECORD), ids, "2025-02-01T00:00:00Z")
    rows = {r.source.record_id: r for r in found.collect()}
    assert status == "proposals_available" and set(rows) == {"r1", "r2", "r3"}
    assert rows["r2"].affected_claim_ids == [c[0] for c in CONFIG] and rows["r2"].suggested_review_action == "urgent_source_integrity_review"
    assert rows["r3"].rationale == [CONFIG[0][0] + ":topic_query:cell division"]
    assert rows["r1"].proposal_id == "radar_" + hashlib.sha256(b"p\nr1\nnew_work").hexdigest()[:16]
    assert [c for c in found.columns if "score" in c or c == "claim_text"] == []
    both = [record(7, alert_type="correction", related_dois=["10.1/abc"]), record(7, alert_type="retraction", related_dois=["10.1/zzz"]), record(7, alert_type="retraction", related_dois=["10.1/zzz"])]
    told = radar.proposals(config, spark.createDataFrame(both, schemas.RADAR_RECORD)).collect()
    assert sorted((r.alert_type, tuple(r.affected_claim_ids)) for r in told) == [("correction", (CONFIG[0][0],)), ("retraction", (CONFIG[1][0],)), ("retraction", (CONFIG[1][0],))]
    again = spark.createDataFrame([(CONFIG[0][0], ["10.1/abc", "https://doi.org/10.1/ABC"], [])], schemas.RADAR_CLAIM)
    assert radar.proposals(again, spark.createDataFrame([record(1, doi="10.1/abc")], schemas.RADAR_RECORD)).first().rationale == [CONFIG[0][0] + ":watched_doi:10.1/abc,10.1/abc"]
    assert radar.run(config, spark.createDataFrame(feed[3:], schemas.RADAR_RECORD), ids, "2025-02-01T00:00:00Z")[0] == "no_changes"
    for bad in (record(1, source={"provider": "p", "url": "http://example.org"}), record(1, source={"provider": "p", "url": "https://u:p@example.org"}), record(1, observed_at="2026-01-01T00:00:00Z"), record(1, alert_type="retraction"), record(1, title="")):
        with pytest.raises(Rejected):
            radar.run(config, spark.createDataFrame([bad], schemas.RADAR_RECORD), ids, "2025-02-01T00:00:00Z")
    with pytest.raises(Rejected, match="canonical"):
        radar.run(config, spark.createDataFrame(feed, schemas.RADAR_RECORD), ids.limit(0), "2025-02-01T00:00:00Z")


POLICY = {"proposal_only": True, "trust_scores_are_validator_owned": True, "scientific_approval_forced_for_sources": planner.FORCED_SOURCES, "scientific_approval_forced_for_path_prefixes": planner.FORCED_PREFIXES}


def test_planner_groups_in_declared_order(spark):
    themes = spark.createDataFrame([(0, "trust-evidence", "T", "x", ["docs", "gone"]), (1, "docs", "D", "y", []), (2, "empty", "E", "z", [])], "theme_ord int, theme_id string, title string, owner string, depends_on array<string>")
    rows = [("proposal-bbb", "validator", "docs", "A long title", "low", [], ["README.md"], False), ("proposal-aaa", "maintainer", "docs", "Another title", "critical", [], ["content/x.md"], False)]
    config = spark.createDataFrame(CONFIG, schemas.RADAR_CLAIM)
    _, found = radar.run(config, spark.createDataFrame([record(1, doi="10.1/abc")], schemas.RADAR_RECORD), config.select("claim_id"), "2025-02-01T00:00:00Z")
    proposals = spark.createDataFrame(rows, schemas.PROPOSAL).unionByName(planner.from_radar(found))
    plan = planner.backlog(proposals, themes, POLICY)
    got = plan.collect()
    assert [r.theme_id for r in got] == ["trust-evidence", "docs"] and got[0].depends_on == ["docs"]
    assert [p.proposal_id for p in got[1].proposals] == ["proposal-aaa", "proposal-bbb"] and got[1].proposals[0].forced and not got[1].proposals[1].approval
    assert tuple(planner.totals(plan).first()) == (3, 2, 1)
    with pytest.raises(ValueError, match="weakened"):
        planner.backlog(proposals, themes, POLICY | {"proposal_only": False})
    for bad in ((rows[0][:2] + ("nowhere",) + rows[0][3:]), rows[0][:6] + (["../x"], False), rows[0][:4] + ("urgent",) + rows[0][5:], rows[1]):
        with pytest.raises(Rejected):
            planner.backlog(proposals.unionByName(spark.createDataFrame([bad], schemas.PROPOSAL)), themes, POLICY)


def snap(i, text="t", score=80, label="moderate_trust", supersedes=(), keys=("k1",), report="a" * 64, **kw):
    scores = dict.fromkeys(schemas.COMPONENTS, score // 20)
    return {"claim_id": f"clm_{i:016x}", "supersedes_claim_ids": list(supersedes), "claim_text": text, "citation_keys": list(keys), "evidence_basis": "{}", "trust": {"rubric_version": "1", "report_sha256": report, "component_scores": scores, "overall_score": score, "trust_label": label}, "human_decision_references": [], "relations": []} | kw


def anchor(name, i=None, quote=None):
    s = {"kind": "claim", "claim_id": f"clm_{i:016x}"} if i is not None else {"kind": "text", "source_path": "content/x.md", "source_sha256": "b" * 64, "exact_quote": quote}
    return {"anchor_id": name, "selector": s, "human_decision_references": []}


def test_version_diff(spark):
    frame = lambda rows: spark.createDataFrame(rows, schemas.SNAPSHOT_CLAIM)
    anchors = lambda rows: spark.createDataFrame(rows, schemas.ANCHOR)
    before, after = frame([snap(1), snap(2, score=80), snap(3)]), frame([snap(1, report="c" * 64), snap(4, score=100, label="high_trust", supersedes=["clm_" + f"{2:016x}"], keys=["k2"]), snap(5)])
    pairs = versions.succession(before, after)
    got = {r.comparison_id[-4:] + r.status: r for r in versions.compare(before, after, pairs).collect()}
    assert sorted(r.status for r in got.values()) == ["added", "modified", "removed", "unchanged"]
    changed = next(r for r in got.values() if r.status == "modified")
    assert (changed.overall.before, changed.overall.after, changed.citations.added, changed.citations.removed) == (80, 100, ["k2"], ["k1"])
    told = versions.anchor_changes(anchors([anchor("a", 1), anchor("b", 2), anchor("c", 3)]), anchors([anchor("a", 1), anchor("b", 4), anchor("d", 5)]), pairs)
    assert {r.anchor_id: r.status for r in told.collect()} == {"a": "current", "b": "remapped", "c": "orphaned", "d": "added"}
    s = versions.summary(versions.compare(before, after, pairs), told)
    assert (s["added"], s["removed"], s["modified"], s["unchanged"], s["orphaned_anchors"], s["trust_overall_changed"]) == (1, 1, 1, 1, 1, 1)
    same = versions.compare(before, before, versions.succession(before, before))
    assert {(r.status, r.n) for r in versions.status_counts(same).collect()} == {("added", 0), ("removed", 0), ("modified", 0), ("unchanged", 3)}
    with pytest.raises(Rejected, match="one successor"):
        versions.succession(before, frame([snap(8, supersedes=["clm_" + f"{2:016x}"]), snap(9, supersedes=["clm_" + f"{2:016x}"])]))
    with pytest.raises(Rejected, match="keeps its target"):
        versions.anchor_changes(anchors([anchor("a", 1)]), anchors([anchor("a", 5)]), pairs)
    with pytest.raises(ValueError):
        versions.newer("1.10.0", "1.9.9")


def submission(i, kind="claim", state="accepted", **kw):
    selector = {"claim": {"kind": "claim", "claim_id": "clm_1"}, "text": {"kind": "text", "source_path": "content/x.md", "source_sha256": "b" * 64, "exact_quote": "the “quoted” words", "prefix": "", "suffix": ""}, "review": {"kind": "review"}}[kind]
    base = {"submission_id": f"s{i}", "revision": 1, "created_at": "2025-01-01T00:00:00Z", "target": {"review_id": "r", "review_version": "1.0.0", "release_manifest_sha256": "m", "selector": selector}, "content": {"stance": "supports"}, "received_at": "2025-01-02T00:00:00Z"}
    events = [{"event": "submitted", "at": "2025-01-02T00:00:00Z", "actor_ref": "x"}] + ([{"event": "accepted", "at": "2025-01-03T00:00:00Z", "actor_ref": "y"}] if state == "accepted" else [])
    return base | {"moderation": {"state": state, "events": events}} | kw


def test_submissions_pair_with_exact_targets(spark):
    rows = [submission(1), submission(2, "text"), submission(3, "review"), submission(4, state="pending"), submission(5, target=submission(1)["target"] | {"review_version": "2.0.0"}), submission(6, target=submission(1)["target"] | {"selector": {"kind": "claim", "claim_id": "clm_9"}})]
    frame = spark.createDataFrame(rows, schemas.SUBMISSION)
    claims = spark.createDataFrame([("clm_1",)], "claim_id string")
    source = lambda text: spark.createDataFrame([("content/x.md", "b" * 64, text)], "source_path string, source_sha256 string, text string")
    got = {r.submission_id: (r.anchor_status, r.start, r.end) for r in submissions.paired(frame, "1.0.0", "m", claims, source('See the  "quoted" words.')).collect()}
    assert got == {"s1": ("current", None, None), "s2": ("current", 4, 23), "s3": ("current", None, None), "s6": ("orphaned", None, None)}
    twice = submissions.paired(frame, "1.0.0", "m", claims, source('the "quoted" words, the "quoted" words'), only=spark.createDataFrame([("s2",)], "submission_id string")).collect()
    assert [r.anchor_status for r in twice] == ["orphaned"]
    bad = submission(7, moderation={"state": "accepted", "events": [{"event": "accepted", "at": "2024-01-01T00:00:00Z", "actor_ref": "y"}]})
    failed = {c.name for c in submissions.checks(spark.createDataFrame([bad], schemas.SUBMISSION)) if c.violations().head(1)}
    assert failed == {"events in order", "first event"}
    assert not any(c.violations().head(1) for c in submissions.checks(spark.createDataFrame([submission(1)], schemas.SUBMISSION)))


def test_gates(spark):
    told = spark.createDataFrame([("a", True), ("b", True), ("b", False)], "check_name string, passed boolean")
    assert tuple(gate(told, ["a"]).first()) == (True, [])
    assert tuple(gate(told, ["a", "b", "c"]).first()) == (False, ["b", "c"])
    verdict = lambda *outcomes, **kw: tiered_verdict(spark.createDataFrame([(f"c{i}", *o.split()) for i, o in enumerate(outcomes)], "check_name string, tier string, outcome string"), **kw).first().verdict
    assert verdict("A pass", "B pass") == "PASS"
    assert verdict("A pass", "B blocked") == "PASS_WITH_BLOCKED_TIER_B"
    assert verdict("A fail", "B pass") == verdict("A pass", "A fail", "B blocked") == verdict("A pass", "B fail") == verdict("A pass", "A strange") == "FAIL_REQUIRES_FIX"
    assert verdict("A fail", "B pass", attempt=2) == "FAIL_REQUIRES_USER_SIGNOFF"
    assert verdict("A blocked", "B blocked") == verdict() == verdict("A pass", "A blocked") == verdict("B pass") == "BLOCKED_DEPLOY_INACCESSIBLE"
    assert Check("x", told, F.lit(None).cast("boolean")).violations().count() == 3


def test_radar_meets_claims_after_every_shuffle(spark):
    """Records of one topic share its claims: no exchange carries pairs of records and claims, nor rows with claims in them."""
    config = [(f"clm_{i:016x}", [f"10.1/{i}"], ["cell division"]) for i in range(40)]
    feed = [record(i, title=f"On Cell-Division {i % 3}", related_dois=["10.1/7"] if i % 2 else []) for i in range(60)] + [record(99)]
    asked, fed = spark.createDataFrame(config, schemas.RADAR_CLAIM), spark.createDataFrame(feed, schemas.RADAR_RECORD)
    _, found = radar.run(asked, fed, asked.select("claim_id"), "2025-02-01T00:00:00Z")
    got = found.collect()
    assert len(got) == 60 and [r.proposal_id for r in got] == sorted(r.proposal_id for r in got)
    assert all(r.affected_claim_ids == [c[0] for c in config] and len(r.rationale) == 40 + int(r.source.record_id[1:]) % 2 for r in got)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" in plan[plan.index("Join") :] and "Sort [" not in plan[: plan.index("Join")] and "Aggregate" not in plan
    told = radar.matches(asked, fed)
    assert told.rows.count() == 60 and told.classes.count() == 1 and told.affected().count() == 40


def test_proposals_are_dealt_by_the_claims_that_they_name(spark, monkeypatch):
    """A few narrow rows that become a large result are not left to one task."""
    config = [(f"clm_{i:016x}", [f"10.1/{i}"], ["cell division"]) for i in range(40)]
    feed = [record(i, title=f"On Cell-Division {i % 3}", related_dois=["10.1/7"] if i % 2 else []) for i in range(60)] + [record(99)]
    asked, fed = spark.createDataFrame(config, schemas.RADAR_CLAIM), spark.createDataFrame(feed, schemas.RADAR_RECORD)
    monkeypatch.setattr(radar, "NAMED", 250)
    assert radar.matches(asked, fed).named() == 60 * 40 + 30
    _, found = radar.run(asked, fed, asked.select("claim_id"), "2025-02-01T00:00:00Z")
    got = found.withColumn("task", F.spark_partition_id()).collect()
    assert [r.proposal_id for r in got] == sorted(r.proposal_id for r in got) and len(got) == 60
    sizes = [sum(r.task == i for r in got) for i in range(10)]
    assert sum(sizes) == 60 and max(sizes) <= 10  # of some 6, as ranges come from samples


def test_outline_counts_what_the_backlog_holds(spark):
    themes = spark.createDataFrame([(0, "trust-evidence", "T", "x", ["docs", "gone"]), (1, "docs", "D", "y", []), (2, "empty", "E", "z", [])], "theme_ord int, theme_id string, title string, owner string, depends_on array<string>")
    rows = [(f"proposal-b{i:02}", "validator", "docs", "A long title", ["low", "critical"][i % 5 == 3], [f"clm_{i % 4:016x}", f"clm_{i % 3:016x}"], ["README.md"], False) for i in range(20)]
    config = spark.createDataFrame(CONFIG, schemas.RADAR_CLAIM)
    found = radar.matches(config, spark.createDataFrame([record(1, doi="10.1/abc"), record(2, title="cell division")], schemas.RADAR_RECORD))
    own = spark.createDataFrame(rows, schemas.PROPOSAL)
    plan = {r.theme_id: r for r in planner.backlog(own.unionByName(planner.from_radar(found.whole())), themes, POLICY).collect()}
    claims = own.select("theme", F.explode("affected_claim_ids").alias("claim_id")).unionByName(found.affected().select(F.lit("trust-evidence").alias("theme"), "claim_id"))
    told = planner.outline(own.drop("affected_claim_ids").unionByName(planner.radar_rows(found.rows)), claims, themes, POLICY).collect()
    assert [r.theme_id for r in told] == list(plan) == ["trust-evidence", "docs"]
    for r in told:
        p = plan[r.theme_id]
        assert (r.n_proposals, r.first_id, r.n_claims) == (len(p.proposals), p.proposals[0].proposal_id, len(p.affected_claim_ids))
        assert (r.scientific_approval_required, r.depends_on) == (p.scientific_approval_required, p.depends_on)
    with pytest.raises(Rejected, match="claim ids"):
        planner.outline(own.drop("affected_claim_ids"), claims.withColumn("claim_id", F.lit("x")), themes, POLICY)
