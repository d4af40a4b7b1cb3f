"""Five-component scoring of claims from their citation contexts.

Everything about one claim is in its row, so the rules are expressions over nested arrays and
no data moves; only the bibliography is joined. Weights, caps and bands are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.sources.schemas import COMPONENTS, CONTEXT, PASSAGE

#: Roles, types, reasons and rule ids that stored records name.
SUPPORT_ROLES = ["direct_support", "partial_support"]
ATTRIBUTION_TYPES = ["methodological", "definition"]
INDIRECT_ROLES = ["background", "method_reference", "review_context"]
REVIEW_TYPES = ["systematic_review", "narrative_review"]
CAP_REASONS = ["unsupported_citation", "direction_mismatch", "contradicted_without_caveat", "invented_reference", "missing_doi_empirical", "overextended_scope"]
#: Surface markers of wording, by strength.
CONTESTED = ["contested", "conflicting", "inconsistent", "mixed evidence", "disagree(?:s|d)?", "however"]
ATTRIBUTION = ["propose", "proposes", "proposed", "argue", "argues", "argued", "reported", "described", "defined", "introduced", "added"]
HEDGES = ["indicate(?:s|d)?", "suggest(?:s|ed)?", "can", "could", "may", "might", "likely", "possibly", "appear(?:s|ed)?", "seem(?:s|ed)?", "uncertain"]


@dataclass
class Rubric:
    """What a methodological decision may change."""

    weight: int = 5
    cap: int = 60
    bands: list[tuple[int, str]] = field(default_factory=lambda: list(vl.BANDS))
    empirical: list[str] = field(default_factory=lambda: ["empirical", "causal", "comparative"])


def _array(x: Column, kind: str) -> Column:
    return F.coalesce(x, F.array().cast(f"array<{kind}>"))


def _is(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _has(x: Column, *values) -> Column:
    """An array has one of the values; plain array functions, unlike lambdas, are compiled."""
    out = _is(F.array_contains(x, F.lit(values[0])))
    for v in values[1:]:
        out = out | _is(F.array_contains(x, F.lit(v)))
    return out


def _blank_doi(x: Column) -> Column:
    """A context among the array of contexts ``x`` has no DOI."""
    return _is(F.size(F.array_compact(x["doi"])) < F.size(x["doi"])) | _has(x["doi"], "")


def verified_passage(p: Column, as_of: Column) -> Column:
    at = vl.moment(p["verified_at"])
    return _is((p["verification_status"] == "verified") & (p["locator"] != "") & p["verification_source"].startswith("https://") & (at <= as_of))


#: Fields of a context that no rule of the score reads once its features are made.
BULKY = ["passages", "integrity_checked_at", "integrity_check_source", "independence_basis", "notes"]


def with_features(claims: DataFrame, as_of: str, slim: bool = False) -> DataFrame:
    """Each context with ``verified``, ``atoms`` (of its verified passages), ``supports`` and ``eligible``; computed once.

    ``as_of`` bounds verification times; the wall clock is never read. ``slim`` contexts lose what only other plans read (``BULKY``),
    as every further step copies them.
    """
    moment = F.lit(as_of).cast("timestamp")

    def feature(held: Column) -> Column:
        c, verified = held["c"], held["verified"]
        supports = _is(c["role"].isin(SUPPORT_ROLES))
        sound = _is((c["bibliography_status"] == "verified") & (c["integrity_status"] == "verified_no_known_issue") & c["direction_match"])
        return F.struct(
            (c.dropFields(*BULKY) if slim else c).alias("c"),
            (F.size(verified) > 0).alias("verified"),
            F.array_distinct(F.flatten(F.transform(verified, lambda p: _array(p["supports_claim_atoms"], "string")))).alias("atoms"),
            supports.alias("supports"),
            (sound & supports & (F.size(verified) > 0) & (F.size(_array(c["supports_claim_atoms"], "string")) > 0)).alias("eligible"),
        )

    proven = lambda c: F.filter(_array(c["passages"], PASSAGE), lambda p: verified_passage(p, moment))
    held = F.transform(_array(F.col("citation_contexts"), CONTEXT), lambda c: F.struct(c.alias("c"), proven(c).alias("verified")))
    rows = claims.withColumn("contexts", F.transform(held, feature))
    covered = lambda xs: F.array_distinct(F.flatten(xs["atoms"]))
    indirect = lambda x: _is(x["c"]["role"].isin(INDIRECT_ROLES) | x["c"]["source_type"].isin(REVIEW_TYPES)) & _is((x["c"]["bibliography_status"] == "verified") & x["c"]["direction_match"]) & x["verified"]
    return (
        rows.withColumn("atom_ids", F.coalesce("claim_atoms", F.array().cast("array<struct<atom_id:string,text:string>>"))["atom_id"])
        .withColumn("eligible", F.filter("contexts", lambda x: x["eligible"]))
        .withColumn("relied", F.filter("contexts", lambda x: x["supports"]))
        .withColumn("covered", covered(F.col("eligible")))
        .withColumn("indirect", covered(F.filter("contexts", indirect)))
        .withColumn("n_conflicts", F.size(F.coalesce("conflicts", F.array().cast("array<struct<conflict_type:string,target_id:string,notes:string>>"))))
        .withColumn("all_covered", F.size(F.array_except("atom_ids", "covered")) == 0)
    )


def wording_basis(text: Column, kind: Column) -> Column:
    """``(strength, rule_id, markers)``: conflict before attribution before hedge before none."""
    found = {name: tx.markers(text, words) for name, words in (("contested", CONTESTED), ("attribution", ATTRIBUTION), ("hedge", HEDGES))}
    basis = lambda strength, rule, markers: F.struct(F.lit(strength).alias("strength"), F.lit(rule).alias("rule_id"), markers.alias("markers"))
    return vl.ladder(
        [
            (F.size(found["contested"]) > 0, basis("contested", "SURFACE_CONFLICT", found["contested"])),
            (kind.isin(ATTRIBUTION_TYPES) & (F.size(found["attribution"]) > 0), basis("unqualified", "SURFACE_ATTRIBUTION", found["attribution"])),
            (F.size(found["hedge"]) > 0, basis("qualified", "SURFACE_HEDGE", found["hedge"])),
        ],
        basis("unqualified", "SURFACE_UNQUALIFIED", F.array().cast("array<string>")),
    )


def evidence_relation() -> Column:
    contradicted = _has(F.col("contexts.c.role"), "contradictory")
    return vl.ladder(
        [
            (F.col("scope_status") == "overextended", "overextended"),
            ((F.col("n_conflicts") > 0) | contradicted, "conflicted"),
            ((F.size("atom_ids") > 0) & F.col("all_covered"), "directly_supported"),
            (F.size("covered") > 0, "partially_supported"),
            (F.size("indirect") > 0, "indirectly_supported"),
        ],
        "unsupported",
    )


def _rules(rules: list[tuple[Column, int, str]], score: int, rule_id: str) -> Column:
    one = lambda s, r: F.struct(F.lit(s).alias("score"), F.lit(r).alias("rule_id"))
    return vl.ladder([(c, one(s, r)) for c, s, r in rules], one(score, rule_id))


def robustness() -> Column:
    none = F.size("eligible") == 0
    primary = _has(F.col("eligible.c.source_type"), "primary")
    origin = F.exists("eligible", lambda x: _is((x["c"]["source_type"] == "primary") & (x["c"]["role"] == "direct_support")) & (F.size(F.array_except("atom_ids", x["atoms"])) == 0))
    grouped = F.filter("eligible", lambda x: _is(x["c"]["independence_group"] != ""))
    groups = F.array_distinct(F.array_remove(F.array_compact("eligible.c.independence_group"), ""))
    of_atom = lambda a: F.size(F.array_distinct(F.transform(F.filter(grouped, lambda x: F.array_contains(x["atoms"], a)), lambda x: x["c"]["independence_group"])))
    every_atom_twice = F.forall("atom_ids", lambda a: of_atom(a) >= 2)
    quiet = F.col("n_conflicts") == 0
    attributed = _rules(
        [(none, 0, "R0_ATTRIBUTION_UNSUPPORTED"), (~primary, 1, "R1_ATTRIBUTION_INDIRECT"), (~F.col("all_covered"), 2, "R2_ATTRIBUTION_PARTIAL"), (origin & quiet, 4, "R4_ORIGINATING_SOURCE")],
        3, "R3_ATTRIBUTION_COMPLETE",
    )
    general = _rules([(none, 0, "R0_NO_SUPPORT"), (~F.col("all_covered"), 1, "R1_SOME_ATOMS"), (F.size(groups) < 2, 2, "R2_SINGLE_GROUP"), (every_atom_twice & quiet, 4, "R4_REPLICATED_PER_ATOM")], 3, "R3_CONVERGENT")
    return F.when(F.col("claim_type").isin(ATTRIBUTION_TYPES), attributed).otherwise(general)


def uncertainty() -> Column:
    relation, wording = F.col("relation"), F.col("wording_strength")
    return _rules(
        [
            (~wording.eqNullSafe(F.col("wording.strength")), 0, "U0_OVERSTATED"),
            (relation == "directly_supported", 4, "U4_EXACT_CALIBRATION"),
            (relation.isin("partially_supported", "indirectly_supported") & (wording == "qualified"), 3, "U3_CALIBRATED"),
            ((relation == "conflicted") & (wording == "contested"), 2, "U2_CONFLICT_DISCLOSED"),
            (relation.isin("unsupported", "overextended") & (wording == "qualified"), 1, "U1_WEAK_HEDGE"),
        ],
        0, "U0_OVERSTATED",
    )


def source_integrity() -> Column:
    every = lambda f: F.forall("relied", f)
    c = F.col("relied.c")
    return _rules(
        [
            (_has(c["bibliography_status"], "invented", "mismatch") | _has(c["integrity_status"], "retracted", "expression_of_concern") | _has(c["direction_match"], False), 0, "S0_COMPROMISED"),
            ((F.size("relied") == 0) | _has(c["bibliography_status"], "missing", "unverified") | _blank_doi(c), 1, "S1_UNRESOLVED"),
            (every(lambda x: _is(x["c"]["integrity_status"] == "not_checked")), 2, "S2_UNCHECKED"),
            (~every(lambda x: _is((x["c"]["integrity_status"] == "verified_no_known_issue") & (x["c"]["source_type"] == "primary")) & x["verified"]), 3, "S3_MIXED_CHECKS"),
        ],
        4, "S4_VERIFIED_PRIMARY",
    )


def scope() -> Column:
    status = F.col("scope_status")
    unknown = _has(F.col("relied.c.scope_match"), "unverified")
    fits = F.forall("eligible", lambda x: _is(x["c"]["scope_match"].isin("exact", "not_applicable")))
    return _rules(
        [
            (status == "overextended", 0, "X0_OVEREXTENDED"),
            ((status == "unverified") | unknown, 1, "X1_SCOPE_UNKNOWN"),
            (status == "major_difference_qualified", 2, "X2_MAJOR_QUALIFIER"),
            (status == "minor_difference_qualified", 3, "X3_MINOR_QUALIFIER"),
            ((status == "matched") & fits, 4, "X4_SCOPE_MATCHED"),
        ],
        1, "X1_SCOPE_UNKNOWN",
    )


def canonical_entries(bibliography: DataFrame) -> DataFrame:
    """``(cite_key, entry)``: each entry's DOI and the canonical forms of its authors, empty ones left out."""
    named = bibliography.select("cite_key", F.explode("authors").alias("a")).select("cite_key", tx.canonical_author("a").alias("author")).where("author <> ''")
    authors = named.groupBy("cite_key").agg(F.collect_set("author").alias("authors"))
    joined = bibliography.select("cite_key", "doi").join(authors, "cite_key", "left")
    return joined.select("cite_key", F.struct("doi", _array(F.col("authors"), "string").alias("authors")).alias("entry"))


def entries(bibliography: DataFrame, authors: bool = False) -> DataFrame:
    """``(cite_key, entry)``, one row a key; of entries with one key the greatest counts."""
    told = canonical_entries(bibliography) if authors else bibliography.select("cite_key", F.struct("doi").alias("entry"))
    return told.groupBy("cite_key").agg(F.max("entry").alias("entry"))


def with_entries(claims: DataFrame, bibliography: DataFrame, authors: bool = False) -> DataFrame:
    """Claims with ``entries``: for each key that they cite or have a context of, the bibliography's DOI and, on request, authors.

    This is the only join that scoring needs: keys are taken apart, met with the bibliography and put together again by claim.
    Claims of one id share a map, which then has the keys of all of them. Of entries with one key the greatest counts.
    """
    told = entries(bibliography, authors)
    keys = F.array_distinct(F.concat(_array(F.col("citation_keys"), "string"), _array(F.col("citation_contexts"), CONTEXT)["cite_key"]))
    cited = claims.select("claim_id", F.explode(keys).alias("cite_key")).where("cite_key is not null").distinct()
    maps = cited.join(told, "cite_key").groupBy("claim_id").agg(F.map_from_entries(F.collect_list(F.struct("cite_key", "entry"))).alias("entries"))
    return claims.join(maps, "claim_id", "left")


def unresolved() -> Column:
    """A cited key without a context or entry, or whose DOIs don't agree, or no cited key at all. Of contexts with one key the last counts."""

    def sound(key: Column) -> Column:
        context = F.try_element_at(F.filter("contexts", lambda x: x["c"]["cite_key"] == key), F.lit(-1))["c"]
        doi = F.col("entries")[key]["doi"]
        return _is((tx.lower(context["doi"]) == doi) & (doi != "") & ~_is(context["bibliography_status"].isin("missing", "mismatch", "invented")))

    keys = _array(F.col("citation_keys"), "string")
    return (F.size(keys) == 0) | F.exists(keys, lambda k: ~sound(k))


def traceability() -> Column:
    return _rules(
        [
            (F.col("unresolved"), 0, "T0_UNRESOLVED"),
            (F.size("eligible") == 0, 1, "T1_METADATA_ONLY"),
            (_has(F.col("relied.verified"), False), 2, "T2_PARTIAL_RECORD"),
            (~F.col("all_covered"), 3, "T3_ATOMS_INCOMPLETE"),
        ],
        4, "T4_ATOM_LEVEL",
    )


def cap_reasons(rubric: Rubric) -> Column:
    c = F.col("contexts.c")
    conditions = [
        (F.size("contexts") == 0) | (F.col("relation") == "unsupported") | _has(c["role"], "unverified") | _has(c["bibliography_status"], "missing"),
        _has(c["direction_match"], False),
        (F.col("n_conflicts") > 0) & ~F.col("wording_strength").eqNullSafe(F.lit("contested")),
        _has(c["bibliography_status"], "invented"),
        F.col("claim_type").isin(rubric.empirical) & ((F.size(_array(F.col("dois"), "string")) == 0) | _blank_doi(F.col("relied.c"))),
        F.col("scope_status") == "overextended",
    ]
    return F.array_compact(F.array(*[F.when(_is(c), F.lit(name)) for c, name in zip(conditions, CAP_REASONS)]))


def scored(claims: DataFrame, bibliography: DataFrame, as_of: str, rubric: Rubric | None = None, slim: bool = False) -> DataFrame:
    """Claims with relation, wording, the five components (score and rule), raw and capped score, reasons and label.

    Claims that have their ``entries`` (see :func:`with_entries`) are joined with nothing; ``slim`` as in :func:`with_features`.
    """
    rubric = rubric or Rubric()
    rows = with_features(claims if "entries" in claims.columns else with_entries(claims, bibliography), as_of, slim).withColumn("unresolved", unresolved())
    rows = rows.withColumn("relation", evidence_relation()).withColumn("wording", wording_basis(F.col("claim_text"), F.col("claim_type")))
    for name, rule in zip(COMPONENTS, (traceability(), robustness(), uncertainty(), source_integrity(), scope())):
        rows = rows.withColumn(name, rule)
    raw = sum((F.col(f"{c}.score") for c in COMPONENTS), F.lit(0)) * rubric.weight
    rows = rows.withColumn("raw_score", raw).withColumn("reasons", cap_reasons(rubric))
    rows = rows.withColumn("overall_score", F.when(F.size("reasons") > 0, F.least("raw_score", F.lit(rubric.cap))).otherwise(F.col("raw_score")))
    return rows.withColumn("trust_label", vl.band_label(F.col("overall_score"), rubric.bands)).withColumn("capped", F.size("reasons") > 0).withColumn("as_of", F.lit(as_of).cast("timestamp"))


def components_long(scores: DataFrame) -> DataFrame:
    """One row for each claim and component."""
    parts = F.array(*[F.struct(F.lit(c).alias("component"), F.col(f"{c}.score").alias("score"), F.col(f"{c}.rule_id").alias("rule_id")) for c in COMPONENTS])
    return scores.select("claim_id", F.explode(parts).alias("p")).select("claim_id", "p.*")


def atom_support(scores: DataFrame) -> DataFrame:
    """For each atom its eligible cite keys and independence groups."""
    of = lambda a: F.filter("eligible", lambda x: F.array_contains(x["atoms"], a))
    keys = F.transform("atom_ids", lambda a: F.struct(a.alias("atom_id"), F.transform(of(a), lambda x: x["c"]["cite_key"]).alias("cite_keys"), F.array_distinct(F.filter(F.transform(of(a), lambda x: x["c"]["independence_group"]), lambda g: g.isNotNull())).alias("groups")))
    return scores.select("claim_id", F.explode(keys).alias("a")).select("claim_id", "a.*")


def score_basis() -> Column:
    """What a scored row's score rests on, as reports state it; maps by atom are arrays of entries in the atoms' order."""
    of = lambda a: F.filter("eligible", lambda x: F.array_contains(x["atoms"], a))
    moment = F.col("as_of")
    cited = F.transform(
        "eligible",
        lambda x: F.struct(
            *[x["c"][f].alias(f) for f in ("cite_key", "doi", "role", "source_type", "supports_claim_atoms")],
            F.transform(F.filter(x["c"]["passages"], lambda p: verified_passage(p, moment)), lambda p: p["locator"]).alias("verified_passage_locators"),
            *[x["c"][f].alias(f) for f in ("independence_group", "scope_match")],
        ),
    )
    keys = F.transform("atom_ids", lambda a: F.struct(a.alias("atom_id"), F.transform(of(a), lambda x: x["c"]["cite_key"]).alias("cite_keys")))
    groups = F.transform("atom_ids", lambda a: F.struct(a.alias("atom_id"), F.array_distinct(F.filter(F.transform(of(a), lambda x: x["c"]["independence_group"]), lambda g: _is(g != ""))).alias("groups")))
    return F.struct(
        "claim_text", cited.alias("eligible_citations"), keys.alias("atom_support"), groups.alias("independence_groups_by_atom"), F.col("relation").alias("derived_evidence_relation"),
        "wording_strength", F.col("wording").alias("wording_basis"), "modality", "scope_status",
    )


def summary(scores: DataFrame) -> DataFrame:
    """Counts for each label, and mean, least, greatest and capped scores."""
    by_label = [F.count_if(F.col("trust_label") == x).alias(x) for x in vl.LABELS]
    return scores.agg(F.count("*").alias("total_claims"), *by_label, F.avg("overall_score").alias("mean"), F.min("overall_score").alias("low"), F.max("overall_score").alias("high"), F.count_if("capped").alias("n_capped"))


def shared_author_pairs(claims: DataFrame, bibliography: DataFrame) -> DataFrame:
    """Supporting contexts of one claim in different, named independence groups whose entries share an author.

    Authors are compared in their canonical form; an empty one is no author, and a context without a group is in none.
    """
    entries = canonical_entries(bibliography).select("cite_key", F.col("entry.authors").alias("authors")).where(F.size("authors") > 0)
    rows = claims.select("claim_id", F.posexplode("citation_contexts").alias("ord", "c")).where(F.col("c.role").isin(SUPPORT_ROLES) & (F.col("c.independence_group") != ""))
    rows = rows.select("claim_id", "ord", F.col("c.cite_key").alias("cite_key"), F.col("c.independence_group").alias("grp")).join(entries, "cite_key")
    a, b = rows.alias("a"), rows.alias("b")
    hit = F.expr("a.claim_id = b.claim_id and a.ord < b.ord and a.grp <> b.grp and arrays_overlap(a.authors, b.authors)")
    return a.join(b, hit).select("a.claim_id", F.col("a.cite_key").alias("left_key"), F.col("b.cite_key").alias("right_key"))
