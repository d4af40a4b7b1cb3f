"""Repository-wide checks of claims, graph, bibliography and derived records: one table of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions.values import LABELS, moment
from claimloom.operators.relational import zero_filled_counts
from claimloom.plans.scoring import SUPPORT_ROLES, Rubric, score_basis, scored, verified_passage, with_entries
from claimloom.sources.schemas import COMPONENTS, CONTEXT, PASSAGE

#: Fixed value: the version that records of this rubric state.
RUBRIC_VERSION = "2.0.0"


def _all(conditions: list) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def index_records(claims: DataFrame) -> DataFrame:
    """What the claim index says of each claim."""
    score = F.col("trust_score")
    return claims.select("claim_id", "source_file", "section_id", "paragraph_index", "sentence_index", "claim_text", "citation_keys", score["overall_score"].alias("overall_score"), score["trust_label"].alias("trust_label"), "human_review_required")


def seed_records(claims: DataFrame) -> DataFrame:
    """What the seed index says of each claim."""
    return claims.select("claim_id", "section_id", "claim_text", "normalized_claim", "claim_type", "modality", "validation_status", "citation_keys", "dois")


def stored_components(claims: DataFrame) -> DataFrame:
    """``(claim_id, component, score, rule_id, rationale)`` of the stored score, one row for each component."""
    parts = F.array(*[F.struct(F.lit(c).alias("component"), *[F.col(f"trust_score.components.{c}.{x}").alias(x) for x in ("score", "rule_id", "rationale")]) for c in COMPONENTS])
    return claims.where("trust_score is not null").select("claim_id", F.explode(parts).alias("p")).select("claim_id", "p.*")


def basis_records(claims: DataFrame, bibliography: DataFrame, as_of: str) -> DataFrame:
    """``(claim_id, score_basis)``: what each claim's score rests on."""
    return scored(claims, bibliography, as_of).select("claim_id", score_basis().alias("score_basis"))


def report_records(claims: DataFrame) -> DataFrame:
    """What the score report says of each claim: components with their rules, totals, label and caps."""
    score = F.col("trust_score")
    of = lambda x, name: F.struct(*[score["components"][c][x].alias(c) for c in COMPONENTS]).alias(name)
    return claims.select("claim_id", of("score", "component_scores"), of("rule_id", "component_rules"), *[score[x].alias(x) for x in ("raw_score", "overall_score", "trust_label", "capped", "cap_reasons")])


def summary_record(claims: DataFrame) -> DataFrame:
    """The counts that the graph's summary states."""
    return claims.agg(F.count("*").alias("total_claims"), *[F.count_if(F.col("trust_score.trust_label") == x).alias(x) for x in LABELS], F.count_if("human_review_required").alias("needs_human_review"))


#: Options that a writer may not set in a directive.
FORBIDDEN_OPTIONS = ["score", "trust-label", "cap-reason"]


def directive_problems(claims: DataFrame, directives: DataFrame) -> DataFrame:
    """``(claim_id, problem)`` of each claim's first directive (file, ord, options) on its own page: missing, other text, keys, type or modality, options not the writer's."""
    told = directives.select("file", "ord", F.col("options")["claim-id"].alias("claim_id"), "options").where("claim_id is not null and file is not null")
    first = told.groupBy("claim_id", "file").agg(F.min_by("options", "ord").alias("o"))
    # claims are met by their id alone, so that a table of claims kept by id isn't shuffled for its files
    pages = first.groupBy("claim_id").agg(F.map_from_entries(F.collect_list(F.struct("file", "o"))).alias("pages"))
    rows = claims.join(pages, "claim_id", "left").withColumn("o", F.col("pages")[F.col("source_file")])
    o, none = F.col("o"), F.array().cast("array<string>")
    differ = lambda key, own: ~o[key].eqNullSafe(own)
    found = [
        (o.isNull(), "no directive"), (o.isNotNull() & differ("claim", F.col("claim_text")), "claim text"),
        (o.isNotNull() & ~tx.split_list(o["cites"]).eqNullSafe(F.coalesce("citation_keys", none)), "cites"),
        (o.isNotNull() & differ("claim-type", F.col("claim_type")), "claim type"), (o.isNotNull() & differ("modality", F.col("modality")), "modality"),
        *[(F.coalesce(F.map_contains_key(o, k), F.lit(False)), f"forbidden {k}") for k in FORBIDDEN_OPTIONS],
    ]
    return rows.select("claim_id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in found]))).alias("problem"))


#: Relation and weight that an edge to a supporting context has.
EDGE_OF_ROLE = {"direct_support": ("supports", 1.0), "partial_support": ("partially_supports", 0.5)}


def derived_mismatches(expected: DataFrame, stored: DataFrame, key: str = "claim_id") -> DataFrame:
    """Keys missing on either side, or whose shared columns differ."""
    fields = [c for c in expected.columns if c != key]
    old = stored.select(key, F.struct(*fields).alias("stored"))
    new = expected.select(key, F.struct(*fields).alias("expected"))
    return new.join(old, key, "full").where(~F.col("expected").eqNullSafe(F.col("stored"))).select(key, F.when(F.col("stored").isNull(), "missing").when(F.col("expected").isNull(), "surplus").otherwise("differs").alias("problem"))


def report_summary(claims: DataFrame) -> DataFrame:
    """The one row that the report's summary states, from the stored scores."""
    score = F.col("trust_score.overall_score")
    labels = [F.count_if(F.col("trust_score.trust_label") == x).alias(x) for x in LABELS]
    return claims.agg(
        F.count("*").alias("total_claims"), F.avg(score).alias("mean_overall_score"), F.min(score).alias("minimum_overall_score"), F.max(score).alias("maximum_overall_score"),
        *labels, F.count_if("trust_score.capped").alias("capped_claims"), F.count_if("human_review_required").alias("needs_human_review"),
    )


def gate_counts(claims: DataFrame, as_of: str) -> DataFrame:
    """The counts that a passing gate states: claims, their contexts, and verified passages."""
    moment = F.lit(as_of).cast("timestamp")
    contexts = F.coalesce("citation_contexts", F.array().cast(f"array<{CONTEXT}>"))
    passages = F.flatten(F.transform(contexts, lambda c: F.coalesce(c["passages"], F.array().cast(f"array<{PASSAGE}>"))))
    verified = F.filter(passages, lambda p: verified_passage(p, moment))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    return claims.agg(F.count("*").alias("claims"), total(F.size(contexts)).alias("citation_contexts"), total(F.size(verified)).alias("verified_passages"), F.lit(0).cast("bigint").alias("failures"))


def _array(name: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(name), F.array().cast(f"array<{kind}>"))


def _is(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _blank(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


def _broken(name: str, holds: Column, key: Column | None = None) -> Column:
    """One violation, or null; an unknown outcome breaks the rule."""
    return F.when(~_is(holds), F.struct(F.lit(name).alias("check_name"), (F.col("claim_id") if key is None else key).alias("key")))


def _each(name: str, items: Column | str, bad) -> Column:
    """A violation for each item that is ``bad``."""
    return F.transform(F.filter(items, lambda x: _is(bad(x))), lambda x: F.struct(F.lit(name).alias("check_name"), F.col("claim_id").alias("key")))


def _https(x: Column) -> Column:
    return _is(x.startswith("https://"))


#: The rules of one claim, in the order in which :func:`claim_rules` tries them; those of its file and paragraph are :func:`text_violations`.
CLAIM_CHECKS = [
    "claim id", "normalized claim", "paragraph index", "claim has atoms", "atom ids unique", "atom id form", "atom text", "citation keys unique", "cite keys unique", "DOIs unique", "keys have contexts", "keys in context order", "DOIs in context order",
    "evidence relation", "wording strength", "score stored", *[f"{c} score" for c in COMPONENTS], "rule ids", "raw score", "overall score", "trust label", "capped flag", "cap value", "cap reasons", "cap reason", "score version", "computed from", "review resolved",
    "source file", "claim stands in its paragraph",
    "cited key without entry", "context DOI", "atoms exist", "atoms of verified passages", "integrity time", "integrity source", "supporting context names its independence basis",
    "passage length", "passage locator", "passage names atoms", "passage atoms exist", "verified passage source", "verified passage time", "shared author across groups",
]
#: Rules over several rows or other tables.
TABLE_CHECKS = [
    "duplicate claim", "edge weight", "edge of unknown claim", "edge without context", "edge relation or weight", "context without edge",
    "index record", "seed record", "report record", "report basis", "graph summary", "report summary", "gate status", "gate checks", "gate counts", "artifact version", "directive",
]


def claim_rules(version: str, cap: int) -> Column:
    """All violations of a claim's own rules: (check_name, key) in one array, from conditions over the row of :func:`claim_rows`."""
    key = F.col("claim_id")
    keys, dois, context_keys = _array("citation_keys"), _array("dois"), F.transform("contexts", lambda x: x["c"]["cite_key"])
    context_dois = F.filter(F.transform("contexts", lambda x: x["c"]["doi"]), lambda d: ~_blank(d))
    distinct = lambda xs: F.size(F.array_distinct(xs)) == F.size(xs)
    told, has = F.col("trust_score"), F.col("trust_score").isNotNull()
    states = lambda name, x: _broken(name, ~has | told[name.replace(" ", "_")].eqNullSafe(x))
    capped = F.size("reasons") > 0
    part = lambda c, x: told["components"][c][x]
    single = [
        _broken("claim id", key == F.col("own_id")),
        _broken("normalized claim", F.col("normalized_claim") == F.col("own_form")),
        _broken("paragraph index", F.col("paragraph_index") >= 1),
        _broken("claim has atoms", F.size("atom_ids") > 0),
        _broken("atom ids unique", distinct("atom_ids")),
        _broken("atom id form", F.forall("atom_ids", lambda a: _is(a.rlike("^a[1-9][0-9]*$")))),
        _broken("citation keys unique", distinct(keys)),
        _broken("cite keys unique", distinct(context_keys)),
        _broken("DOIs unique", distinct(F.transform(dois, F.lower))),
        _broken("keys have contexts", F.size(F.array_except(keys, context_keys)) == 0),
        _broken("keys in context order", keys == context_keys),
        _broken("DOIs in context order", dois == context_dois),
        _broken("evidence relation", F.col("evidence_relation") == F.col("relation")),
        _broken("wording strength", F.col("wording_strength") == F.col("wording.strength")),
        _broken("score stored", has),
        *[_broken(f"{c} score", ~has | part(c, "score").eqNullSafe(F.col(f"{c}.score"))) for c in COMPONENTS],
        _broken("rule ids", ~has | _all([part(c, "rule_id").eqNullSafe(F.col(f"{c}.rule_id")) for c in COMPONENTS])),
        states("raw score", F.col("raw_score")),
        states("overall score", F.col("overall_score")),
        states("trust label", F.col("own_label")),
        _broken("capped flag", ~has | told["capped"].eqNullSafe(capped)),
        states("cap value", F.when(capped, F.lit(cap))),
        states("cap reasons", F.col("reasons")),
        states("cap reason", F.get("reasons", F.lit(0))),
        _broken("score version", ~has | told["rubric_version"].eqNullSafe(F.lit(version))),
        states("computed from", F.lit("validator")),
        _broken("review resolved", ~(_is(told["trust_label"].isin("high_trust", "moderate_trust")) & _is(F.col("human_review_required")))),
    ]
    atoms = F.col("atom_ids")
    supports = lambda p: F.coalesce(p["supports_claim_atoms"], F.array().cast("array<string>"))
    entry = lambda x: F.col("entries")[x["c"]["cite_key"]]
    checked = lambda x: _is(x["c"]["integrity_status"] == "verified_no_known_issue")
    past = lambda at: _is(moment(at) <= F.col("as_of"))
    verified = lambda p: _is(p["verification_status"] == "verified")
    shared = F.flatten(F.transform("relied", lambda x, i: F.filter(F.slice("relied", i + 2, F.size("relied")), lambda y: (
        ~_blank(x["c"]["independence_group"]) & ~_blank(y["c"]["independence_group"]) & (x["c"]["independence_group"] != y["c"]["independence_group"])
        & _is(F.arrays_overlap(entry(x)["authors"], entry(y)["authors"]))
    ))))
    several = [
        _each("atom text", F.coalesce("claim_atoms", F.array().cast("array<struct<atom_id:string,text:string>>")), lambda a: ~_is(F.contains(F.col("claim_text"), a["text"]))),
        _each("cited key without entry", "contexts", lambda x: entry(x).isNull()),
        _each("context DOI", "contexts", lambda x: entry(x).isNotNull() & ~F.lower(F.coalesce(x["c"]["doi"], F.lit(""))).eqNullSafe(entry(x)["doi"])),
        _each("atoms exist", "contexts", lambda x: F.size(F.array_except(supports(x["c"]), atoms)) > 0),
        _each("atoms of verified passages", "contexts", lambda x: F.array_sort(F.array_distinct(supports(x["c"]))) != F.array_sort(x["atoms"])),
        _each("integrity time", "contexts", lambda x: checked(x) & ~past(x["c"]["integrity_checked_at"])),
        _each("integrity source", "contexts", lambda x: checked(x) & ~_https(x["c"]["integrity_check_source"])),
        _each("supporting context names its independence basis", "contexts", lambda x: x["supports"] & (tx.collapse(F.coalesce(x["c"]["independence_basis"], F.lit(""))) == "")),
        _each("passage length", "passage_words", lambda n: n > 25),
        _each("passage locator", "passages", lambda p: _blank(p["locator"])),
        _each("passage names atoms", "passages", lambda p: F.size(supports(p)) == 0),
        _each("passage atoms exist", "passages", lambda p: F.size(F.array_except(supports(p), atoms)) > 0),
        _each("verified passage source", "passages", lambda p: verified(p) & ~_https(p["verification_source"])),
        _each("verified passage time", "passages", lambda p: verified(p) & ~past(p["verified_at"])),
        _each("shared author across groups", shared, lambda x: F.lit(True)),
    ]
    return F.concat(F.array_compact(F.array(*single)), *several)


def claim_rows(claims: DataFrame, bibliography: DataFrame, as_of: str, rubric: Rubric) -> DataFrame:
    """A row for each claim with all that its own rules read: joined is the bibliography, nothing else, and that only where claims don't have their ``entries`` with authors."""
    rows = claims if "entries" in claims.columns else with_entries(claims, bibliography, authors=True)
    rows = scored(rows, bibliography, as_of, rubric).withColumnRenamed("trust_label", "own_label")
    passages = F.flatten(F.transform("contexts", lambda x: F.coalesce(x["c"]["passages"], F.array().cast(f"array<{PASSAGE}>"))))
    rows = rows.withColumn("passages", passages).withColumn("passage_texts", tx.nfkc_each(F.transform("passages", lambda p: F.coalesce(p["text"], F.lit("")))))
    words = F.transform("passage_texts", lambda x: F.size(F.split(tx.collapse(x), " ")))
    return rows.withColumn("passage_words", words).withColumn("own_id", tx.claim_id("section_id", "claim_text")).withColumn("own_form", tx.normalize_claim("claim_text"))


def text_violations(claims: DataFrame, paragraphs: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``(check_name, key)`` of claims whose source file isn't there, or whose text isn't in their paragraph of a file that is.

    Only a claim's id, place and text travel. Without ``files`` those of the paragraphs count, so that only claims that don't stand in one ask for their file.
    """
    place = ["source_file", "paragraph_index"]
    told = paragraphs.select(F.col("file").alias("source_file"), "paragraph_index", F.col("text").alias("paragraph"))
    rows = claims.select("claim_id", "claim_text", *place).join(told, place, "left").select("claim_id", "source_file", _is(F.contains("paragraph", "claim_text")).alias("stands"))
    if files is None:
        rows = rows.where(~F.col("stands"))
    has = (paragraphs if files is None else files).select(F.col("file").alias("source_file"), F.lit(True).alias("has_file")).distinct()
    name = F.when(F.col("has_file").isNull(), "source file").when(~F.col("stands"), "claim stands in its paragraph")
    return rows.join(has, "source_file", "left").select(name.alias("check_name"), F.col("claim_id").alias("key")).where("check_name is not null")


def edge_violations(claims: DataFrame, edges: DataFrame) -> DataFrame:
    """``(check_name, key)`` of edges against their claims' contexts, and of supporting contexts without an edge of any kind.

    An edge of an unknown claim breaks that rule alone. Of contexts with one key the first counts. Edges meet claims by the claim's
    id alone and stay there: claims kept by id aren't shuffled, and edges are once.
    """
    context = F.posexplode_outer("citation_contexts").alias("ord", "c")
    told = claims.select("claim_id", context).groupBy(F.col("claim_id").alias("source_claim_id"), F.col("c.cite_key").alias("target"))
    told = told.agg(F.min_by("c.role", "ord").alias("role"), F.max(F.coalesce(F.col("c.role").isin(SUPPORT_ROLES), F.lit(False))).alias("supports"))
    own = F.map_from_entries(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", F.struct("role", "supports")))))
    known = told.groupBy("source_claim_id").agg(own.alias("own"))
    met = edges.join(known, "source_claim_id", "left").withColumn("context", F.col("own")[F.col("target")])
    wanted = F.lit(True)
    for role, (relation, weight) in EDGE_OF_ROLE.items():
        wanted = wanted & (~_is(F.col("context.role") == role) | (F.col("relation").eqNullSafe(F.lit(relation)) & F.col("weight").eqNullSafe(F.lit(weight))))
    has, there = F.col("own").isNotNull(), F.col("context").isNotNull()
    rules = [
        ("edge weight", ~_is(F.col("weight").between(0, 1))),
        ("edge of unknown claim", ~has),
        ("edge without context", has & ~there & _is(F.col("target_type") == "citation")),
        ("edge relation or weight", has & there & ~wanted),
    ]
    found = met.select(F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules]))).alias("check_name"), F.col("source_claim_id").alias("key"))
    linked = met.where("context.supports").groupBy("source_claim_id", "target").agg(F.lit(1)).groupBy("source_claim_id").agg(F.count("*").alias("linked"))
    left = told.where("target is not null and supports").groupBy("source_claim_id").agg(F.count("*").alias("n")).join(linked, "source_claim_id", "left")
    alone = F.array_repeat(F.lit("context without edge"), (F.col("n") - F.coalesce("linked", F.lit(0))).cast("int"))
    return found.unionByName(left.select(F.explode(alone).alias("check_name"), F.col("source_claim_id").alias("key")))


def validate(
    claims: DataFrame, edges: DataFrame, bibliography: DataFrame, paragraphs: DataFrame, as_of: str, index: DataFrame | None = None, seeds: DataFrame | None = None, report: DataFrame | None = None, summary: DataFrame | None = None, directives: DataFrame | None = None,
    *, bases: DataFrame | None = None, scores_summary: DataFrame | None = None, gate: DataFrame | None = None, artifacts: DataFrame | None = None, files: DataFrame | None = None, version: str = RUBRIC_VERSION, rubric: Rubric | None = None,
) -> DataFrame:
    """All violations (check_name, key, blocking).

    A claim's own rules are one array of violations, made from one row in which everything about the claim is joined, and
    exploded once; rules over other tables are a join each, of the few fields that they read. Claims may come with their ``entries``
    (see :func:`with_entries`, with authors). ``paragraphs`` has (file, paragraph_index, text); ``files`` names
    the source files there are (those of the paragraphs, where it isn't given).

    Stored tables that are given are compared too: ``index``, ``seeds``, ``report`` and ``bases`` (claim_id, score_basis) by
    claim; one row each of the graph's ``summary``, the report's ``scores_summary`` and the ``gate`` (status, failures, checks,
    counts); ``artifacts`` (name, schema_version, rubric_version); and the pages' trust ``directives`` (file, ord, options).

    A claim without a stored score breaks one rule by that, and none that compares the score's fields.
    """
    rubric = rubric or Rubric()
    rows = claim_rows(claims, bibliography, as_of, rubric)
    found = [
        rows.select(F.explode(claim_rules(version, rubric.cap)).alias("v")).select("v.*"),
        claims.groupBy("claim_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate claim").alias("check_name"), F.col("claim_id").alias("key")),
        text_violations(claims, paragraphs, files),
        edge_violations(claims, edges),
    ]
    for name, own, told in (("index record", index_records, index), ("seed record", seed_records, seeds), ("report record", report_records, report), ("report basis", lambda c: basis_records(c, bibliography, as_of), bases)):
        if told is not None:
            found.append(derived_mismatches(own(claims), told).select(F.lit(name).alias("check_name"), F.col("claim_id").alias("key")))
    for name, own, told in (("graph summary", summary_record, summary), ("report summary", report_summary, scores_summary)):
        if told is not None:
            expected = own(claims)
            found.append(expected.exceptAll(told.select(*[F.col(f.name).cast(f.dataType) for f in expected.schema])).select(F.lit(name).alias("check_name"), F.lit("summary").alias("key")))
    if gate is not None:
        counts = gate.select(*[F.col(f"counts.{c}").cast("bigint").alias(c) for c in ("claims", "citation_contexts", "verified_passages", "failures")])
        sound = {"gate status": (F.col("status") == "pass") & (F.size("failures") == 0), "gate checks": F.forall(F.map_values("checks"), lambda x: _is(x))}
        found += [gate.where(~_is(c)).select(F.lit(name).alias("check_name"), F.lit("gate").alias("key")) for name, c in sound.items()]
        found.append(gate_counts(claims, as_of).exceptAll(counts).select(F.lit("gate counts").alias("check_name"), F.lit("gate").alias("key")))
    if artifacts is not None:
        own = F.col("schema_version").eqNullSafe(F.lit(version)) & ((F.col("name") == "seed") | F.col("rubric_version").eqNullSafe(F.lit(version)))
        found.append(artifacts.where(~_is(own)).select(F.lit("artifact version").alias("check_name"), F.col("name").alias("key")))
    if directives is not None:
        found.append(directive_problems(claims, directives).select(F.lit("directive").alias("check_name"), F.concat_ws(": ", "claim_id", "problem").alias("key")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.withColumn("blocking", F.lit(True))


def check_counts(found: DataFrame) -> DataFrame:
    """``(check_name, n)`` for every rule, zeros included."""
    return zero_filled_counts(found, "check_name", [*CLAIM_CHECKS, *TABLE_CHECKS])
