"""Revision backlog: proposals grouped by theme, with the gates that may not be weakened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.plans.checks import Check, must_hold

PRIORITIES = ["critical", "high", "medium", "low"]
SOURCES = ["human_submission", "evidence_radar", "validator", "maintainer"]
RADAR_PRIORITY = {"retraction": "critical", "expression_of_concern": "critical", "correction": "high", "new_work": "medium"}
FORCED_SOURCES = ["evidence_radar", "human_submission"]
FORCED_PREFIXES = ["content/", "knowledge/"]


def from_radar(proposals: DataFrame) -> DataFrame:
    """Radar proposals as planner input; they always need scientific approval."""
    return radar_rows(proposals, "affected_claim_ids")


def radar_rows(proposals: DataFrame, *more: str) -> DataFrame:
    """:func:`from_radar` without the claims; ``more`` names columns to keep."""
    words = F.replace("alert_type", F.lit("_"), F.lit(" "))
    return proposals.select(
        F.concat(F.lit("proposal-"), F.replace("proposal_id", F.lit("_"), F.lit("-"))).alias("proposal_id"),
        F.lit("evidence_radar").alias("source_type"),
        F.lit("trust-evidence").alias("theme"),
        F.concat(words, F.lit(": "), vl.or_default(F.col("work.title"), "untitled work")).alias("title"),
        vl.lookup(RADAR_PRIORITY, F.col("alert_type")).alias("priority"),
        *more,
        F.array(F.lit("knowledge/claim_graph.json")).alias("target_files"),
        F.lit(True).alias("scientific_approval_required"),
    )


def checks(proposals: DataFrame, themes: DataFrame, claims: DataFrame | None = None) -> list[Check]:
    """Input rules; ``claims`` (theme, claim_id) takes the place of the proposals' ``affected_claim_ids`` where they are kept apart."""
    key, form = F.col("proposal_id"), "^clm_[a-f0-9]{16}$"
    return [
        Check("proposal id form", proposals, key.rlike("^proposal-[a-z0-9][a-z0-9-]{2,80}$"), key),
        Check("proposal id is unique", proposals.groupBy("proposal_id").count(), F.col("count") == 1, key),
        Check("source type", proposals, F.col("source_type").isin(SOURCES), key),
        Check("known theme", proposals.join(themes.select(F.col("theme_id").alias("theme")), "theme", "left_anti"), F.lit(False), key),
        Check("title", proposals, F.length(F.trim("title")) >= 8, key),
        Check("priority", proposals, F.col("priority").isin(PRIORITIES), key),
        Check("claim ids", proposals, F.forall("affected_claim_ids", lambda c: c.rlike(form)), key) if claims is None else Check("claim ids", claims, F.col("claim_id").rlike(form), F.col("claim_id")),
        Check("target files", proposals, (F.size("target_files") > 0) & F.forall("target_files", lambda p: tx.safe_relative_path(F.replace(p, F.lit("\\"), F.lit("/")))), key),
        Check("approval flag", proposals, F.col("scientific_approval_required").isNotNull(), key),
    ]


def guard(policy: dict) -> None:
    """A configuration may not weaken the policy."""
    wanted = {"proposal_only": True, "trust_scores_are_validator_owned": True, "scientific_approval_forced_for_sources": FORCED_SOURCES, "scientific_approval_forced_for_path_prefixes": FORCED_PREFIXES}
    weak = [k for k, v in wanted.items() if policy.get(k) != v]
    if weak:
        raise ValueError(f"policy must not be weakened: {', '.join(weak)}")


def _files() -> Column:
    return F.array_sort(F.array_distinct(F.transform("target_files", lambda p: F.replace(p, F.lit("\\"), F.lit("/")))))


def _forced() -> Column:
    return F.col("source_type").isin(FORCED_SOURCES) | F.exists(_files(), lambda p: F.lit(False) | p.startswith(FORCED_PREFIXES[0]) | p.startswith(FORCED_PREFIXES[1]))


def _rank() -> Column:
    return vl.ladder([(F.col("priority") == p, i) for i, p in enumerate(PRIORITIES)], len(PRIORITIES))


def _themed(grouped: DataFrame, themes: DataFrame) -> DataFrame:
    """The themes that ``grouped`` (theme_id, ...) has, in the order of declaration, with those they depend on."""
    present = grouped.select(F.col("theme_id").alias("dep"))
    depends = themes.select("theme_id", F.explode("depends_on").alias("dep")).join(present, "dep", "left_semi").groupBy("theme_id").agg(F.array_sort(F.collect_set("dep")).alias("depends_on"))
    named = themes.select("theme_ord", "theme_id", "title", F.col("owner").alias("assigned_agent"), F.concat(F.lit("agent/"), "theme_id").alias("suggested_branch"))
    return named.join(grouped, "theme_id").join(depends, "theme_id", "left").withColumn("depends_on", F.coalesce("depends_on", F.array().cast("array<string>"))).orderBy("theme_ord")


def backlog(proposals: DataFrame, themes: DataFrame, policy: dict) -> DataFrame:
    """One row for each theme that has proposals, in the order of declaration (``theme_ord``), with the proposals in it.

    ``themes`` has (theme_ord, theme_id, title, owner, depends_on). A theme is one row, and so must fit one; :func:`outline` tells of
    themes of any size.
    """
    guard(policy)
    must_hold(checks(proposals, themes))
    one = F.struct(_rank().alias("rank"), "proposal_id", "source_type", F.trim("title").alias("title"), "priority", tx.sorted_unique("affected_claim_ids").alias("affected_claim_ids"), _files().alias("target_files"), (F.col("scientific_approval_required") | _forced()).alias("approval"), _forced().alias("forced"))
    grouped = proposals.groupBy(F.col("theme").alias("theme_id")).agg(
        F.array_sort(F.collect_list(one)).alias("proposals"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("affected_claim_ids")))).alias("affected_claim_ids"),
        F.bool_or(F.col("scientific_approval_required") | _forced()).alias("scientific_approval_required"),
    )
    return _themed(grouped, themes)


def outline(proposals: DataFrame, claims: DataFrame, themes: DataFrame, policy: dict) -> DataFrame:
    """:func:`backlog` in numbers: each theme's proposals and distinct affected claims counted, the most urgent proposal, the approval.

    ``proposals`` need no claims; ``claims`` has (theme, claim_id). Every sum is combined before it is shuffled, so that a theme holds
    any number of proposals and claims.
    """
    guard(policy)
    must_hold(checks(proposals, themes, claims))
    grouped = proposals.groupBy(F.col("theme").alias("theme_id")).agg(F.count("*").alias("n_proposals"), F.min(F.struct(_rank().alias("rank"), "proposal_id"))["proposal_id"].alias("first_id"), F.bool_or(F.col("scientific_approval_required") | _forced()).alias("scientific_approval_required"))
    counted = claims.distinct().groupBy(F.col("theme").alias("theme_id")).agg(F.count("claim_id").alias("n_claims"))
    return _themed(grouped.join(counted, "theme_id", "left").fillna(0, ["n_claims"]), themes)


def totals(plan: DataFrame) -> DataFrame:
    claims = plan.select(F.explode_outer("affected_claim_ids").alias("c"))
    n = claims.agg(F.count_distinct("c").alias("affected_claim_count"))
    return plan.agg(F.coalesce(F.sum(F.size("proposals")), F.lit(0)).alias("proposal_count"), F.count("*").alias("theme_count")).crossJoin(n)
