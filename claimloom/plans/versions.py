"""Differences between two frozen review versions. Scores are compared, never computed anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.operators.relational import fill_dimension
from claimloom.plans.checks import Check, must_hold
from claimloom.sources.schemas import COMPONENTS

STATUSES = ["added", "removed", "modified", "unchanged"]
CLAIM_ID = "^clm_[a-f0-9]{16}$"
SHA256 = "^[a-f0-9]{64}$"


def snapshot_checks(claims: DataFrame, anchors: DataFrame) -> list[Check]:
    key, anchor, s = F.col("claim_id"), F.col("anchor_id"), F.col("selector")
    ids = claims.select("claim_id")
    related = claims.select("claim_id", F.explode("relations").alias("r")).select("claim_id", "r.*")
    unique = lambda c: F.size(F.array_distinct(c)) == F.size(c)
    scores = [F.col(f"trust.component_scores.{c}").between(0, 4) for c in COMPONENTS]
    whole = scores[0]
    for x in scores[1:]:
        whole = whole & x
    return [
        Check("claim id form", claims, key.rlike(CLAIM_ID), key),
        Check("claim id is unique", claims.groupBy("claim_id").count(), F.col("count") == 1, key),
        Check("anchor id is unique", anchors.groupBy("anchor_id").count(), F.col("count") == 1, anchor),
        Check("superseded ids", claims, unique("supersedes_claim_ids") & F.forall("supersedes_claim_ids", lambda x: x.rlike(CLAIM_ID)), key),
        Check("claim text", claims, F.length("claim_text") > 0, key),
        Check("citation keys are unique", claims, unique("citation_keys"), key),
        Check("decisions are unique", claims, unique("human_decision_references"), key),
        Check("component scores", claims, whole, key),
        Check("overall score", claims, F.col("trust.overall_score").between(0, 100) & F.col("trust.report_sha256").rlike(SHA256), key),
        Check("relation", related, F.col("predicate").isin("supports", "contradicts", "qualifies"), key),
        Check("relation target exists", related.join(ids.withColumnRenamed("claim_id", "target_claim_id"), "target_claim_id", "left_anti"), F.lit(False), key),
        Check("anchor selector", anchors, ((s["kind"] == "claim") & s["claim_id"].rlike(CLAIM_ID)) | ((s["kind"] == "text") & (s["source_path"] != "") & s["source_sha256"].rlike(SHA256) & (s["exact_quote"] != "")), anchor),
        Check("anchored claim exists", anchors.where(s["kind"] == "claim").select("anchor_id", s["claim_id"].alias("claim_id")).join(ids, "claim_id", "left_anti"), F.lit(False), anchor),
    ]


def report_mismatches(claims: DataFrame, report: DataFrame, digest: str, release_rubric: str) -> DataFrame:
    """Snapshot claims against the frozen report's records (claim_id, component_scores, overall_score, trust_label)."""
    told = report.select("claim_id", F.struct("component_scores", "overall_score", "trust_label").alias("told"))
    own = claims.select("claim_id", F.struct("trust.component_scores", "trust.overall_score", "trust.trust_label").alias("own"), "trust")
    bad = ~F.col("own").eqNullSafe(F.col("told")) | (F.col("trust.report_sha256") != digest) | (F.col("trust.rubric_version") != release_rubric)
    return own.join(told, "claim_id", "full").where(bad).select("claim_id")


def succession(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(old_id, new_id)``: the same id, else the claim that names it as superseded. Strictly one to one, or it raises."""
    old = before.select(F.col("claim_id").alias("old_id"))
    same = after.select(F.col("claim_id").alias("old_id"), F.col("claim_id").alias("new_id"))
    named = after.select(F.explode("supersedes_claim_ids").alias("old_id"), F.col("claim_id").alias("new_id"))
    pairs = same.unionByName(named).join(old, "old_id", "left_semi")
    must_hold([
        Check("one successor", pairs.groupBy("old_id").count(), F.col("count") == 1, F.col("old_id")),
        Check("one predecessor", pairs.groupBy("new_id").count(), F.col("count") == 1, F.col("new_id")),
    ])
    return pairs


def compare(before: DataFrame, after: DataFrame, pairs: DataFrame) -> DataFrame:
    """A row for each claim of either version, in the order of the comparison: status and what changed."""
    state = lambda p: ["claim_id", "claim_text", "citation_keys", "evidence_basis", "trust", "human_decision_references"]
    old = before.select(F.struct(*state("b")).alias("b"), F.col("claim_id").alias("old_id"))
    new = after.select(F.struct(*state("a")).alias("a"), F.col("claim_id").alias("new_id"))
    matched = old.join(pairs, "old_id", "left")
    rows = matched.join(new, "new_id", "full").where(F.col("b").isNotNull() | F.col("a").isNotNull())
    meaning = lambda x: F.struct(*[F.col(f"{x}.{c}") for c in ("claim_id", "claim_text", "citation_keys", "evidence_basis", "human_decision_references")], *[F.col(f"{x}.trust.{c}") for c in ("rubric_version", "component_scores", "overall_score", "trust_label")])
    status = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(meaning("b").eqNullSafe(meaning("a")), "unchanged").otherwise("modified")
    change = lambda path: F.when(~F.col(f"b.{path}").eqNullSafe(F.col(f"a.{path}")), F.struct(F.col(f"b.{path}").alias("before"), F.col(f"a.{path}").alias("after")))
    parts = F.array(*[F.struct(F.lit(c).alias("component"), F.col(f"b.trust.component_scores.{c}").alias("before"), F.col(f"a.trust.component_scores.{c}").alias("after")) for c in COMPONENTS])
    told = rows.select(
        F.concat(F.coalesce("b.claim_id", F.lit("none")), F.lit("--"), F.coalesce("a.claim_id", F.lit("none"))).alias("comparison_id"),
        status.alias("status"),
        (~F.col("b.claim_text").eqNullSafe(F.col("a.claim_text"))).alias("claim_text_changed"),
        tx.set_diff("b.citation_keys", "a.citation_keys").alias("citations"),
        (~F.col("b.evidence_basis").eqNullSafe(F.col("a.evidence_basis"))).alias("evidence_basis_changed"),
        F.filter(parts, lambda p: ~p["before"].eqNullSafe(p["after"])).alias("components"),
        change("trust.overall_score").alias("overall"),
        change("trust.trust_label").alias("label"),
        tx.set_diff("b.human_decision_references", "a.human_decision_references").alias("decisions"),
    )
    return told.orderBy("comparison_id")


def anchor_changes(before: DataFrame, after: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(anchor_id, status)``: current, remapped, orphaned or added; a selector changed without succession raises."""
    old = before.select("anchor_id", F.col("selector").alias("b"))
    new = after.select("anchor_id", F.col("selector").alias("a"))
    rows = old.join(new, "anchor_id", "full").join(pairs.select(F.col("old_id").alias("_old"), "new_id"), (F.col("b.kind") == "claim") & (F.col("b.claim_id") == F.col("_old")), "left")
    moved = (F.col("a.kind") == "claim") & (F.col("new_id") == F.col("a.claim_id"))
    status = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "orphaned").when(F.col("b").eqNullSafe(F.col("a")), "current").when(moved, "remapped").otherwise("retargeted")
    told = rows.select("anchor_id", status.alias("status"))
    must_hold([Check("anchor keeps its target", told, F.col("status") != "retargeted", F.col("anchor_id"))])
    return told.orderBy("anchor_id")


def summary(compared: DataFrame, anchors: DataFrame) -> dict:
    """Counts for each status, zeros included, and of changes where both versions have the claim."""
    both = ~F.col("status").isin("added", "removed")
    row = compared.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.count_if(both & F.col("overall").isNotNull()).alias("trust_overall_changed"),
        F.count_if(~both).alias("trust_overall_added_or_removed"),
        F.count_if(both & F.col("evidence_basis_changed")).alias("evidence_basis_changed"),
        F.coalesce(F.sum(F.size("decisions.added")), F.lit(0)).alias("human_decision_references_added"),
    ).first()
    return row.asDict() | {"orphaned_anchors": anchors.where("status = 'orphaned'").count()}


def status_counts(compared: DataFrame) -> DataFrame:
    return fill_dimension(compared.groupBy("status").agg(F.count("*").alias("n")), "status", STATUSES, ["n"])


def newer(before_version: str, after_version: str) -> None:
    key = lambda v: tuple(int(x) for x in v.split("."))
    if not key(before_version) < key(after_version):
        raise ValueError("the second version must be newer")
