"""Releases: manifests, provenance markers, capsules, bundles, and the projections shown beside claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import values as vl
from claimloom.operators.relational import has_repeats
from claimloom.plans.checks import Check, Rejected
from claimloom.plans.versions import SHA256, STATUSES
from claimloom.sources.schemas import PASSAGE
from claimloom.sources.sinks import ROLE_TYPES, STATUS_IRIS
from claimloom.sources.sinks import canonical_digest

REQUIRED_ROLES = ["html_bundle", "claim_graph", "trust_report", "provenance"]
#: Forms of versions and ids in release records.
VERSION = r"^(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)$"
RELEASE = "struct<review_id:string,release_id:string,version:string,manifest_sha256:string,frozen_at:string>"
MANIFEST = "release_id string, released_at string, generated_at string, artifacts array<struct<role:string,path:string,media_type:string,bytes:bigint,sha256:string>>, gates array<struct<gate_id:string,status:string>>, accepted_submissions array<struct<submission_id:string,revision:int,sha256:string>>"
CAPSULE = f"capsule_id string, release {RELEASE}, created_at string, status string, license string, execution struct<command:array<string>,started_at:string,completed_at:string,exit_code:int>, artifacts array<struct<path:string,role:string,media_type:string,expected_sha256:string>>"


def release_ref(r: Column) -> Column:
    return (
        r["review_id"].rlike("^review-[a-z0-9][a-z0-9-]{2,63}$") & r["release_id"].rlike("^release-[a-z0-9][a-z0-9-]{7,95}$") & r["version"].rlike(VERSION)
        & r["manifest_sha256"].rlike(SHA256) & vl.moment(r["frozen_at"]).isNotNull()
    )


def manifest_checks(manifests: DataFrame) -> list[Check]:
    key = F.col("release_id")
    pairs = F.transform("accepted_submissions", lambda s: F.concat_ws("@", s["submission_id"], s["revision"].cast("string")))
    return [
        Check("required roles", manifests, F.size(F.array_except(F.array(*map(F.lit, REQUIRED_ROLES)), "artifacts.role")) == 0, key),
        Check("artifact paths are unique", manifests, ~has_repeats("artifacts.path"), key),
        Check("accepted revisions are unique", manifests, ~has_repeats(pairs), key),
        Check("generated before release", manifests, vl.moment(F.col("generated_at")) <= vl.moment(F.col("released_at")), key),
        Check("gates passed", manifests, F.forall("gates", lambda g: g["status"] == "passed"), key),
        Check("artifact digests", manifests, F.forall("artifacts", lambda a: a["sha256"].rlike(SHA256) & (a["bytes"] >= 0)), key),
    ]


def submission_references(manifests: DataFrame, submissions: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Accepted submissions that a release names but that aren't there in that revision and with that digest.

    Submissions have (submission_id, revision, sha256); with ``columns`` the digest is that of each one's own canonical document
    of these columns, in their order, whatever digest is stored.
    """
    there = canonical_digest(submissions.drop("sha256"), columns, "sha256") if columns else submissions
    named = manifests.select("release_id", F.explode("accepted_submissions").alias("s")).select("release_id", "s.*")
    return named.join(there.select("submission_id", "revision", "sha256"), ["submission_id", "revision", "sha256"], "left_anti")


def provenance_checks(rows: DataFrame, must_be_false: list[str], decisions: dict[str, tuple[str, str]], key: Column) -> list[Check]:
    """Provenance markers: an HTTPS repository, versions named, flags off, and decisions still in their status.

    ``decisions`` maps a column to (decision id, status); columns are structs of ``decision_id`` and ``status``.
    """
    checks = [
        Check("originating repository", rows, F.col("originating_repository").startswith("https://"), key),
        Check("versions named", rows, (F.length("rubric_version") > 0) & (F.length("method_version") > 0), key),
    ]
    checks += [Check(f"{flag} is off", rows, ~F.col(flag), key) for flag in must_be_false]
    return checks + [Check(f"{name} is {status}", rows, (F.col(f"{name}.decision_id") == decision) & (F.col(f"{name}.status") == status), key) for name, (decision, status) in decisions.items()]


def capsule_checks(capsules: DataFrame) -> list[Check]:
    key, e = F.col("capsule_id"), F.col("execution")
    order = vl.in_order(vl.moment(e["started_at"]), vl.moment(e["completed_at"]), vl.moment(F.col("created_at")), vl.moment(F.col("release.frozen_at")))
    code = vl.ladder([(F.col("status") == "passed", e["exit_code"] == 0), (F.col("status") == "failed", e["exit_code"] != 0)], F.lit(True))
    sound = F.forall("artifacts", lambda a: a["role"].isin(list(ROLE_TYPES)) & (a["path"] != "") & F.contains(a["media_type"], F.lit("/")) & a["expected_sha256"].rlike(SHA256))
    return [
        Check("capsule id", capsules, key.rlike("^capsule-[a-z0-9][a-z0-9-]{7,95}$"), key),
        Check("release", capsules, release_ref(F.col("release")), key),
        Check("times in order", capsules, order, key),
        Check("license", capsules, F.col("license").startswith("https://"), key),
        Check("status", capsules, F.col("status").isin(list(STATUS_IRIS)), key),
        Check("command", capsules, (F.size(e["command"]) > 0) & F.forall(e["command"], lambda c: c != ""), key),
        Check("exit code suits the status", capsules, code, key),
        Check("artifacts", capsules, sound & ~has_repeats("artifacts.path"), key),
        Check("all roles", capsules, F.size(F.array_except(F.array(*map(F.lit, ROLE_TYPES)), "artifacts.role")) == 0, key),
    ]


def diff_checks(compared: DataFrame, anchors: DataFrame) -> list[Check]:
    """Post-conditions of a version diff."""
    return [
        Check("comparison is unique", compared.groupBy("comparison_id").count(), F.col("count") == 1, F.col("comparison_id")),
        Check("status", compared, F.col("status").isin(STATUSES), F.col("comparison_id")),
        Check("anchor is unique", anchors.groupBy("anchor_id").count(), F.col("count") == 1, F.col("anchor_id")),
        Check("anchor status", anchors, F.col("status").isin("current", "remapped", "orphaned", "added"), F.col("anchor_id")),
        Check("added and removed have one side", compared, (F.col("status") != "added") | F.col("comparison_id").startswith("none--"), F.col("comparison_id")),
    ]


def bundle_problems(index: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts of a bundle (role, release) that name another release than its index (release); both ways a missing one counts."""
    wanted = index.select(F.col("release").alias("_release")).distinct().limit(2).collect()
    if len(wanted) != 1:
        raise Rejected("an index names exactly one release")
    named = index.select(F.col("release").alias("_release")).limit(1)  # all rows agree
    return parts.crossJoin(F.broadcast(named)).where(~F.col("release").eqNullSafe(F.col("_release"))).select("role")


def committed_gate(gate: dict, counts: dict[str, int]) -> list[str]:
    """Why a committed gate can't stand: status, failures, a check that isn't true, counts that differ."""
    out = [] if gate.get("status") in ("pass", "passed") and not gate.get("failures") else ["not passing"]
    out += [f"check {k}" for k, v in gate.get("checks", {}).items() if v is not True]
    return out + [f"count {k}" for k, v in counts.items() if gate.get("counts", {}).get(k) != v]


def evidence_counts(claims: DataFrame) -> dict[str, int]:
    """Claims, contexts and verified passages, as a gate states them."""
    contexts = F.coalesce(F.size("citation_contexts"), F.lit(0))
    verified = F.aggregate("citation_contexts", F.lit(0), lambda n, c: n + F.size(F.filter(c["passages"], lambda p: F.coalesce(p["verification_status"] == "verified", F.lit(False)))))
    row = claims.agg(F.count("*").alias("claims"), F.coalesce(F.sum(F.greatest(contexts, F.lit(0))), F.lit(0)).alias("citation_contexts"), F.coalesce(F.sum(verified), F.lit(0)).alias("verified_passages")).first()
    return {k: int(v) for k, v in row.asDict().items()}


def shown_passages(context: Column, legacy: Column) -> Column:
    """A context's passages, else its legacy passage as one of its own, else none."""
    own = F.coalesce(context["passages"], F.array().cast(f"array<{PASSAGE}>"))
    empty = F.lit(None).cast("string")
    old = F.struct(legacy.alias("text"), F.lit("unknown").alias("passage_source"), F.lit("unknown").alias("locator"), F.lit("legacy").alias("verification_status"), empty.alias("verification_source"), empty.alias("verified_at"), F.coalesce(context["supports_claim_atoms"], F.array().cast("array<string>")).alias("supports_claim_atoms"))
    return F.when(F.size(own) > 0, own).when(F.coalesce(legacy, F.lit("")) != "", F.array(old)).otherwise(F.array().cast(f"array<{PASSAGE}>"))


def references(claims: DataFrame) -> DataFrame:
    """(claim_id, ord, cite_key, doi) of contexts, or of the bare keys where there are no contexts."""
    pair = lambda k, d: F.struct(k.alias("cite_key"), d.alias("doi"))
    listed = F.when(F.size(F.coalesce("citation_contexts.cite_key", F.array().cast("array<string>"))) > 0, F.transform("citation_contexts", lambda c: pair(c["cite_key"], c["doi"]))).otherwise(F.transform("citation_keys", lambda k: pair(k, F.lit(None).cast("string"))))
    return claims.select("claim_id", F.posexplode(listed).alias("ord", "r")).select("claim_id", "ord", "r.*")


def blinded(figures: DataFrame) -> DataFrame:
    """Comparisons without the columns that tell an auditor what is expected."""
    return figures.drop("comparison_name", "what_it_reveals")


def condensed(findings: DataFrame, k: int = 10) -> DataFrame:
    """Of each cluster at most k replicated and k contested findings; the limit is the feature."""
    from claimloom.plans.evidence import replication
    from claimloom.plans.manuscript import top_by

    rows = findings.withColumn("replication", replication(F.col("replication_status"))).where(F.col("replication").isin("replicated", "contested"))
    return top_by(rows, ["cluster", "replication"], "citation_count", "cite_key", k)
