"""Human submissions: chronology, acceptance and their pairing with exact targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators.anchors import anchored_quotes
from claimloom.plans.checks import Check


#: The last events that suit each moderation state.
FINAL_EVENTS = {"submitted": ["submitted"], "screening": ["screening_started"], "quarantined": ["quarantined"], "admitted": ["admitted", "revision_requested"], "accepted": ["accepted", "corrected"], "rejected": ["rejected"], "withdrawn": ["withdrawn"]}


def events(submissions: DataFrame) -> DataFrame:
    """Moderation events with each one's predecessor; unparsable times are passed over."""
    rows = submissions.select("submission_id", "revision", "created_at", F.col("moderation.state").alias("state"), F.posexplode("moderation.events").alias("ord", "e")).select("*", vl.strict_moment(F.col("e.at")).alias("at"))
    earlier = F.max("at").over(Window.partitionBy("submission_id", "revision").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("latest_before", F.greatest(vl.strict_moment(F.col("created_at")), earlier))


def checks(submissions: DataFrame) -> list[Check]:
    key = F.concat_ws("@", "submission_id", F.col("revision").cast("string"))
    last = F.try_element_at("moderation.events", F.lit(-1))["event"]
    suits = F.lit(False)
    for state, finals in FINAL_EVENTS.items():
        suits = suits | ((F.col("moderation.state") == state) & last.isin(finals))
    was_accepted = (F.col("moderation.state") != "accepted") | F.exists("moderation.events", lambda e: F.coalesce(e["event"] == "accepted", F.lit(False)))
    return [
        Check("events in order", events(submissions), F.col("at") >= F.col("latest_before"), key),
        Check("first event", submissions, F.try_element_at("moderation.events", F.lit(1))["event"] == "submitted", key),
        Check("state follows the last event", submissions, suits, key),
        Check("accepted state has its event", submissions, was_accepted, key),
        Check("received after creation", submissions, vl.strict_moment(F.col("received_at")) >= vl.strict_moment(F.col("created_at")), key),
        Check("revision key is unique", submissions.groupBy("submission_id", "revision").count(), F.col("count") == 1, key),
        Check("revision", submissions, F.col("revision") >= 1, key),
    ]


def accepted(submissions: DataFrame) -> DataFrame:
    """State and an acceptance not before creation."""
    created = vl.strict_moment(F.col("created_at"))
    took = F.exists("moderation.events", lambda e: F.coalesce((e["event"] == "accepted") & (vl.strict_moment(e["at"]) >= created), F.lit(False)))
    return submissions.where((F.col("moderation.state") == "accepted") & (F.col("revision") >= 1) & took)


def paired(submissions: DataFrame, review_version: str, manifest_sha256: str, claims: DataFrame, sources: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Accepted submissions of exactly this release with ``anchor_status``.

    ``claims`` has claim_id, ``sources`` (source_path, source_sha256, text); ``only`` may list submission ids.
    A claim target is an equi-join; a text target must have the source's digest and stand there exactly once: each source is
    normalised once, and all its quotes are looked for together.
    Stances are carried, never scored.
    """
    rows = accepted(submissions).where((F.col("target.review_version") == review_version) & (F.col("target.release_manifest_sha256") == manifest_sha256))
    if only is not None:
        rows = rows.join(only.select("submission_id"), "submission_id", "left_semi")
    s = F.col("target.selector")
    known = claims.select(F.col("claim_id").alias("_claim")).distinct()
    rows = rows.join(known, (s["kind"] == "claim") & (s["claim_id"] == F.col("_claim")), "left")
    source = lambda path, sha: F.concat(path, F.lit("\n"), sha)
    quote = F.struct(source(s["source_path"], s["source_sha256"]).alias("source"), s["exact_quote"].alias("exact"), s["prefix"].alias("prefix"), s["suffix"].alias("suffix"))
    rows = rows.withColumn("_quote", F.when(s["kind"] == "text", quote)).withColumn("_ident", F.sha2(F.to_json("_quote"), 256))
    asked = rows.where("_quote is not null").select("_quote.*", F.col("_ident").alias("ident")).dropDuplicates(["ident"])
    texts = sources.select(source(F.col("source_path"), F.col("source_sha256")).alias("source"), "text").dropDuplicates(["source"])
    places = anchored_quotes(asked, texts).where("n = 1").select(F.col("ident").alias("_ident"), F.struct("start", "end").alias("place"))
    rows = rows.join(places, "_ident", "left")
    status = vl.ladder([(s["kind"] == "review", "current"), (F.col("_claim").isNotNull(), "current"), (F.col("place.start").isNotNull(), "current")], "orphaned")
    return rows.select("submission_id", "revision", s["kind"].alias("kind"), F.col("content.stance").alias("stance"), status.alias("anchor_status"), "place.start", "place.end")


def public(rows: DataFrame) -> DataFrame:
    """Submissions as they are shown: every missing (or empty) part has its default."""
    part = lambda path, default: vl.or_default(F.col(path), default).alias(path.split(".")[-1])
    return rows.select(
        "submission_id", "revision", part("submitter.display_name", "Anonymous reviewer"), part("submitter.visibility", "pseudonymous"), F.col("target.review_version").alias("review_version"),
        F.col("moderation.state").alias("editorial_status"), part("content.kind", "comment"), part("content.title", "Human review comment"), part("content.body_markdown", ""), part("content.stance", "no_position"),
    )


def directive_checks(directives: DataFrame) -> list[Check]:
    """Directive options (file, ord, options): canonical ids, exact versions, digests, no repeated ids."""
    key, o = F.concat_ws("#", "file", F.col("ord").cast("string")), F.col("options")
    ids = tx.split_list(F.coalesce(o["submission-ids"], F.lit("")))
    return [
        Check("claim id", directives, o["claim-id"].rlike("^clm_[a-f0-9]{16}$"), key),
        Check("review version", directives, o["review-version"].rlike(r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){2}$"), key),
        Check("manifest digest", directives, o["release-manifest-sha256"].rlike("^[a-f0-9]{64}$"), key),
        Check("submission ids are unique", directives, F.size(F.array_distinct(ids)) == F.size(ids), key),
    ]


def not_rendered(requested: DataFrame, rendered: DataFrame) -> DataFrame:
    return requested.select("submission_id").distinct().join(rendered.select("submission_id"), "submission_id", "left_anti")
