"""Streaming forms of the batch plans; an addition, since alerts and events are otherwise read in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.sources import schemas


def radar_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Feed records as their files arrive, each record once within the watermark; late observations are quarantined, not dropped."""
    rows = spark.readStream.schema(f"{schemas.RADAR_RECORD}, retrieved_at string").json(folder)
    timed = rows.withColumn("observed", vl.moment(F.col("observed_at"))).withColumn("retrieved", vl.moment(F.col("retrieved_at")))
    sound = F.coalesce((F.col("observed") <= F.col("retrieved")) & tx.safe_https("source.url"), F.lit(False))
    return timed.withWatermark("retrieved", "7 days").dropDuplicatesWithinWatermark(["record_id", "alert_type"]).withColumn("quarantined", ~sound)


def radar_hits(stream: DataFrame, config: DataFrame) -> DataFrame:
    """Stream of (record, claim) by DOI against the static watch list."""
    watched = config.select("claim_id", F.explode(F.transform("cited_dois", tx.radar_doi)).alias("watched"))
    named = stream.where(~F.col("quarantined")).select("record_id", "alert_type", F.explode(F.array_distinct(F.concat(F.array(tx.radar_doi("doi")), F.transform(F.coalesce("related_dois", F.array().cast("array<string>")), tx.radar_doi)))).alias("watched"))
    return named.join(watched, "watched").select("record_id", "alert_type", "claim_id", F.col("watched").alias("doi"))


def event_windows(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums of events for each window and type, closed by the watermark."""
    timed = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "event_type", "n", "total")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    timed = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.session_window("at", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("s.start", "s.end", "user_id", "n")


def chronology(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``foreachBatch``: events earlier than the latest one seen of their submission, and the new state (submission_id, latest)."""
    joined = batch.join(state, "submission_id", "left")
    early = joined.where(F.col("at") < F.col("latest")).select("submission_id", "at", "latest")
    newest = batch.groupBy("submission_id").agg(F.max("at").alias("latest"))
    merged = state.unionByName(newest).groupBy("submission_id").agg(F.max("latest").alias("latest"))
    return early, merged
