"""Hourly panes with revisions: a stateful stream that publishes a pane's totals, corrects them, and forgets the pane.

Method: ``transformWithStateInPandas`` keyed by (kind, hour). A ValueState holds a pane's current and published totals; one
event-time timer, at the end of the grace time, publishes it, another closes and forgets it. Rows of published panes retract
the old totals and publish new ones. Rows of closed panes don't reach the state: they go straight from the source to the
output, row by row and in parallel. The last batch has a sentinel row for each pane that isn't due in it (a distinct over panes,
beside the rows), which publishes the pane as final.

The rows are written once, by batch, below ``spark.checkpoint.dir``; a batch's folder is moved to the stream's input before
the query is started for it, on one checkpoint. Within each input split rows are summed by pane before they are shuffled
(``partial``), so a pane costs its task one row a split, however many rows it has. A task that runs again, or a start that
failed midway, reads the same files and state and writes the same rows (the file sink commits each batch once).

The driver gets one number for each batch: its maximal event time, of which it makes the bound that tells rows of closed
panes; the timers go by Spark's own watermark, which is the same maximum in milliseconds (panes end at whole hours). Spark's
watermark begins at 0 where the contract's begins at minus infinity; so the stream's clock is ``SHIFT_MS`` ahead.

Edges: rows without ``ts`` are dropped. Of rows with one ``click_id`` the least by (ts, arrived_at, kind, value), nulls first,
counts; a row without ``click_id`` is known by these four, so only its exact repeats are left out. Without ``arrived_at`` a row
arrived at ``ts``. A null ``kind`` is ``none``; a null, infinite or NaN ``value`` is 0 cents. Extra columns are ignored. An empty
table, and an empty batch, runs the query for each batch all the same. Timestamps with a zone are read in the session's zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .common import scratch_path

HOUR_MS = 3_600_000
#: What the stream's clock is ahead of the events' (over 30,000 years: every timestamp of Spark stays above 0).
SHIFT_MS = 1_000_000_000_000_000
#: Event time, in shifted milliseconds, of rows that aren't clicks: those that only keep batches from being empty, and sentinels.
TICK_MS = 0
BATCH = "batch int, kind string, hour bigint, click_id bigint, cents bigint, event_us bigint"
OUT = "batch bigint, record string, kind string, hour bigint, click_id bigint, n_rows bigint, cents bigint"
COLUMNS = [c.split()[0] for c in OUT.split(", ")]
_STORE = "spark.sql.streaming.stateStore"
#: The state is kept by RocksDB as a log of changes; no file is allocated ahead of what it holds, and parts that another start
#: has taken over are soon closed.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    f"{_STORE}.maintenanceInterval": "15s",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def micros(at: str) -> Column:
    """A timestamp's wall clock as microseconds since 1970, whatever the session's zone where it has none itself."""
    seconds = F.unix_date(F.col(at).cast("date")).cast("bigint") * 86400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.expr(f"extract(second from {at})") * 1_000_000).cast("bigint")


def clicks_by_batch(clicks: DataFrame, n: int) -> DataFrame:
    """Each click once, as ``BATCH``: its batch, pane, cents and event time."""
    rows = clicks.where("ts is not null").select("click_id", F.struct("ts", F.coalesce("arrived_at", "ts").alias("arrived_at"), F.col("kind").cast("string").alias("kind"), F.col("value").cast("double").alias("value")).alias("row"))
    # rows without an id are told apart by what they hold
    whole = F.when(F.col("click_id").isNull(), F.col("row"))
    once = rows.groupBy("click_id", whole.alias("whole")).agg(F.min("row").alias("row")).select("click_id", "row.*")
    day = F.unix_date(F.col("arrived_at").cast("date")).cast("bigint")
    placed = once.select("*", day.alias("day"), F.pmod(day, F.lit(n)).alias("q"), micros("ts").alias("ts_us"))
    delay = F.greatest(F.lit(0), F.crc32(F.coalesce(F.col("click_id").cast("string"), F.lit("")).cast("binary")) % 30 - 23)
    usable = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < 9e15)
    return placed.withColumn("event_us", F.col("ts_us") - (F.col("day") - F.col("q")) * 86_400_000_000).select(
        F.least(F.lit(n - 1), F.col("q") + delay).cast("int").alias("batch"),
        F.coalesce("kind", F.lit("none")).alias("kind"),
        F.expr(f"event_us div {1000 * HOUR_MS} - if(event_us % {1000 * HOUR_MS} < 0, 1, 0)").alias("hour"),
        "click_id",
        F.when(usable, F.floor(100 * F.col("value") + 0.5)).otherwise(F.lit(0)).cast("bigint").alias("cents"),
        "event_us",
    )


def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pane of an input split; ticks, which have no pane, end here. A row without cents is a sentinel."""
    sums: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        rows = pa.Table.from_batches([batch]).filter(pc.is_valid(batch["hour"]))
        rows = rows.append_column("last", pc.cast(pc.is_null(rows["cents"]), pa.int64()))
        found = rows.group_by(["kind", "hour"]).aggregate([("cents", "count"), ("cents", "sum"), ("last", "sum")])
        for kind, hour, *more in zip(*(found[c].to_pylist() for c in ("kind", "hour", "cents_count", "cents_sum", "last_sum"))):
            held = sums.setdefault((kind, hour), [0, 0, 0])
            for k, x in enumerate(more):
                held[k] += x or 0
    if sums:
        kinds, hours = zip(*sums)
        whole = [pa.array(x, pa.int64()) for x in zip(*sums.values())]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(hours, pa.int64()), *whole], ["kind", "hour", "n_rows", "cents", "last"])


class Pane(StatefulProcessor):
    """One (kind, hour): its totals so far, and those that the output shows."""

    def __init__(self, batch: int, grace_ms: int, close_ms: int):
        self.batch, self.grace_ms, self.close_ms = batch, grace_ms, close_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n_rows bigint, cents bigint, shown boolean, shown_rows bigint, shown_cents bigint")

    def _end(self, key) -> int:
        return SHIFT_MS + (key[1] + 1) * HOUR_MS

    def _rows(self, key, *records) -> pd.DataFrame:
        return pd.DataFrame([(self.batch, record, key[0], key[1], -1, n, cents) for record, n, cents in records], columns=COLUMNS)

    def handleInputRows(self, key, rows, timerValues):
        n = cents = last = 0
        for part in rows:
            n, cents, last = (x + int(part[c].sum()) for x, c in ((n, "n_rows"), (cents, "cents"), (last, "last")))
        held = self.totals.get()
        if last:  # not due, so never shown
            yield self._rows(key, ("final", n + (held[0] if held else 0), cents + (held[1] if held else 0)))
            self.totals.clear()
        elif held is None:
            # a timer fires once the watermark is at it
            self.handle.registerTimer(self._end(key) + self.grace_ms)
            self.handle.registerTimer(self._end(key) + self.close_ms)
            self.totals.update((n, cents, False, 0, 0))
        else:
            old_n, old_cents, shown, shown_n, shown_cents = held
            n, cents = old_n + n, old_cents + cents
            self.totals.update((n, cents, shown, n if shown else 0, cents if shown else 0))
            if shown:
                yield self._rows(key, ("retract", shown_n, shown_cents), ("replace", n, cents))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.totals.get()
        if held is None:
            return
        n, cents, shown, _, _ = held
        if not shown:
            yield self._rows(key, ("emit", n, cents))
            self.totals.update((n, cents, True, n, cents))
        if expiredTimerInfo.getExpiryTimeInMs() >= self._end(key) + self.close_ms:
            self.totals.clear()

    def close(self) -> None:
        pass


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _start(spark: SparkSession, feed: str, out: str, state: str, batch: int, bound_us: int | None, grace_ms: int, close_ms: int) -> None:
    """Run the query for the batch that lies in ``feed`` as its newest folder, on the state of the batches before."""
    source = spark.readStream.schema(BATCH).parquet(feed)
    closed = F.lit(False) if bound_us is None else F.coalesce((F.col("hour") + 1) * (1000 * HOUR_MS) + close_ms * 1000 <= F.lit(bound_us), F.lit(False))
    late = source.where(closed).select(F.col("batch").cast("bigint").alias("batch"), F.lit("late").alias("record"), "kind", "hour", "click_id", F.lit(1).cast("bigint").alias("n_rows"), "cents")
    timed = source.withColumn("event", F.timestamp_micros(F.col("event_us") + SHIFT_MS * 1000)).withWatermark("event", "0 seconds")
    summed = timed.where(~closed).select("kind", "hour", "cents").mapInArrow(partial, "kind string, hour bigint, n_rows bigint, cents bigint, last bigint")
    panes = summed.groupBy("kind", "hour").transformWithStateInPandas(Pane(batch, grace_ms, close_ms), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    query = panes.unionByName(late).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def revisions(batches: DataFrame, n: int, grace_ms: int = 6 * HOUR_MS, close_ms: int = 96 * HOUR_MS) -> DataFrame:
    """All records (``OUT``) of ``n`` batches of rows (``BATCH``), fed in order to a query that is started anew for each.

    Each call uses folders of its own below the shared folder. Grace and close times are counted from a pane's end.
    """
    spark = batches.sparkSession
    rows, feed, out, state = (scratch_path(spark, f"panes-{x}") for x in ("rows", "feed", "out", "state"))
    beside = lambda df: df.select(*[(F.col(c) if c in df.columns else F.lit((TICK_MS - SHIFT_MS) * 1000) if c == "event_us" else F.lit(None)).cast(kind).alias(c) for c, kind in (x.split() for x in BATCH.split(", "))])
    batches.unionByName(beside(spark.range(n).withColumnRenamed("id", "batch"))).write.partitionBy("batch").parquet(rows)
    clicks = spark.read.schema(BATCH).parquet(rows).where("hour is not null")
    newest = dict(clicks.groupBy("batch").agg(F.max("event_us").alias("event_us")).collect())  # n rows
    bounds = [max((newest[b] for b in range(k) if b in newest), default=None) for k in range(n)]
    undue = F.lit(True) if bounds[-1] is None else (F.col("hour") + 1) * (1000 * HOUR_MS) + grace_ms * 1000 > F.lit(bounds[-1])
    beside(clicks.where(undue).select(F.lit(n - 1).alias("batch"), "kind", "hour").distinct()).write.mode("append").partitionBy("batch").parquet(rows)
    before = {k: spark.conf.get(k, None) for k in STATE}
    _files(spark, feed)[1].mkdirs(_files(spark, feed)[0])
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        for batch, bound in enumerate(bounds):
            moved, system = _files(spark, f"{rows}/batch={batch}")
            if not system.rename(moved, _files(spark, f"{feed}/batch={batch}")[0]):
                raise RuntimeError(f"{rows}/batch={batch} can't be moved to {feed}")
            _start(spark, feed, out, state, batch, bound, grace_ms, close_ms)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(OUT).parquet(out)


def click_panes(clicks: DataFrame, n: int = 8) -> DataFrame:
    """The records of all ``clicks``, cut into ``n`` batches by arrival day and checksum."""
    return revisions(clicks_by_batch(clicks, n), n).select("batch", "hour", "click_id", "n_rows", "cents", "record", "kind")
