"""Shared plumbing of the training-data operators: bounded Arrow batches, parts that follow the input's size, row numbers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.sources.scratch import drop_stored, scratch_path, scratch_root, stored  # noqa: F401

#: Text gathered before one vectorised step in a Python worker.
BLOCK_BYTES = 8 << 20
#: Bits of a row number that tell a file's rows apart; the others tell files apart.
ROW_BITS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reclaim(df: DataFrame) -> None:
    """Have Spark's cleaner remove the shuffle files of finished steps, which else stay until the driver's next full collection."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the largest table that ``df`` reads; rows that come from elsewhere, whose size Spark doesn't know, are measured."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)
    if size < 1 << 60:
        return size
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind in ("string", "binary")]
    return int(df.agg(F.sum(sum((F.coalesce(x, F.lit(0)) for x in texts), F.lit(8 * len(df.columns))).cast("bigint"))).first()[0] or 0)


def input_parts(df: DataFrame, mb_each: int = 8) -> int:
    """How many parts hold about ``mb_each`` MB of the stored input each; it grows with the input, without an end."""
    return max(8, -(-input_bytes(df) // (mb_each << 20)))


def scanned(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` if it reads files, whose rows come in one order whenever a lost task runs again; else a stored copy."""
    try:
        docs.select("_metadata.file_path")
        return docs
    except AnalysisException:
        return stored(docs, name)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number of its own for each row in column ``name``, the same in every scan.

    It is made of the row's place in its Parquet file and the file's place among the files, so rows with null or repeated ids,
    and repeated rows, are told apart without a hash. What isn't a plain Parquet scan is stored first.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        kept = stored(docs, "numbered")
        placed = kept.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_index"))
    # one row a file; as a table, so that each scan sees the same numbers
    files = stored(placed.select("_path").distinct().withColumn("_file", F.row_number().over(Window.orderBy("_path")).cast("bigint")), "files")
    number = F.shiftleft("_file", ROW_BITS) + F.col("_index")
    return placed.join(F.broadcast(files) if files.count() <= 1_000_000 else files, "_path").withColumn(name, number).drop("_path", "_file", "_index")


def doc_fold(modulus: int, column: str = "doc_id"):
    """crc32 of the decimal text of the id, modulo ``modulus``; null ids go to the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def release() -> None:
    """Give a Python worker's freed memory back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    gc.collect(0)
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Join small Arrow batches, and cut large ones, into tables of about ``limit`` bytes of ``column``.

    A single text longer than the limit makes a block of its own; texts are never cut.
    """
    pa.set_memory_pool(pa.system_memory_pool())  # whose freed memory release() can give back
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column_bytes = batch.column(batch.schema.get_field_index(column)).nbytes
        step = max(1, int(batch.num_rows * limit / max(column_bytes, 1)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            size += part.column(part.schema.get_field_index(column)).nbytes
            held.append(part)
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def map_blocks(df: DataFrame, make: Callable[[pa.Table], pa.Table | pa.RecordBatch | None], schema: str, column: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """``mapInArrow`` over blocks of bounded bytes.

    Arrow batches are kept small, since texts may be long: Spark reads their bounds from the session when a plan runs, so
    these two settings of the session stay as this sets them.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)

    def run(batches):
        for block in blocks(batches, column, limit):
            out = make(block)
            if out is None:
                continue
            yield from out.to_batches(max_chunksize=4096) if isinstance(out, pa.Table) else [out]
            del out, block
            release()

    return df.mapInArrow(run, schema)
