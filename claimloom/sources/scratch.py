"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder stands in for it in local mode alone, whose threads share the machine's files. On
    a cluster each executor would write to a disk of its own and rows would be missing without an error, so this raises.
    """
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="claimloom-")
        atexit.register(shutil.rmtree, _own_root, True)
    return f"file://{_own_root}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{scratch_root(spark)}/claimloom-{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared Parquet table and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, parts: int, name: str) -> DataFrame:
    """:func:`stored` in ``parts`` buckets by ``key``: joins and sums by it read a bucket a task and don't shuffle these rows.

    Rows that are dealt by ``key`` to as many tasks make one file a bucket; others make more files. The table stays in the session's catalog.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"claimloom_{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(parts, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/claimloom-" in folder:
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
