"""Files as rows: digests, bounded reads, signatures."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file up to which it is read as one value, of which a task holds some copies; Spark can't at all from 2 GB on.
WHOLE = 256 << 20
#: Names of files that Spark's text reader would decompress.
CODED = r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd)$"
#: The mark that the text reader leaves out where a file begins with it.
MARK = b"\xef\xbb\xbf"


def binary(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return spark.read.format("binaryFile").load(paths)


def _streamed(above: int) -> Column:
    """By what Spark knows of a file before it is opened, so that files are left out by it and not read first."""
    return (F.col("_metadata.file_size") > above) & ~F.lower("_metadata.file_path").rlike(CODED)


def _digest(path: str, size: int):
    """The digest of one file from all its lines (start of their split, line) in order, which are in memory a batch at a time.

    Each line is taken to end with a line feed. The last one is none of the file's if that makes a byte too many, and a mark was left
    out if three are missing; any other count raises, and so do splits out of order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, at, last = (hashlib.sha256(), hashlib.sha256(MARK)), 0, 0, b""
        for batch in batches:
            starts, lines = (batch.column(batch.schema.get_field_index(c)) for c in ("start", "line"))
            order = np.concatenate([[at], starts.to_numpy()])
            if (np.diff(order) < 0).any():
                raise ValueError(f"{path}: splits are out of order")
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), b"\n")[0].as_buffer()
            for h in hashes:
                h.update(last)
                h.update(joined)
            at, last, seen = order[-1], b"\n", seen + joined.size + 1
        marked = seen - size in (-3, -2)
        over = seen - size + 3 * marked
        if over not in (0, 1):
            raise ValueError(f"{path}: {seen} of {size} bytes were read")
        hashes[marked].update(last[over:])
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([hashes[marked].hexdigest()])], ["path", "bytes", "sha256"])

    return run


def streamed_digests(spark: SparkSession, paths: list[str] | str, above: int = WHOLE) -> DataFrame | None:
    """``(path, bytes, sha256)`` of the files of more than ``above`` bytes, of any size, but for those that the text reader would decompress; None if there are none.

    A digest is a chain over a file's bytes, so one task a file reads its splits one after the other and keeps none. They are read as lines
    without a decoding: between line feeds the reader hands on the bytes as they are. A line of 2 GB is an error.
    """
    found = binary(spark, paths).where(_streamed(above)).select("path", "length", F.col("_metadata.file_path").alias("at")).collect()
    lines = spark.read.text(paths, lineSep="\n")
    of = lambda f: lines.where(F.col("_metadata.file_path") == f.at).select(F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    digests = [of(f).coalesce(1).mapInArrow(_digest(f.path, f.length), "path string, bytes bigint, sha256 string") for f in found]
    return reduce(DataFrame.unionByName, digests) if digests else None


def digest_index(spark: SparkSession, paths: list[str] | str, whole: int = WHOLE) -> DataFrame:
    """``(name, bytes, sha256)`` of each file; a file below one of the paths is named from that path's last part on.

    Files of more than ``whole`` bytes are streamed (:func:`streamed_digests`).
    """
    rows = binary(spark, paths)
    kept = rows.where(~_streamed(whole)).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    if (more := streamed_digests(spark, paths, whole)) is not None:
        kept = kept.unionByName(more)
    given = "|".join(re.escape(p.rstrip("/").rsplit("/", 1)[-1]) for p in ([paths] if isinstance(paths, str) else paths))
    below = F.nullif(F.regexp_extract("path", f"(?:^|/)((?:{given})/.*)$", 1), F.lit(""))
    return kept.select(F.coalesce(below, F.element_at(F.split("path", "/"), -1)).alias("name"), "bytes", "sha256")
