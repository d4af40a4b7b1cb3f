"""Token counts through a digest cache.

Digests of normalised content and of the tokenizer's version make the cache key. Normalised
is white space (ASCII runs made one space, ends trimmed) only for a tokenizer that drops it,
whose counts can't change by that; for all others the raw text is digested. Keys already
stored cost a join of 32-byte digests; only distinct misses are encoded and appended. Where
the cache holds anything, texts are picked by the misses before any text is shuffled: by a
broadcast of them up to ``BROADCAST_DIGESTS``, beyond it by a join. Copies are combined on the
map side, so a text that a third of all rows share is moved once for each task and encoded once.

Defined results: null text counts as empty (0 tokens, 0 bytes); very long texts are encoded
whole, one to a block; empty table, empty result; repeated rows each get a row, null or
repeated ids too; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import map_blocks, stored

#: Digests (32 bytes each) that may be broadcast to pick texts.
BROADCAST_DIGESTS = 1_000_000
#: Words whose ids a worker remembers; idle workers hold them too.
REMEMBERED = 150_000
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + b"\0" + f.read()).hexdigest()[:32]


def content_digest(text: Column, drops_space: bool) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.trim(F.regexp_replace(whole, r"[ \t\n\x0B\f\r]+", " ")) if drops_space else whole, 256))


def _cache(spark, path: str) -> DataFrame:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(CACHE_SCHEMA).parquet(path) if there else spark.createDataFrame([], CACHE_SCHEMA)


def unseen(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose digest the cache hasn't got. An empty cache has none, so nothing is asked of it."""
    if not known.head(1):
        return rows
    wanted = stored(rows.select("digest").distinct().join(known, "digest", "left_anti"), "misses")
    return rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_DIGESTS else wanted, "digest", "left_semi")


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for every row; misses are appended to the Parquet table ``cache_path``.

    ``tokenizer`` is the path of a tokenizer file, the same on all machines.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    digest = content_digest(F.col("text"), bpe.load(tokenizer).by_word)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", digest)
    misses = unseen(rows, _cache(spark, cache_path).where(F.col("tokenizer") == version).select("digest")).groupBy("digest").agg(F.first("text").alias("text"))

    def count(block: pa.Table) -> pa.Table:
        return pa.table({"tokenizer": pa.array([version] * len(block)), "digest": block["digest"], "n_tokens": pa.array(bpe.load(tokenizer, REMEMBERED).counts(block["text"]).astype("int64"))})

    map_blocks(misses, count, CACHE_SCHEMA, limit=3 << 20).write.mode("append").parquet(cache_path)
    # two writers at once may both have stored a digest; as a table of its own, so that the join below can split a hot digest
    counts = stored(_cache(spark, cache_path).where(F.col("tokenizer") == version).dropDuplicates(["digest"]).select("digest", "n_tokens"), "counts")
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest").join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
