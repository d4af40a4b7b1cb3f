"""A corpus in five stages: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. Within a stage every row has
a number of its own (its place in the stored table), by which operators tell rows apart and by which rows are kept or dropped:
null and repeated ids, and repeated rows, are rows like any other. Extra columns of ``docs`` don't go on, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import decontam, ngramjoin, packing, quality, secretscan
from claimloom.llm.common import numbered, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Row numbers that may be broadcast to drop rows (8 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def _rows(docs: DataFrame) -> DataFrame:
    """The documents' columns and each row's number."""
    return numbered(docs.select(*COLUMNS), "row_no")


def _as_ids(rows: DataFrame) -> DataFrame:
    """What an operator is given: row numbers in the place of ids."""
    return rows.select(F.col("row_no").alias("doc_id"), "text")


def _without(rows: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """``rows`` but those whose numbers are ``dropped``: broadcast after they were counted, so that texts needn't be shuffled."""
    dropped = stored(dropped.select(F.col("doc_id").alias("row_no")), name)
    few = dropped.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped, "row_no", "left_anti").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null, empty and blank texts are rejected. Very long texts are judged whole. Rows of one text are judged alike, unless
    labels, which go by id and reach every row of that id, differ; a row without id has no label. An empty table stays empty.
    """
    rows = _rows(docs)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").join(rows.select("doc_id", "row_no"), "doc_id")
    judged = quality.classify(_as_ids(rows), labels.withColumn("doc_id", F.col("row_no")))
    return _without(rows, judged.where("not keep"), "rejected")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays.

    It is the one with the smallest id, a row without id only where none has one; among rows of one id, the first as stored.
    Null, empty and blank texts are linked with nothing and stay. An empty table stays empty.
    """
    rows = _rows(docs)
    classes = ngramjoin.near_duplicates(_as_ids(rows)).select(F.col("doc_id").alias("row_no"), "component_id")
    classes = stored(classes.join(rows.select("row_no", "doc_id"), "row_no"), "classes")
    first = classes.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")).alias("first")).select("first.row_no")
    return _without(rows, classes.select("row_no").join(first, "row_no", "left_anti").select(F.col("row_no").alias("doc_id")), "copies")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Null, empty and wordless texts hold none and stay; very long texts are scanned whole; every row is judged by its own
    text. Without items, or with an empty table, nothing changes.
    """
    rows = _rows(docs)
    return _without(rows, decontam.find_items(_as_ids(rows), table(spark, sf_dir, "benchmark")).where("n_hit > 0"), "leaks")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the new text.

    All rows stay, in number and columns. A null text stays null, and texts without secrets, empty ones too, stay as they are,
    with their ``n_chars`` whatever it was; very long texts are searched whole. An empty table stays empty.
    """
    found = secretscan.find_secrets(docs.select(*COLUMNS), secretscan.train(docs))
    changed = F.size("secret_spans") > 0
    clean = F.when(changed, secretscan.redacted(F.col("text"), "secret_spans")).otherwise(F.col("text"))
    masked = found.select("doc_id", clean.alias("text"), "lang", "source", "n_chars", changed.alias("changed"))
    return masked.withColumn("n_chars", F.when(F.col("changed"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens.

    Every row's ids and its end id lie in pieces once: a null or empty text is the end id alone, a very long one fills several
    sequences, rows of one id are pieces of that id each. An empty table has no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: The classifier and the tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
