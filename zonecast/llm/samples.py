"""Bounded samples of labelled documents, for the models that are fitted here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose crc32(doc_id as text) mod ``FOLDS`` is 0 are never learned from.
FOLDS = 5


def held_out(key: str = "doc_id", folds: int = FOLDS):
    """Whether a row is held out; a null key is no number and never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, limit: int, column: str = "quality") -> DataFrame:
    """``text`` and ``label`` of at most ``limit`` labelled documents outside the held-out fold, those with the smallest
    hash of their id.  A document with several labels takes the smallest.  The ids are few, so the documents aren't shuffled."""
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min(column).cast("int").alias("label"))
    chosen = known.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(limit)
    rows = docs.select(F.col("doc_id").alias("own_id"), "text").join(F.broadcast(chosen), F.col("own_id") == F.col("doc_id"))
    return rows.select("doc_id", "rank", "label", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
