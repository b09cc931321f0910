"""Documents to training sequences: the stages of the corpus pipeline, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import classifier, lines, neardup, packing, passages
from zonecast.llm.common import delete, new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classifier.stage),
    ("quality rules", lines.stage),
    ("near duplicates", neardup.stage),
    ("repeated passages", passages.stage),
    ("packing", packing.stage),
]

#: No stage before the last can be said in SQL; tests/llm hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)  # its only reader is written
        docs, before = spark.read.parquet(path), path
    return docs
