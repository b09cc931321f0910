"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_root, shuffle_partitions

__all__ = ["among", "delete", "documents", "few", "map_rows", "new_folder", "passing", "scratch_root", "shuffle_partitions", "store"]

#: Rows, and bytes, of one Arrow batch: whole texts are long, and a batch stands in the JVM and in the worker at once.
BATCH_ROWS, BATCH_BYTES = 2000, 8_000_000
_BATCH = "spark.sql.execution.arrow.max{}PerBatch"
#: Ids (8 bytes each) that are sent to all tasks at most; more are joined by a shuffle.
SENT_IDS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` in bounded batches.  Sets the limits for the session; a smaller one that it already has stays."""
    conf = df.sparkSession.conf
    rows = int(conf.get(_BATCH.format("Records")))
    if not 0 < rows <= BATCH_ROWS:
        conf.set(_BATCH.format("Records"), BATCH_ROWS)
        conf.set(_BATCH.format("Bytes"), BATCH_BYTES)
    return df.mapInArrow(run, schema)


def few(ids: DataFrame) -> bool:
    """Whether the rows of a stored table of ids may be sent to all tasks."""
    return ids.count() <= SENT_IDS


def among(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``rows`` before a join that needs only those whose ``column`` is in ``ids`` (stored, of that one column): the others are left out before
    they are shuffled, so long as the ids are few.  Beyond that all rows go into the join."""
    return rows.join(F.broadcast(ids.distinct()), column, "left_semi") if few(ids) else rows


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_scopes: list[list[str]] = []


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stored inside are deleted at the end; the function it gives stores one that stays.  What is returned must read no other."""
    own: list[str] = []
    _scopes.append(own)

    def keep(df: DataFrame, name: str) -> DataFrame:
        _scopes.pop()
        try:
            return store(df, name)
        finally:
            _scopes.append(own)

    try:
        yield keep
    finally:
        _scopes.remove(own)
        for path in own:
            delete(spark, path)
