"""Stored tables: history, features, universe, reference distributions, log, reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import FEATURES, TARGET
from zonecast.operators.features import require_schema
from zonecast.operators.quality import log_entries


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> str:
    """Parquet, sorted within files so that column statistics prune by zone and hour."""
    order = [c for c in ("zone_id", "hour_ts") if c in df.columns]
    if order:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *order)
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def write_history(history: DataFrame, path: str, by_month: bool = False) -> str:
    if by_month:
        return write_table(history.withColumn("ym", F.date_format("hour_ts", "yyyy-MM")), path, "ym")
    return write_table(history, path)


def write_universe(history: DataFrame, path: str, source_name: str) -> str:
    zones = history.select("zone_id").distinct().withColumn("source", F.lit(source_name))
    return write_table(zones, path)


def write_feature_schema(spark: SparkSession, path: str) -> str:
    rows = [(i, c, "categorical" if c == "zone_id" else "numerical") for i, c in enumerate(FEATURES)]
    rows.append((len(FEATURES), TARGET, "target"))
    table = spark.createDataFrame(rows, "position int, column string, role string")
    table.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_feature_schema(spark: SparkSession, path: str) -> list[str]:
    """Stored model columns in order (nine names); raises when the code disagrees."""
    rows = spark.read.parquet(path).where(F.col("role") != "target").orderBy("position").collect()
    columns = [r["column"] for r in rows]
    require_schema(columns)
    return columns


def write_reference(root: str, bins: DataFrame, sample: DataFrame, correlation: DataFrame) -> dict[str, str]:
    """The three reference tables of one dataset."""
    out = {}
    for name, df in (("bins", bins), ("sample", sample), ("correlation", correlation)):
        out[name] = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(out[name])
    return out


def read_reference(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    root = root.rstrip("/")
    return tuple(spark.read.parquet(f"{root}/{n}") for n in ("bins", "sample", "correlation"))


def append_predictions(scored: DataFrame, path: str, created_at: datetime | None = None) -> str:
    """Appends served predictions to the log."""
    log_entries(scored.where(F.col("predicted_count").isNotNull()), created_at).write.mode("append").parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """Long-format evaluation report as JSON lines (a few dozen rows)."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def regression_fixture(test: DataFrame, n_zones: int = 20) -> DataFrame:
    """Test rows of the ``n_zones`` smallest zone ids, model columns only."""
    zones = test.select("zone_id").distinct().orderBy("zone_id").limit(n_zones)
    return test.join(F.broadcast(zones), "zone_id", "left_semi").select(*FEATURES, TARGET)
