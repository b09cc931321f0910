"""The layered tables: staged trips as a view, hourly and dense tables and the calendar mart stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.config import DatasetConfig
from zonecast.functions.timefns import hour_floor
from zonecast.operators.contracts import (
    calendar_contract,
    contract_report,
    grid_report,
    row_violations,
    staged_trip_contract,
)
from zonecast.operators.features import add_calendar
from zonecast.operators.history import densify, hourly_demand, valid_trips
from zonecast.session import use_utc
from zonecast.sources.sinks import write_table

# Table names of the layers.
STAGED, HOURLY, DENSE, MART = "stg_trips", "zone_hour_agg", "zone_hour_dense", "training_features"


def build_marts(spark: SparkSession, trips: DataFrame, out: str, cfg: DatasetConfig) -> dict[str, str]:
    """Registers the staged view and the stored tables; returns the stored paths.

    The staged layer stays a view, so its filters reach the scan; later layers are read
    back from storage.
    """
    use_utc(spark)
    out = out.rstrip("/")
    staged = valid_trips(trips, cfg.start, cfg.end, cfg.min_zone, cfg.max_zone)
    staged.createOrReplaceTempView(STAGED)
    paths = {HOURLY: write_table(hourly_demand(staged), f"{out}/{HOURLY}")}
    paths[DENSE] = write_table(densify(spark.read.parquet(paths[HOURLY]), cfg.start, cfg.end), f"{out}/{DENSE}")
    paths[MART] = write_table(add_calendar(spark.read.parquet(paths[DENSE])), f"{out}/{MART}")
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return paths


def check_marts(spark: SparkSession, cfg: DatasetConfig) -> DataFrame:
    """``(layer, rule, violations)`` of all layers registered by :func:`build_marts`."""
    months = sorted({int(m[5:]) for m in cfg.months}) or list(range(1, 13))
    staged = spark.table(STAGED).withColumn("hour_ts", hour_floor("ts"))
    reports = {
        STAGED: row_violations(staged, staged_trip_contract(cfg.start, cfg.end, cfg.min_zone, cfg.max_zone)),
        DENSE: grid_report(spark.table(DENSE), cfg.start, cfg.end, cfg.split.train_start),
        MART: contract_report(spark.table(MART), calendar_contract(months)),
    }
    out = None
    for layer, report in reports.items():
        tagged = report.selectExpr(f"'{layer}' AS layer", "rule", "violations")
        out = tagged if out is None else out.unionByName(tagged)
    return out
