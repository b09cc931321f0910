"""Monthly Parquet taxi trips and the zone lookup CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timefns import NTZ

# Fixed value: file name of one month.
FILE_PATTERN = "yellow_tripdata_{month}.parquet"


def month_files(root: str, months: Sequence[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{FILE_PATTERN.format(month=m)}" for m in months]


def read_trips(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Trips of the given files, folders or globs under the common column names."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths).select(
        F.col("PULocationID").cast("bigint").alias("zone_id"),
        F.col("tpep_pickup_datetime").cast(NTZ).alias("ts"),
        F.col("tpep_dropoff_datetime").cast(NTZ).alias("end_ts"),
        F.col("total_amount").cast("double").alias("fare"),
        F.col("trip_distance").cast("double").alias("distance"),
    )


def read_zone_lookup(spark: SparkSession, path: str, id_column: str = "LocationID", name_column: str = "Zone") -> DataFrame:
    """``(zone_id, zone_name)`` from a CSV with a header; columns are found by name."""
    return spark.read.option("header", True).csv(path).select(
        F.col(id_column).cast("bigint").alias("zone_id"), F.col(name_column).alias("zone_name")
    )
