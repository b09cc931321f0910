"""Baseline forecasts as plain DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import TARGET

SLOT_KEYS = ("zone_id", "hour_of_day", "day_of_week")


def fit_slot_means(train: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows, total and mean of the target per zone, hour of day and weekday."""
    return (
        train.groupBy(*SLOT_KEYS)
        .agg(F.sum(target).alias("slot_total"), F.count(F.lit(1)).alias("slot_rows"))
        .withColumn("slot_mean", F.col("slot_total") / F.col("slot_rows"))
    )


def global_mean(slots: DataFrame) -> Column:
    """Mean target over all training rows, 0.0 when there are none."""
    return slots.agg(
        F.coalesce(F.try_divide(F.sum("slot_total"), F.sum("slot_rows")).cast("double"), F.lit(0.0)).alias("g")
    ).scalar()


def predict_slot_means(df: DataFrame, slots: DataFrame, output: str = "slot_mean") -> DataFrame:
    """Slot mean of each row; unseen slots get the global mean.

    Reads ``slots`` twice: pass a stored table.  Slots are few distinct values in order, so
    millions of them make a file of a few MB, which Spark would take for a table small enough
    to collect and broadcast: the hint keeps them off the driver.
    """
    known = slots.select(*SLOT_KEYS, F.col("slot_mean").alias("_slot")).hint("merge")
    return df.join(known, list(SLOT_KEYS), "left").withColumn(output, F.coalesce("_slot", global_mean(slots))).drop("_slot")


def predict_seasonal_naive(df: DataFrame, output: str = "seasonal_naive") -> DataFrame:
    """The same hour one week earlier."""
    return df.withColumn(output, F.col("lag_168h"))
