"""Warnings on sparse zones and implausible predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import TARGET
from zonecast.functions.ordered import floor_rank, order_statistics, single
from zonecast.functions.skew import key_counts, spread_join
from zonecast.session import materialize


def zone_means(history: DataFrame) -> DataFrame:
    return (
        history.groupBy("zone_id")
        .agg(F.sum(TARGET).alias("_t"), F.count(F.lit(1)).alias("_n"))
        .select("zone_id", (F.col("_t") / F.col("_n")).alias("mean_demand"))
    )


def sparse_zones(means: DataFrame, percentile: float = 10.0) -> DataFrame:
    """Zones whose mean demand is below the percentile (positional rule), with the threshold.

    Reads ``means`` several times: pass a stored table.
    """

    def ranks(n):
        return F.array(floor_rank(percentile)(n))

    threshold = order_statistics(single(means, "mean_demand"), ranks).agg(F.max("value").alias("v"))
    return means.withColumn("threshold", threshold.scalar()).where(F.col("mean_demand") < F.col("threshold"))


def extreme_predictions(preds: DataFrame, history: DataFrame, multiplier: float = 5.0) -> DataFrame:
    """Predictions above ``multiplier`` times the zone's historical maximum, where that is positive.

    ``preds`` carries ``zone_id`` and ``predicted_count``.
    """
    peaks = history.groupBy("zone_id").agg(F.max(TARGET).alias("max_seen"))
    per_zone = materialize(key_counts(preds, ["zone_id"]).join(peaks, "zone_id"), "peaks")
    return spread_join(preds, per_zone, ["zone_id"]).where(
        (F.col("max_seen") > 0) & (F.col("predicted_count") > F.col("max_seen") * F.lit(float(multiplier)))
    )
