"""Usage roll-ups, request metrics and keep-latest de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import LATENCY_EDGES, PREDICTION_EDGES


def usage_daily(events: DataFrame) -> DataFrame:
    """Requests and records per client, endpoint and day."""
    return events.groupBy("client", "endpoint", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("records").cast("bigint").alias("total_records")
    )


def usage_report(daily: DataFrame, client: str | None = None) -> DataFrame:
    """Newest day first, optionally for one client."""
    rows = daily if client is None else daily.where(F.col("client") == F.lit(client))
    return rows.orderBy(F.desc("date"), "client", "endpoint")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; reduced on the map side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def rejection_counts(log: DataFrame) -> DataFrame:
    return log.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("rejections"))


def error_count(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if(F.col("status") == "500").alias("errors"))


def cumulative_histogram(df: DataFrame, value: str, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., le, observations)``: rows at or below each edge, and all rows under ``+Inf``."""
    v = F.col(value)
    counts = [F.count_if(v <= F.lit(float(e))).alias(f"b{i}") for i, e in enumerate(edges)]
    counts.append(F.count(v).alias("b_inf"))
    wide = (df.groupBy(*by) if by else df.groupBy()).agg(*counts)
    cells = [
        F.struct(F.lit(float(e)).alias("le"), F.col(f"b{i}").alias("observations")) for i, e in enumerate(edges)
    ]
    cells.append(F.struct(F.lit(float("inf")).alias("le"), F.col("b_inf").alias("observations")))
    return wide.select(*by, F.inline(F.array(*cells)))


def latency_histogram(log: DataFrame) -> DataFrame:
    return cumulative_histogram(log, "latency_s", LATENCY_EDGES, ["endpoint"])


def prediction_histogram(log: DataFrame) -> DataFrame:
    return cumulative_histogram(log, "predicted", PREDICTION_EDGES)


def bucket_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / F.lit(seconds)).cast("bigint")


def request_rate(log: DataFrame, seconds: int = 60) -> DataFrame:
    """Requests of the same client in the ``seconds`` up to and including each request.

    Time is cut into buckets as long as the frame, so a frame spans at most two of
    them.  Every request is copied once into the following bucket as context, and
    frames run per client and bucket: a busy client spreads over many tasks.
    """
    own = bucket_of(F.col("ts"), seconds)
    copies = F.array(
        F.struct(own.alias("bucket"), F.lit(False).alias("context")),
        F.struct((own + 1).alias("bucket"), F.lit(True).alias("context")),
    )
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    frame = Window.partitionBy("client", "bucket").orderBy("_us").rangeBetween(-seconds * 1_000_000, 0)
    return (
        log.select("*", F.inline(copies))
        .withColumn("_us", micros)
        .withColumn("recent", F.count(F.lit(1)).over(frame))
        .where(~F.col("context"))
        .drop("bucket", "context", "_us")
    )
