"""Streams whose earlier results change: usage kept by upserts, and quality of pairs that later rows revise.

Both keep their state as day-partitioned tables beside the stream's checkpoint.  A micro-batch reads and rewrites no more than the days or keys
it touches, and a repeated one leaves what the first left.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.timefns import NTZ, ts_lit
from zonecast.operators.quality import match_actuals, with_actuals
from zonecast.operators.usage import usage_daily
from zonecast.session import free_shuffles, materialize, path_exists
from zonecast.streaming.jobs import each_batch, packed_id, unpacked_id

# Usage ----------------------------------------------------------------------

USAGE_PARTS = "client string, endpoint string, source string, request_count bigint, total_records bigint, date date"


def merge_usage(events: DataFrame, path: str) -> None:
    """Merges events (``client, endpoint, ts, records, source``) into the stored daily table at ``path``.

    A row of the table is what one source (a file) adds to a client, endpoint and day.  Rows of the sources that come again are replaced,
    so a source can be replayed, alone or among others.  Only the days that it touches are read and rewritten.
    """
    spark = events.sparkSession
    sources = [r[0] for r in events.select("source").distinct().collect()]  # files of one micro-batch
    parts = [usage_daily(events.where(F.col("source") == s)).withColumn("source", F.lit(s)) for s in sources]
    if not parts:
        return
    new = parts[0]
    for more in parts[1:]:
        new = new.unionByName(more)
    new = materialize(new.select("client", "endpoint", "source", "request_count", "total_records", "date"), "usage-new")
    days = [r[0] for r in new.select("date").distinct().collect()]
    rows = new
    if path_exists(spark, path):
        stored = spark.read.schema(USAGE_PARTS).parquet(path)
        rows = stored.where(F.col("date").isin(days) & ~F.col("source").isin(sources)).unionByName(new)
    # The rows stand elsewhere before their days are replaced.
    rows = materialize(rows, "usage-merged")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def stored_usage(spark: SparkSession, path: str) -> DataFrame:
    """The daily roll-up of what ``merge_usage`` has stored."""
    rows = spark.read.schema(USAGE_PARTS).parquet(path)
    total = [F.sum(c).cast("bigint").alias(c) for c in ("request_count", "total_records")]
    return rows.groupBy("client", "endpoint", "date").agg(*total)


def usage_upserts(events: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a file stream of events (``client, endpoint, ts, records, source``) into the daily table; the table afterwards."""
    each_batch(events, lambda batch, _: merge_usage(batch, path), checkpoint).awaitTermination()
    return stored_usage(events.sparkSession, path)


# Quality --------------------------------------------------------------------

_EVENT = (
    "kind string, prediction_id string, zone_id bigint, hour_ts timestamp_ntz, predicted_value double, created_at timestamp_ntz, "
    "seq bigint, actual_value double, observed_at timestamp_ntz"
)
_STATE = _EVENT.replace("prediction_id string", "prediction_id binary")
_PAIR = ("prediction_id", "predicted_value", "actual_value", "created_at")
_DELTA = "prediction_id string, predicted_value double, actual_value double, created_at timestamp_ntz, sign bigint"


def quality_events(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Both inputs as one stream.  ``predictions``: ``prediction_id, zone_id, hour_ts, predicted_value, created_at``; ``actuals``:
    ``seq, prediction_id?, zone_id?, hour_ts?, actual_value, observed_at``."""
    both = predictions.withColumn("kind", F.lit("prediction")).unionByName(actuals.withColumn("kind", F.lit("actual")), allowMissingColumns=True)
    names = [c.split()[0] for c in _EVENT.split(", ")]
    return both.select(*names)


def _by_day(df: DataFrame, path: str, batch_id: int, at: str) -> None:
    # zstd: ids are hex digits, which the default codec does not shorten.
    rows = df.withColumn("day", F.to_date(at)).write.mode("overwrite").option("compression", "zstd")
    rows.partitionBy("day").parquet(f"{path}/batch={batch_id}")


def _since(spark: SparkSession, path: str, schema: str, horizon: datetime | None, before: int) -> DataFrame:
    """Stored rows of batches before ``before``, of days from ``horizon`` on: earlier days are never opened."""
    rows = spark.read.schema(f"{schema}, batch bigint, day date").parquet(path).where(F.col("batch") < before)
    return (rows if horizon is None else rows.where(F.col("day") >= F.lit(horizon.date()))).drop("batch", "day")


def _packed(rows: DataFrame) -> DataFrame:
    """Ids as bytes: what is shuffled between the tables is half as wide."""
    return rows.withColumn("prediction_id", packed_id("prediction_id"))


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """A table of the current micro-batch, in the place of the one before."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def revise_pairs(batch: DataFrame, batch_id: int, root: str, keep: timedelta) -> None:
    """Takes a micro-batch of ``quality_events`` in and stores what it changes as signed pairs.

    State are the predictions and submissions of the last ``keep`` (by the newest time seen).  For the zones and hours that the batch
    touches, pairs are matched anew, as in a batch job: the newest prediction of an hour takes what names the hour, an
    id takes what names it, the last submission wins.  A pair that no longer holds is withdrawn by a row of sign -1, a new one
    enters by +1.  Rows behind ``keep`` go to the table ``late`` and change nothing.
    """
    spark = batch.sparkSession
    at = F.coalesce("created_at", "observed_at")
    known = f"{root}/progress/batch={batch_id - 1}"
    before = spark.read.parquet(known).first()["newest"] if path_exists(spark, known) else None
    horizon = None if before is None else before - keep
    late = F.lit(False) if horizon is None else F.coalesce(at < ts_lit(horizon), F.lit(False))
    # The batch is stored once, as state with packed ids, and read from there.
    _by_day(batch.where(late).withColumn("at", at), f"{root}/late", batch_id, "at")
    _by_day(_packed(batch.where(~late)).withColumn("at", at), f"{root}/events", batch_id, "at")
    new = spark.read.schema(_STATE).parquet(f"{root}/events/batch={batch_id}")
    seen = new.agg(F.max(at)).first()[0]
    newest = max((t for t in (seen, before) if t is not None), default=None)

    state = _since(spark, f"{root}/events", _STATE, horizon, batch_id + 1)
    log = state.where("kind = 'prediction'").select("prediction_id", "zone_id", "hour_ts", "predicted_value", "created_at")
    actuals = state.where("kind = 'actual'").select("seq", "prediction_id", "zone_id", "hour_ts", "actual_value")
    hour = ["zone_id", "hour_ts"]
    named = new.where("kind = 'actual' AND prediction_id IS NOT NULL").select("prediction_id").distinct()
    direct = new.where("kind = 'prediction' OR prediction_id IS NULL").select(*hour)
    touched = _stored(direct.union(log.join(named, "prediction_id", "left_semi").select(*hour)).distinct(), f"{root}/touched")
    log = _stored(log.join(touched, hour, "left_semi"), f"{root}/touched-log")
    ids = log.select("prediction_id").distinct()
    actuals = (
        actuals.where("prediction_id IS NULL")
        .join(touched, hour, "left_semi")
        .unionByName(actuals.where("prediction_id IS NOT NULL").join(ids, "prediction_id", "left_semi"), allowMissingColumns=True)
    )
    now = with_actuals(log, match_actuals(log, actuals)).where("actual_value IS NOT NULL").select(*_PAIR, F.lit(1).cast("bigint").alias("sign"))
    if path_exists(spark, f"{root}/pairs"):
        held = _packed(_since(spark, f"{root}/pairs", _DELTA, horizon, batch_id)).join(ids, "prediction_id", "left_semi")
        now = now.unionByName(held.withColumn("sign", -F.col("sign")))
    changes = now.groupBy(*_PAIR).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    _by_day(changes.withColumn("prediction_id", unpacked_id("prediction_id")), f"{root}/pairs", batch_id, "created_at")
    spark.createDataFrame([(newest, new.count())], "newest timestamp_ntz, rows bigint").write.mode("overwrite").parquet(f"{root}/progress/batch={batch_id}")


def revised_windows(pairs: DataFrame, window: str = "7 days", slide: str = "1 day", required: int = 10) -> DataFrame:
    """Quality over sliding windows of prediction time from signed pairs; below ``required`` pairs the status says so and there are no errors."""
    err, size, sign = F.col("predicted_value") - F.col("actual_value"), F.abs("predicted_value") + F.abs("actual_value"), F.col("sign")
    rows = pairs.groupBy(F.window("created_at", window, slide).alias("w")).agg(
        F.sum(sign).alias("matched_pairs"),
        F.sum(sign * F.abs(err)).alias("abs"),
        F.sum(sign * err * err).alias("squares"),
        F.sum(F.when(size > 0, sign * 2 * F.abs(err) / size)).alias("parts"),
        F.sum(F.when(size > 0, sign)).alias("sized"),
    )
    n, enough = F.col("matched_pairs"), F.col("matched_pairs") >= required
    mean = {"mae": F.col("abs") / n, "rmse": F.sqrt(F.greatest(F.col("squares"), F.lit(0.0)) / n)}
    mean["smape"] = F.coalesce(F.lit(100.0) * F.try_divide("parts", "sized"), F.lit(0.0))
    return rows.where("matched_pairs > 0").select(
        F.col("w.start").cast(NTZ).alias("window_start"),
        F.col("w.end").cast(NTZ).alias("window_end"),
        F.when(enough, F.lit("ok")).otherwise(F.lit("insufficient_matched_pairs")).alias("status"),
        "matched_pairs",
        *[F.when(enough, v).alias(k) for k, v in mean.items()],
    )


def revised_quality(
    predictions: DataFrame,
    actuals: DataFrame,
    root: str,
    checkpoint: str,
    keep: timedelta = timedelta(days=30),
    window: str = "7 days",
    slide: str = "1 day",
    required: int = 10,
) -> DataFrame:
    """Runs everything available through ``revise_pairs``; windows as they stand after the last batch."""
    spark = predictions.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        revise_pairs(batch, batch_id, root, keep)
        free_shuffles(spark)

    each_batch(quality_events(predictions, actuals), handle, checkpoint).awaitTermination()
    pairs = spark.read.schema(f"{_DELTA}, batch bigint, day date").parquet(f"{root}/pairs")
    return revised_windows(pairs, window, slide, required)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that came more than ``keep`` behind the newest time, with the micro-batch that brought them."""
    return spark.read.schema(f"{_EVENT}, at timestamp_ntz, batch bigint, day date").parquet(f"{root}/late").drop("day")
