"""Stateful jobs as Structured Streaming.

Streaming frames carry ``ts`` as ``timestamp`` (watermarks need an instant); the
session zone is UTC.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from zonecast.functions.timefns import NTZ, col_of
from zonecast.operators.drift import current_buffer
from zonecast.operators.quality import log_entries
from zonecast.session import path_exists


def as_instant(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def hourly_stream(trips: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Hourly demand per zone: in append mode an hour once the watermark has passed it, in update mode every change."""
    per_hour = as_instant(trips).withWatermark("ts", lateness).groupBy("zone_id", F.window("ts", "1 hour").alias("w"))
    return per_hour.agg(
        F.count(F.lit(1)).alias("trip_count"), F.avg("fare").alias("avg_fare"), F.avg("distance").alias("avg_distance")
    ).select(
        "zone_id",
        F.col("w.start").cast(NTZ).alias("hour_ts"),
        "trip_count",
        "avg_fare",
        "avg_distance",
    )


def usage_stream(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily usage counters per client and endpoint (``update`` or ``complete`` mode)."""
    per_day = as_instant(events).withWatermark("ts", lateness).groupBy(
        "client", "endpoint", F.window("ts", "1 day").alias("w")
    )
    return per_day.agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("records").cast("bigint").alias("total_records")
    ).select("client", "endpoint", F.to_date("w.start").alias("date"), "request_count", "total_records")


def prediction_log_stream(scored: DataFrame, path: str, checkpoint: str, created_at: datetime | None = None) -> StreamingQuery:
    """Appends every served prediction of a stream to the log table."""
    entries = log_entries(scored.where(F.col("predicted_count").isNotNull()), created_at)
    return (
        entries.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def quality_stream(
    predictions: DataFrame,
    actuals: DataFrame,
    window: str = "7 days",
    slide: str = "1 day",
    max_delay: str = "7 days",
) -> DataFrame:
    """Quality over sliding windows of prediction time, from late actuals.

    ``predictions``: ``prediction_id, predicted_value, created_at``; ``actuals``:
    ``prediction_id, actual_value, observed_at``.  State is bounded by the watermarks
    and the join's time bound.
    """
    p = as_instant(predictions, "created_at").withWatermark("created_at", max_delay)
    a = as_instant(actuals.withColumnRenamed("prediction_id", "actual_id"), "observed_at").withWatermark(
        "observed_at", max_delay
    )
    pairs = p.join(
        a,
        F.expr(
            "prediction_id = actual_id AND observed_at >= created_at "
            f"AND observed_at <= created_at + interval {max_delay}"
        ),
    )
    return quality_windows(pairs, window, slide)


def quality_windows(pairs: DataFrame, window: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Quality of matched pairs (``predicted_value, actual_value, created_at``) over sliding windows of prediction time."""
    err = F.col("predicted_value") - F.col("actual_value")
    size = F.abs("predicted_value") + F.abs("actual_value")
    return (
        pairs.groupBy(F.window("created_at", window, slide).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("matched_pairs"),
            F.avg(F.abs(err)).alias("mae"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.coalesce(F.lit(100.0) * F.avg(F.when(size > 0, 2 * F.abs(err) / size)), F.lit(0.0)).alias("smape"),
        )
        .select(
            F.col("w.start").cast(NTZ).alias("window_start"),
            F.col("w.end").cast(NTZ).alias("window_end"),
            "matched_pairs",
            "mae",
            "rmse",
            "smape",
        )
    )


def packed_id(c: Column | str) -> Column:
    """An id as bytes, one to one: a digest of 32 lower-case hex digits as its 16 bytes, any other text behind 17 zero bytes."""
    text = col_of(c)
    raw = F.unhex(text)
    digest = F.coalesce((F.length(text) == 32) & (F.lower(F.hex(raw)) == text), F.lit(False))
    return F.when(digest, raw).otherwise(F.concat(F.lit(bytes(17)), text.cast("binary")))


def unpacked_id(c: Column | str) -> Column:
    """The id that :func:`packed_id` packed."""
    data = col_of(c)
    text = F.substring(data, 18, 2**31 - 1).cast("string")
    return F.when(F.length(data) == 16, F.lower(F.hex(data))).otherwise(text)


def quality_latest(predictions: DataFrame, actuals: DataFrame, path: str, checkpoint: str, window: str = "7 days", slide: str = "1 day") -> DataFrame:
    """``quality_stream`` over everything available, windows as they stand after the last batch, open ones too.

    An actual may come any time after its prediction, so there is no watermark: the table ``{path}-rows`` keeps both sides, once and with
    packed ids.  Each micro-batch stores its rows there and the pairs it matched (a repeated batch overwrites itself): its predictions
    with all actuals so far, and earlier predictions with its actuals.  Rows that no time of the other side can match are not joined.
    """
    spark, stored = predictions.sparkSession, f"{path}-rows"
    # A row without an id or a time has no pair.  Asked of the packed id, this would pack every id twice.
    made = as_instant(predictions, "created_at").where("prediction_id IS NOT NULL AND created_at IS NOT NULL")
    seen = as_instant(actuals, "observed_at").where("prediction_id IS NOT NULL AND observed_at IS NOT NULL")
    packed = packed_id("prediction_id").alias("id")
    both = made.select(packed, "predicted_value", "created_at").unionByName(
        seen.select(packed, "actual_value", "observed_at"), allowMissingColumns=True
    )
    schema = StructType([*both.schema.fields, StructField("batch", LongType())])
    columns = ["predicted_value", "actual_value", "created_at"]

    def matched(preds: DataFrame, acts: DataFrame) -> DataFrame:
        return preds.join(acts, "id").where("observed_at >= created_at").select(*columns)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{stored}/batch={batch_id}")
        rows = spark.read.schema(schema).parquet(stored)
        preds = rows.where("created_at IS NOT NULL").select("id", "predicted_value", "created_at", "batch")
        acts = rows.where("observed_at IS NOT NULL").select("id", "actual_value", "observed_at", "batch")
        mine = F.col("batch") == batch_id
        first, last = rows.where(mine).agg(F.unix_micros(F.min("created_at")), F.unix_micros(F.max("observed_at"))).first()
        pairs = rows.select(*columns).limit(0)
        if first is not None:
            pairs = matched(preds.where(mine), acts.where((F.col("batch") <= batch_id) & (F.col("observed_at") >= F.timestamp_micros(F.lit(first)))))
        if last is not None and batch_id > 0:
            earlier = preds.where((F.col("batch") < batch_id) & (F.col("created_at") <= F.timestamp_micros(F.lit(last))))
            pairs = pairs.unionByName(matched(earlier, acts.where(mine)))
        pairs.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    each_batch(both, handle, checkpoint).awaitTermination()
    pairs = StructType([*both.select(*columns).schema.fields, StructField("batch", LongType())])
    return quality_windows(spark.read.schema(pairs).parquet(path), window, slide)


def admission_stream(requests: DataFrame, limit: int, seconds: int = 60) -> DataFrame:
    """Sliding-window admission as ``(client, request_id, ts, admitted)``.

    State per client is the admitted times of the last ``seconds``.  Within a
    micro-batch requests are taken in time order; a request from an earlier time than
    the state is judged when it arrives.  A client's share of one micro-batch is sorted
    in memory, so bound the source's rate (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    width = seconds * 1_000_000

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        recent = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["_us", "request_id"], kind="stable")
        admitted = []
        for us in rows["_us"]:
            recent = [t for t in recent if t >= us - width]
            ok = len(recent) < limit
            if ok:
                recent.append(us)
            admitted.append(ok)
        state.update((recent,))
        rows["admitted"] = admitted
        yield rows[["client", "request_id", "ts", "admitted"]]

    keyed = as_instant(requests).withColumn("_us", F.unix_micros("ts"))
    return keyed.groupBy("client").applyInPandasWithState(
        fold,
        "client string, request_id bigint, ts timestamp, admitted boolean",
        "recent array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drift_stream(
    scored: DataFrame,
    evaluate: Callable[[DataFrame], DataFrame],
    buffer_path: str,
    report_path: str,
    checkpoint: str,
    maxlen: int = 1000,
    ts: str = "scored_at",
    tie: str = "request_id",
) -> StreamingQuery:
    """Per micro-batch: update the buffer of newest scored rows, then evaluate drift on it.

    Each batch stores its own buffer, built from the previous batch's buffer and the new
    rows, so work per batch does not grow with the stream and a repeated batch
    overwrites itself.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        previous, mine = f"{buffer_path}/batch={batch_id - 1}", f"{buffer_path}/batch={batch_id}"
        rows = batch
        if path_exists(spark, previous):
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(previous))
        current_buffer(rows, maxlen, ts, tie).write.mode("overwrite").parquet(mine)
        report = evaluate(spark.read.schema(batch.schema).parquet(mine))
        report.write.mode("overwrite").parquet(f"{report_path}/batch={batch_id}")

    return each_batch(scored, handle, checkpoint)


def run_latest(df: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Runs an update-mode aggregate over everything available; the last state of every group, open windows included.

    Each micro-batch stores the groups it changed (a repeated batch overwrites itself); reading keeps each group's newest row.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        df.writeStream.foreachBatch(handle)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    states = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("batch", LongType())])).parquet(path)
    newest = states.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), "batch").alias("row"))
    return newest.select("row.*")


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs an append-mode stream over everything available into Parquet, and reads it back."""
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
