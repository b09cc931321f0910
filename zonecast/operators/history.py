"""Trips to a dense zone x hour history."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from zonecast.functions.timefns import NTZ, hour_floor, hour_spine, hours, ts_lit
from zonecast.session import shuffle_partitions

HISTORY_COLUMNS = ("zone_id", "zone_name", "hour_ts", "trip_count", "avg_fare", "avg_distance")


def _earliest() -> Column:
    """Order of names within a zone; equal times go to the smaller name."""
    return F.struct("first_ts", "zone_name")


def is_valid_trip(
    start: datetime, end: datetime, min_zone: int = 1, max_zone: int | None = None, has_end: bool = False
) -> Column:
    """A known zone, both times and non-negative measures, inside ``[start, end)``.

    Plain comparisons on scan columns, so all of them push down to Parquet.
    """
    keep = (
        F.col("ts").isNotNull()
        & (F.col("ts") >= ts_lit(start))
        & (F.col("ts") < ts_lit(end))
        & (F.col("zone_id") >= min_zone)
        & (F.col("fare") >= 0)
        & (F.col("distance") >= 0)
    )
    if max_zone is not None:
        keep &= F.col("zone_id") <= max_zone
    if has_end:
        keep &= F.col("end_ts").isNotNull()
    return keep


def valid_trips(
    trips: DataFrame,
    start: datetime,
    end: datetime,
    min_zone: int = 1,
    max_zone: int | None = None,
) -> DataFrame:
    """The trips for which :func:`is_valid_trip` holds."""
    return trips.where(is_valid_trip(start, end, min_zone, max_zone, "end_ts" in trips.columns))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row-count audit: the count is filled by whichever action runs ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class Audit:
    """Row counts of a source's steps, taken by the action that writes its result: no scan of their own.

    Only one action may run the watched rows before :meth:`counts` is read, and it must run
    all of them (a sink, not ``isEmpty``).  A lost stage that is computed again can count twice.
    """

    def __init__(self, source: str):
        self.source = source
        self._steps: dict[str, Observation] = {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        watched, self._steps[step] = counted(df, f"{self.source}-{step}-{uuid.uuid4().hex}")
        return watched

    def counts(self) -> dict[str, int]:
        """Rows per step, and ``dropped`` between the raw and the kept ones; call it after the sink.

        When the grid is empty, nothing was kept, and adaptive execution has replaced the
        steps below it together with their counts: only ``kept`` and ``grid`` are reported.
        """
        if "grid" in self._steps and not self._steps["grid"].get["rows"]:
            return {step: 0 for step in self._steps if step != "raw"}
        rows = {step: int(seen.get["rows"]) for step, seen in self._steps.items()}
        if {"raw", "kept"} <= set(rows):
            rows["dropped"] = rows["raw"] - rows["kept"]
        return rows

    def table(self, spark: SparkSession) -> DataFrame:
        """``(source, step, rows)``, a handful of rows."""
        return spark.createDataFrame([(self.source, k, n) for k, n in self.counts().items()], "source string, step string, rows bigint")


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Trips per zone and hour, with mean fare and distance where trips carry them.

    Trips with a ``zone_name`` are first counted per name, which keeps the pass over raw
    trips a hash aggregate; the hour then takes the name of its earliest trip, so names
    never become part of the key.
    """
    hour = hour_floor("ts").alias("hour_ts")
    measures = [(m, f"avg_{m}", m in trips.columns) for m in ("fare", "distance")]
    none = F.lit(None).cast("double")
    if "zone_name" not in trips.columns:
        means = [(F.avg(m) if there else none).alias(out) for m, out, there in measures]
        return trips.groupBy("zone_id", hour).agg(F.count(F.lit(1)).alias("trip_count"), *means)
    parts = [F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts")]
    for m, _, there in measures:
        parts += [F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n")] if there else []
    means = [
        (F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")) if there else none).alias(out) for m, out, there in measures
    ]
    named = trips.groupBy("zone_id", "zone_name", hour).agg(*parts)
    return named.groupBy("zone_id", "hour_ts").agg(
        F.sum("n").alias("trip_count"),
        *means,
        F.min_by("zone_name", _earliest()).alias("zone_name"),
        F.min("first_ts").alias("first_ts"),
    )


def zone_universe(trips: DataFrame) -> DataFrame:
    return trips.select("zone_id").distinct()


def first_zone_name(trips: DataFrame) -> DataFrame:
    """Name on the earliest trip of each zone."""
    named = trips.groupBy("zone_id", "zone_name").agg(F.min("ts").alias("first_ts"))
    return named.groupBy("zone_id").agg(F.min_by("zone_name", _earliest()).alias("zone_name"))


def densify(hourly: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row for every zone and every hour of ``[start, end)``.

    Each observed hour is expanded up to the zone's next observed hour, and the first
    also back to ``start``; added hours have zero trips and NULL means.  The source is
    read once, no zone list is collected or joined, and the result stays partitioned
    by zone for the feature windows.  A zone seen only outside the calendar still
    gets its all-zero rows.  Work per zone is bounded by the calendar, not by trips.
    """
    first, last = ts_lit(start), ts_lit(end - timedelta(hours=1))
    # A fixed count: the rows grow many times after this shuffle, which adaptive
    # coalescing (by size before growth) cannot know.
    hourly = hourly.repartition(shuffle_partitions(hourly.sparkSession), "zone_id")
    zone = Window.partitionBy("zone_id").orderBy("hour_ts")
    upto = F.coalesce(F.lead("hour_ts").over(zone) - hours(1), last)
    since = F.when(F.lag("hour_ts").over(zone).isNull(), first).otherwise(F.col("hour_ts"))
    named = "zone_name" in hourly.columns
    if named:
        whole = Window.partitionBy("zone_id")
        hourly = hourly.withColumn("zone_name", F.min_by("zone_name", _earliest()).over(whole))
    spans = hourly.select(
        "zone_id",
        *(["zone_name"] if named else []),
        F.col("hour_ts").alias("seen"),
        "trip_count",
        "avg_fare",
        "avg_distance",
        F.greatest(since, first).alias("since"),
        F.least(upto, last).alias("upto"),
    )
    real = F.col("hour_ts") == F.col("seen")
    none = F.lit(None).cast("double")
    return spans.withColumn("hour_ts", F.explode(hour_spine(F.col("since"), F.col("upto")))).select(
        "zone_id",
        *(["zone_name"] if named else []),
        "hour_ts",
        F.when(real, F.col("trip_count")).otherwise(F.lit(0)).cast("bigint").alias("trip_count"),
        F.when(real, F.col("avg_fare")).otherwise(none).alias("avg_fare"),
        F.when(real, F.col("avg_distance")).otherwise(none).alias("avg_distance"),
    )


def attach_names(dense: DataFrame, lookup: DataFrame | None, unknown_label: str) -> DataFrame:
    """Zone names from a lookup (or already on the rows), with a default label.

    No broadcast hint: the session's broadcast threshold checks the lookup's size.
    """
    if lookup is not None:
        dense = dense.join(lookup.select("zone_id", "zone_name"), "zone_id", "left")
    return dense.withColumn("zone_name", F.coalesce("zone_name", F.lit(unknown_label))).select(*HISTORY_COLUMNS)


def hourly_history(
    trips: DataFrame,
    start: datetime,
    end: datetime,
    lookup: DataFrame | None = None,
    unknown_label: str = "Unknown",
) -> DataFrame:
    """Trips to the common history table."""
    return attach_names(densify(hourly_demand(trips), start, end), lookup, unknown_label)


def hour_gaps(history: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Hours of the calendar that a zone lacks.

    Gaps are the holes between neighbouring rows of a zone, so the expected grid is
    never built and joined back.  Neighbours come from distinct hours.  The partition
    count is fixed because a short row can stand for a long gap.
    """
    first, last = ts_lit(start), ts_lit(end - timedelta(hours=1))
    present = history.select("zone_id", "hour_ts").distinct()
    present = present.repartition(shuffle_partitions(history.sparkSession), "zone_id")
    zone = Window.partitionBy("zone_id").orderBy("hour_ts")
    prev, nxt = F.lag("hour_ts").over(zone), F.lead("hour_ts").over(zone)
    holes = present.select(
        "zone_id",
        F.when(prev.isNull(), hour_spine(first, F.least(F.col("hour_ts") - hours(1), last)))
        .otherwise(F.array().cast(f"array<{NTZ}>"))
        .alias("lead_in"),
        hour_spine(
            F.greatest(F.col("hour_ts") + hours(1), first),
            F.least(F.coalesce(nxt - hours(1), last), last),
        ).alias("after"),
    )
    return holes.select("zone_id", F.explode(F.concat("lead_in", "after")).alias("hour_ts"))


def history_status(history: DataFrame, train_start: datetime) -> DataFrame:
    """Row and zone counts, and the range in which requests can be served."""
    per_zone = history.groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi")
    )
    return per_zone.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("history_rows"),
        F.count(F.lit(1)).alias("n_zones"),
        F.min("lo").alias("first_hour"),
        F.max("hi").alias("last_hour"),
        ts_lit(train_start).alias("supported_start"),
        (F.max("hi") + hours(1)).alias("supported_end"),
    )


def grid_difference(left: DataFrame, right: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows two pipelines disagree on, with the side that has them; empty means parity.

    ``partitions`` is the number of tasks the rows are compared in, by default the session's.
    """
    cols = left.columns
    right = right.select(*cols)
    tagged = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    # Dealt out before they are counted: rows of one side hardly repeat, so counting them where they are made would hold them all for nothing.
    dealt = tagged.repartition(*([] if partitions is None else [partitions]), *cols)
    net = dealt.groupBy(*cols).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, F.lit("left")).otherwise(F.lit("right"))
    return net.select(*cols, side.alias("side"), F.abs("_n").alias("copies"))
