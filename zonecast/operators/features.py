"""Calendar, lag and rolling features: for the whole history, and for single requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import FEATURES, DatasetConfig
from zonecast.functions.skew import key_counts, spread_join
from zonecast.functions.timefns import (
    day_of_week,
    hour_floor,
    hour_index,
    hour_of_day,
    hours,
    is_weekend,
    month,
    naive_utc,
    ts_lit,
)
from zonecast.session import materialize, shuffle_partitions


def add_calendar(df: DataFrame, ts: str = "hour_ts") -> DataFrame:
    return df.withColumns(
        {
            "hour_of_day": hour_of_day(ts),
            "day_of_week": day_of_week(ts),
            "is_weekend": is_weekend(ts),
            "month": month(ts),
        }
    )


def add_lags(df: DataFrame, lags: Sequence[int] = (1, 24, 168), windows: Sequence[int] = (24,)) -> DataFrame:
    """Lags and trailing means over a dense history.

    A trailing mean covers the ``w`` rows before the current one and is NULL until all
    of them exist.  It is the difference of two running totals, so its cost does not
    grow with ``w``.  Both windows share one shuffle and one sort per zone, whose rows
    are bounded by the calendar.
    """
    zone = Window.partitionBy("zone_id").orderBy("hour_ts")
    if windows:
        before = F.sum("trip_count").over(zone.rowsBetween(Window.unboundedPreceding, -1))
        df = df.withColumn("_before", F.coalesce(before, F.lit(0)))
    cols = {f"lag_{k}h": F.lag("trip_count", k).over(zone).cast("double") for k in lags}
    for w in windows:
        # NULL exactly while fewer than w rows precede.
        trailing = F.col("_before") - F.lag("_before", w).over(zone)
        cols[f"rolling_mean_{w}h"] = trailing / F.lit(w)
    return df.withColumns(cols).drop("_before")


def engineer_features(history: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """Model-ready rows from ``train_start`` on.

    The warm-up rows are dropped above the window, because lags reach into them.
    """
    rows = add_lags(history, cfg.lags, cfg.rolling_windows).where(F.col("hour_ts") >= ts_lit(cfg.split.train_start))
    return add_calendar(rows.na.drop(subset=cfg.lag_columns + cfg.rolling_columns))


CELL_KEYS = ("zone_id", "hour", "on_hour")
HOURS = 24


def with_cells(requests: DataFrame) -> DataFrame:
    """Requests with naive UTC ``hour_ts`` and their cell: zone, hour, and whether on the hour.

    Everything known about a request at serving time depends on its cell alone.  Requests
    are never truncated: one off the hour is legal but finds no history.
    """
    hour = hour_floor("hour_ts")
    return (
        requests.withColumn("hour_ts", naive_utc("hour_ts"))
        .withColumn("hour", hour)
        .withColumn("on_hour", F.col("hour_ts") == F.col("hour"))
    )


def flag_cells(cells: DataFrame, universe: DataFrame, start: datetime, end: Column) -> DataFrame:
    """Adds ``reason``: NULL when a cell can be served; the zone is checked first.

    Bounds are whole hours, so all requests of a cell are on the same side of them.
    """
    if (start.minute, start.second, start.microsecond) != (0, 0, 0):
        raise ValueError(f"the supported range must start on the hour, not at {start}")
    known = universe.select("zone_id").distinct().withColumn("_known", F.lit(True))
    outside = F.col("hour").isNull() | (F.col("hour") < ts_lit(start)) | (F.col("hour") >= end)
    reason = F.when(F.col("_known").isNull(), F.lit("unsupported_zone")).when(outside, F.lit("unsupported_timestamp"))
    return cells.join(known, "zone_id", "left").withColumn("reason", reason).drop("_known")


def zone_facts(history: DataFrame) -> DataFrame:
    """``(zone_id, zone_name, last_hour)``: all that serving asks of the history beside counts, in one pass.

    A zone carries the name on its earliest row.
    """
    return history.groupBy("zone_id").agg(
        F.min_by("zone_name", "hour_ts").alias("zone_name"), F.max("hour_ts").alias("last_hour")
    )


def supported_end(zones: DataFrame) -> Column:
    """Exclusive end of the servable range, one hour after the last history row."""
    return zones.agg((F.max("last_hour") + hours(1)).alias("e")).scalar()


def block_days(cfg: DatasetConfig) -> list[int]:
    """How many days before a request's day its lags and means can reach, farthest first; today is 0."""
    days = {0}
    for k in cfg.lags:
        days |= {k // HOURS} if k % HOURS == 0 else {k // HOURS, k // HOURS + 1}
    for w in cfg.rolling_windows:
        days |= set(range(-(-w // HOURS) + 1))
    return sorted(days, reverse=True)


def day_blocks(history: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """``(zone_id, day, slots)``: everything a request on that day can need, in one row.

    ``slots`` holds the counts of the days of :func:`block_days`, 24 each, NULL where the
    history has no row.  Hours are packed into days first, and whole days are copied to
    the days that look back on them (3 copies of a day for lags of 1, 24 and 168 hours),
    so the blocks are a fraction of the history's rows.  One shuffle, of ``(zone, hour,
    count)``; rows per zone are bounded by the calendar.  A day without rows of its own
    has a block when a day before it has rows.  Repeated hours count once, with the
    larger count.
    """
    back = block_days(cfg)
    # A fixed count, like the history's own: both aggregates below keep this partitioning.
    thin = history.select("zone_id", "hour_ts", "trip_count").repartition(
        shuffle_partitions(history.sparkSession), "zone_id"
    )
    hour = F.hour("hour_ts")
    slots = [F.max(F.when(hour == h, F.col("trip_count"))).alias(f"_{h}") for h in range(HOURS)]
    days = thin.groupBy("zone_id", F.to_date("hour_ts").alias("_day")).agg(*slots)
    copies = F.explode(F.array(*[F.lit(d) for d in back])).alias("_back")
    spread = days.select("zone_id", "_day", F.array(*[F.col(f"_{h}") for h in range(HOURS)]).alias("_slots"), copies)
    spread = spread.select("zone_id", F.date_add("_day", F.col("_back")).alias("day"), "_back", "_slots")
    none = F.array_repeat(F.lit(None).cast("bigint"), HOURS)
    # At most one day of a zone lies a given number of days back, so ``first`` has no choice.
    parts = [F.coalesce(F.first(F.when(F.col("_back") == d, F.col("_slots")), ignorenulls=True), none) for d in back]
    return spread.groupBy("zone_id", "day").agg(F.concat(*parts).alias("slots"))


def _block_features(keys: DataFrame, blocks: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """Lags and means of every distinct key by one equi-join on zone and day, then by position."""
    back = block_days(cfg)
    start = {d: i * HOURS for i, d in enumerate(back)}
    hour = F.hour("hour_ts")

    def slot(k: int) -> Column:
        """Position (from 0) of the hour ``k`` hours earlier."""
        days, rest = divmod(k, HOURS)
        here = hour + (start[days] - rest)
        return here if rest == 0 else F.when(hour >= rest, here).otherwise(hour + (start[days + 1] + HOURS - rest))

    cols = {f"lag_{k}h": F.get("slots", slot(k)).cast("double") for k in cfg.lags}
    for w in cfg.rolling_windows:
        # The days a mean covers are the last ones of the block, without a hole between them.
        seen = F.array_compact(F.slice("slots", hour + (start[0] - w + 1), F.lit(w)))
        total = F.aggregate(seen, F.lit(0).cast("bigint"), lambda a, x: a + x)
        cols[f"rolling_mean_{w}h"] = F.try_divide(total, F.size(seen))
    found = keys.withColumn("day", F.to_date("hour_ts")).join(blocks, ["zone_id", "day"])
    return found.withColumns(cols).select("zone_id", "hour_ts", *cols)


def _window_features(cells: DataFrame, history: DataFrame, cfg: DatasetConfig) -> DataFrame:
    """All cells with lags and means, NULL for those off the hour, in one pass over the history.

    Cells join the history as rows without a count; frames count hours, not rows, so
    gaps in the history are seen as gaps.  Repeated hours count once, with the larger
    count.  Means are differences of running totals.  The rows of a zone are bounded by its
    hours, asked for or in the history, and each is held once, in the sort by zone and hour.
    """
    asked = cells.withColumns({"trip_count": F.lit(None).cast("bigint"), "_asked": F.lit(True)})
    known = history.select("zone_id", F.col("hour_ts").alias("hour"), "trip_count", F.lit(False).alias("_asked"))
    rows = asked.unionByName(known, allowMissingColumns=True).withColumn("_h", hour_index("hour"))
    # One sort serves both windows: the second one's order begins the first one's.
    repeats = Window.partitionBy("zone_id").orderBy("_h", "hour", F.desc_nulls_last("trip_count"))
    again = F.lag("hour").over(repeats) == F.col("hour")
    rows = rows.withColumn("trip_count", F.when(again, F.lit(None)).otherwise(F.col("trip_count")))
    zone = Window.partitionBy("zone_id").orderBy("_h")

    def before(k: int) -> tuple[Column, Column]:
        """Sum and number of the counts at least ``k`` hours earlier."""
        upto = zone.rangeBetween(Window.unboundedPreceding, -k)
        return F.coalesce(F.sum("trip_count").over(upto), F.lit(0)), F.count("trip_count").over(upto)

    cols = {f"lag_{k}h": F.max("trip_count").over(zone.rangeBetween(-k, -k)).cast("double") for k in cfg.lags}
    for w in cfg.rolling_windows:
        (total, n), (old_total, old_n) = before(1), before(w + 1)
        cols[f"rolling_mean_{w}h"] = F.try_divide(total - old_total, n - old_n)
    return rows.select(*cells.columns, "_asked", *[F.when(F.col("on_hour"), v).alias(c) for c, v in cols.items()]).where("_asked").drop("_asked")


def cell_features(
    cells: DataFrame,
    history: DataFrame,
    cfg: DatasetConfig,
    universe: DataFrame | None = None,
    bulk: bool = False,
    zones: DataFrame | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Cells with ``reason`` and features; those of rejected cells are NULL.

    Missing lags count as 0.0 and the trailing mean is over the hours that exist.
    ``zones`` and ``blocks`` are stored results of :func:`zone_facts` and
    :func:`day_blocks`; with both, the history is not read.
    """
    zones = zone_facts(history) if zones is None else zones
    flagged = flag_cells(cells, zones if universe is None else universe, cfg.split.train_start, supported_end(zones))
    served = F.col("reason").isNull()
    if bulk:
        found = _window_features(flagged, history, cfg)
    else:
        keys = flagged.where(served & F.col("on_hour")).select("zone_id", F.col("hour").alias("hour_ts"))
        looked_up = _block_features(keys, day_blocks(history, cfg) if blocks is None else blocks, cfg)
        looked_up = looked_up.withColumnRenamed("hour_ts", "hour").withColumn("on_hour", F.lit(True))
        found = flagged.join(looked_up, list(CELL_KEYS), "left")
    out = add_calendar(found, "hour")
    calendar = {c: F.when(served, F.col(c)) for c in ("hour_of_day", "day_of_week", "is_weekend", "month")}
    measured = {c: F.when(served, F.coalesce(c, F.lit(0.0))) for c in cfg.lag_columns + cfg.rolling_columns}
    return out.withColumns({**calendar, **measured})


def serve_features(
    requests: DataFrame,
    history: DataFrame,
    cfg: DatasetConfig,
    universe: DataFrame | None = None,
    bulk: bool = False,
    zones: DataFrame | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Features at request time; rejected requests keep NULL features and a ``reason``.

    Requests are collapsed to cells, so a hot zone and hour costs one look-up, and the
    join back spreads hot cells.  A look-up is one row of the day blocks, stored ones
    (``blocks``) or those of the history; ``bulk`` makes one pass over the history
    instead.  Reads ``requests`` twice and stores the cells in between.
    """
    rows = with_cells(requests)
    counts = key_counts(rows, CELL_KEYS)
    cells = materialize(cell_features(counts, history, cfg, universe, bulk, zones, blocks), "cells")
    return spread_join(rows, cells, CELL_KEYS).drop("hour", "on_hour")


def require_schema(columns: Sequence[str], expected: Sequence[str] = FEATURES) -> None:
    """Stored column order must equal the code's order, or scoring would mix columns up."""
    if list(columns) != list(expected):
        raise ValueError(f"stored feature order {list(columns)} differs from {list(expected)}; retrain")
