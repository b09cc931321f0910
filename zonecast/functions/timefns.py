"""Timestamp and calendar columns (session time zone: UTC)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(NTZ)


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", col_of(ts)).cast(NTZ)


def day_floor(ts: Column | str) -> Column:
    return F.date_trunc("day", col_of(ts)).cast(NTZ)


def hours(n: int) -> Column:
    return F.expr(f"interval {int(n)} hours")


def naive_utc(ts: Column | str) -> Column:
    """An instant (``timestamp``) as naive UTC; naive values pass through."""
    return col_of(ts).cast(NTZ)


def hour_index(ts: Column | str) -> Column:
    """Whole hours since the epoch, so RANGE frames can count in hours."""
    return F.floor(F.unix_timestamp(col_of(ts).cast("timestamp")) / F.lit(3600)).cast("bigint")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(col_of(ts)).cast("bigint")


def day_of_week(ts: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(col_of(ts)).cast("bigint")


def is_weekend(ts: Column | str) -> Column:
    return F.when(F.weekday(col_of(ts)) >= 5, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def month(ts: Column | str) -> Column:
    return F.month(col_of(ts)).cast("bigint")


def hour_spine(start: Column, end: Column) -> Column:
    """Array of hours from ``start`` to ``end`` inclusive; empty when ``end`` is earlier."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 hour"))).otherwise(
        F.array().cast(f"array<{NTZ}>")
    )


def parse_minutes(text: Column | str) -> Column:
    """First 16 characters as ``yyyy-MM-dd HH:mm``; malformed text raises (ANSI)."""
    return F.to_timestamp_ntz(F.substring(col_of(text), 1, 16), F.lit("yyyy-MM-dd HH:mm"))


def parse_seconds(text: Column | str) -> Column:
    """First 19 characters as ``yyyy-MM-dd HH:mm:ss``; malformed text raises (ANSI)."""
    return F.to_timestamp_ntz(F.substring(col_of(text), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
