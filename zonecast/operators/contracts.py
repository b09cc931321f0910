"""Declarative data contracts, checked in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.timefns import NTZ, ts_lit
from zonecast.operators.history import hour_gaps


class ContractError(ValueError):
    """Raised with the names and counts of the violated rules."""


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


@dataclass(frozen=True)
class Contract:
    name: str
    types: dict[str, str]
    rules: tuple[Rule, ...]
    keys: tuple[str, ...] = ()


def not_null(column: str) -> Rule:
    return Rule(f"not_null_{column}", F.col(column).isNull())


def at_least(column: str, low) -> Rule:
    return Rule(f"min_{column}", F.col(column) < F.lit(low))


def in_range(column: str, low, high) -> Rule:
    return Rule(f"range_{column}", ~F.col(column).between(low, high))


def accepted(column: str, values: Sequence) -> Rule:
    return Rule(f"accepted_{column}", ~F.col(column).isin(*values))


def in_window(column: str, start: datetime, end: datetime) -> Rule:
    c = F.col(column)
    return Rule(f"window_{column}", (c < ts_lit(start)) | (c >= ts_lit(end)))


def history_contract() -> Contract:
    return Contract(
        "history",
        {
            "zone_id": "bigint",
            "zone_name": "string",
            "hour_ts": NTZ,
            "trip_count": "bigint",
            "avg_fare": "double",
            "avg_distance": "double",
        },
        (
            not_null("zone_id"),
            not_null("zone_name"),
            not_null("hour_ts"),
            not_null("trip_count"),
            at_least("zone_id", 1),
            at_least("trip_count", 0),
        ),
        ("zone_id", "hour_ts"),
    )


def feature_contract() -> Contract:
    calendar = {"hour_of_day": (0, 23), "day_of_week": (0, 6), "is_weekend": (0, 1), "month": (1, 12)}
    measured = ("lag_1h", "lag_24h", "lag_168h", "rolling_mean_24h")
    return Contract(
        "features",
        {
            "zone_id": "bigint",
            "hour_ts": NTZ,
            "trip_count": "bigint",
            **{c: "bigint" for c in calendar},
            **{c: "double" for c in measured},
        },
        (
            *(not_null(c) for c in ("zone_id", "hour_ts", "trip_count", *calendar, *measured)),
            at_least("zone_id", 1),
            at_least("trip_count", 0),
            *(in_range(c, lo, hi) for c, (lo, hi) in calendar.items()),
        ),
        ("zone_id", "hour_ts"),
    )


def prediction_contract() -> Contract:
    return Contract(
        "predictions",
        {"zone_id": "bigint", "hour_ts": NTZ, "predicted_count": "double"},
        (
            not_null("zone_id"),
            not_null("hour_ts"),
            not_null("predicted_count"),
            at_least("zone_id", 1),
            at_least("predicted_count", 0.0),
        ),
    )


def staged_trip_contract(start: datetime, end: datetime, min_zone: int, max_zone: int | None) -> Contract:
    """Filtered trips ``(zone_id, hour_ts, fare, distance)``."""
    zone = in_range("zone_id", min_zone, max_zone) if max_zone is not None else at_least("zone_id", min_zone)
    return Contract(
        "staged_trips",
        {"zone_id": "bigint", "hour_ts": NTZ, "fare": "double", "distance": "double"},
        (
            *(not_null(c) for c in ("zone_id", "hour_ts", "fare", "distance")),
            zone,
            in_window("hour_ts", start, end),
            at_least("fare", 0),
            at_least("distance", 0),
        ),
    )


def calendar_contract(months: Sequence[int]) -> Contract:
    """Accepted values of the calendar columns of the feature mart."""
    return Contract(
        "calendar",
        {"day_of_week": "bigint", "is_weekend": "bigint", "month": "bigint"},
        (
            *(not_null(c) for c in ("day_of_week", "is_weekend", "month")),
            accepted("day_of_week", range(7)),
            accepted("is_weekend", (0, 1)),
            accepted("month", months),
        ),
    )


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Casts to the contract's types; a value that does not fit raises (ANSI).  Extra columns stay."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in contract.types.items()})


def row_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(rule, violations)`` for all row rules in one pass."""
    counts = df.agg(*[F.count_if(r.violated).alias(r.name) for r in contract.rules])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in contract.rules])
    return counts.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """``(rule, violations)`` including key uniqueness."""
    report = row_violations(df, contract)
    if contract.keys:
        dups = duplicate_keys(df, contract.keys).agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(dups.select(F.lit("unique_" + "_".join(contract.keys)).alias("rule"), "violations"))
    return report


def violating_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break any row rule, with the names of the broken rules."""
    broken = F.filter(
        F.array(*[F.when(r.violated, F.lit(r.name)) for r in contract.rules]), lambda r: r.isNotNull()
    )
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def grid_report(history: DataFrame, start: datetime, end: datetime, warmup_end: datetime) -> DataFrame:
    """Checks over the whole grid: missing hours, and a missing warm-up period."""
    gaps = hour_gaps(history, start, end).agg(F.count(F.lit(1)).alias("violations"))
    warm = history.agg(
        F.when(
            F.count_if((F.col("hour_ts") >= ts_lit(start)) & (F.col("hour_ts") < ts_lit(warmup_end))) == 0, F.lit(1)
        )
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("violations")
    )
    return gaps.select(F.lit("no_hour_gaps").alias("rule"), "violations").unionByName(
        warm.select(F.lit("warmup_present").alias("rule"), "violations")
    )


def raise_on_violations(report: DataFrame, name: str) -> None:
    """At most one row per rule reaches the driver."""
    broken = {r["rule"]: r["violations"] for r in report.where(F.col("violations") > 0).collect()}
    if broken:
        raise ContractError(f"{name} contract violated: {broken}")


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Coerced rows, or :class:`ContractError`."""
    typed = coerce(df, contract)
    raise_on_violations(contract_report(typed, contract), contract.name)
    return typed


def require_metric(metrics: DataFrame, model: str, max_mae: float = 3.20, max_negative_pct: float = 5.0) -> None:
    """Regression gate over a metrics table from :func:`zonecast.operators.metrics.model_metrics`."""
    row = metrics.where(F.col("model") == model).select("mae", "pct_clipped").first()
    if row is None:
        raise ContractError(f"no metrics for model {model!r}")
    if not row["mae"] < max_mae or not row["pct_clipped"] < max_negative_pct:
        raise ContractError(f"{model}: mae {row['mae']}, {row['pct_clipped']}% clipped")
