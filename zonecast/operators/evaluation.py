"""Error analysis by zone and by segment, from per-zone totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import NIGHT_HOURS, PEAK_HOURS, TARGET
from zonecast.functions.ordered import nearest_rank, order_statistics, single

# Segment names.
ROW_SEGMENTS = ("late_night", "peak_hours", "weekend", "weekday", "zero_demand")
ZONE_SEGMENTS = ("sparse_zones", "dense_zones")


def _row_segments() -> dict[str, str]:
    """Condition of each row segment."""
    return {
        "late_night": f"hour_of_day BETWEEN {NIGHT_HOURS[0]} AND {NIGHT_HOURS[1]}",
        "peak_hours": f"hour_of_day IN ({', '.join(map(str, PEAK_HOURS))})",
        "weekend": "is_weekend = 1",
        "weekday": "is_weekend = 0",
        "zero_demand": f"{TARGET} = 0",
    }


def zone_totals(preds: DataFrame, models: Sequence[str]) -> DataFrame:
    """Rows, demand and absolute errors per zone, overall and within each row segment.

    Segments overlap, so they are conditional sums rather than copied rows.  Everything
    below works on this table, which has one row per zone.
    """
    name = "min(zone_name)" if "zone_name" in preds.columns else "CAST(NULL AS STRING)"
    aggs = {"zone_name": name, "n_all": "count(1)", "demand": f"sum({TARGET})"}
    for m in models:
        aggs[f"err_all__{m}"] = f"sum(abs({TARGET} - {m}))"
    for s, inside in _row_segments().items():
        aggs[f"n_{s}"] = f"count_if({inside})"
        for m in models:
            aggs[f"err_{s}__{m}"] = f"sum(IF({inside}, abs({TARGET} - {m}), 0D))"
    totals = preds.groupBy("zone_id").agg(*[F.expr(e).alias(c) for c, e in aggs.items()])
    return totals.withColumn("mean_demand", F.col("demand") / F.col("n_all"))


def hardest_zones(totals: DataFrame, model: str, k: int = 5) -> DataFrame:
    """Zones with the largest mean absolute error; ties go to the smaller id."""
    return (
        totals.select(
            "zone_id",
            "zone_name",
            (F.col(f"err_all__{model}") / F.col("n_all")).alias("mae"),
            "mean_demand",
        )
        .orderBy(F.desc("mae"), "zone_id")
        .limit(k)
    )


def demand_quantiles(means: DataFrame, column: str = "mean_demand", low: float = 0.1, high: float = 0.9) -> DataFrame:
    """One row ``(p_low, p_high)`` of nearest-rank quantiles over zones."""

    def ranks(n: Column) -> Column:
        return F.array(nearest_rank(low)(n), nearest_rank(high)(n))

    # Ranks rise with q, so the picked values are the extremes; equal ranks give one row.
    stats = order_statistics(single(means, column), ranks)
    return stats.agg(F.min("value").alias("p_low"), F.max("value").alias("p_high"))


def segment_mae(totals: DataFrame, models: Sequence[str]) -> DataFrame:
    """``(segment, n_rows, <model>_mae...)``; segments without rows are left out.

    Reads ``totals`` several times: pass a stored table.
    """
    q = demand_quantiles(totals)
    sparse = F.col("mean_demand") < q.select("p_low").scalar()
    dense = F.col("mean_demand") > q.select("p_high").scalar()
    aggs, rows = [], []
    for s in ZONE_SEGMENTS + ROW_SEGMENTS:
        n, err = (f"IF(_{s}, n_all, 0L)", f"IF(_{s}, err_all__%s, 0D)") if s in ZONE_SEGMENTS else (f"n_{s}", f"err_{s}__%s")
        aggs.append(F.expr(f"sum({n})").alias(f"n_{s}"))
        aggs += [F.expr(f"sum({err % m})").alias(f"err_{s}__{m}") for m in models]
        maes = ", ".join(f"try_divide(err_{s}__{m}, n_{s}) AS {m}_mae" for m in models)
        rows.append(f"struct('{s}' AS segment, n_{s} AS n_rows, {maes})")
    wide = totals.withColumns({"_sparse_zones": sparse, "_dense_zones": dense}).agg(*aggs)
    return wide.selectExpr(f"inline(array({', '.join(rows)}))").where(F.col("n_rows") > 0)


def segment_deltas(segments: DataFrame, candidate: str, baseline: str) -> DataFrame:
    """Percent change of the candidate's MAE against the baseline, per segment."""
    base = F.col(f"{baseline}_mae")
    delta = F.when(base > 0, (F.col(f"{candidate}_mae") - base) / base * 100)
    return segments.withColumn("delta_pct", delta)


def long_report(metrics: DataFrame, segments: DataFrame, hardest: DataFrame) -> DataFrame:
    """Evaluation report as ``(section, key, metric, value)`` rows."""

    def unpivot(df: DataFrame, section: str, key: str) -> DataFrame:
        values = [c for c in df.columns if c not in (key, "zone_name")]
        return df.select(
            F.lit(section).alias("section"),
            F.col(key).cast("string").alias("key"),
            F.inline(
                F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
            ),
        )

    return (
        unpivot(metrics, "model_comparison", "model")
        .unionByName(unpivot(segments, "segments", "segment"))
        .unionByName(unpivot(hardest, "hardest_zones", "zone_id"))
    )
