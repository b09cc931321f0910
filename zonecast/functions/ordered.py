"""Exact order statistics over value distributions.

Values are first collapsed to ``(feature, value, n)`` with map-side combine, so a
value held by a third of all rows is one row.  A monotone bucket then narrows the
search: only the buckets that contain a wanted rank are sorted, and no task ever
sorts a whole feature.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_OCTAVE = 4096
_SHIFT = 1100 * PER_OCTAVE


def pairs(columns: Sequence[str]) -> Column:
    """Array of ``(feature, value)`` structs, one per column, as one SQL expression."""
    cells = ", ".join(f"struct('{c}' AS feature, CAST(`{c}` AS DOUBLE) AS value)" for c in columns)
    return F.expr(f"array({cells})")


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)``: how often each value of each column occurs."""
    return (
        df.select(F.inline(pairs(columns)))
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def monotone_bucket(value: Column) -> Column:
    """Order-preserving bucket: 4096 equal steps within each power of two.

    Equal steps in ``exponent + mantissa`` are continuous across powers of two, so
    rounding in ``log2`` cannot break the order.  Bounded by the range of doubles.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    step = F.floor((exponent + size / F.pow(F.lit(2.0), exponent) - 1) * PER_OCTAVE) + _SHIFT
    return F.when(value > 0, step).when(value < 0, -step).otherwise(F.lit(0)).cast("bigint")


def order_statistics(dist: DataFrame, ranks: Callable[[Column], Column], by: str = "feature") -> DataFrame:
    """Value at each 0-based rank, exactly.

    ``ranks`` turns the row count of a feature into an array of wanted ranks.  Returns
    ``(by, total, rank, value)`` with one row per distinct wanted rank.
    """
    bucketed = dist.withColumn("bucket", monotone_bucket(F.col("value")))
    over = Window.partitionBy(by)
    hist = (
        bucketed.groupBy(by, "bucket")
        .agg(F.sum("n").alias("bn"))
        .withColumn("total", F.sum("bn").over(over))
        .withColumn(
            "before",
            F.sum("bn").over(over.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            - F.col("bn"),
        )
    )
    wanted = F.array_distinct(ranks(F.col("total")))
    picks = hist.withColumn(
        "wanted",
        F.filter(wanted, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("bn"))),
    ).where(F.size("wanted") > 0)
    # At most one pick per wanted rank and feature: a few dozen rows.
    cand = bucketed.join(F.broadcast(picks.drop("bn")), [by, "bucket"])
    in_bucket = Window.partitionBy(by, "bucket").orderBy("value")
    upto = F.sum("n").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("before")
    return (
        cand.withColumn("upto", upto)
        .withColumn(
            "rank",
            F.explode(F.filter("wanted", lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))),
        )
        .select(by, "total", "rank", "value")
    )


def single(df: DataFrame, column: str) -> DataFrame:
    """Distribution of one column under the feature name of that column."""
    return distribution(df, [column])


def nearest_rank(q: float) -> Callable[[Column], Column]:
    """Rank of quantile ``q`` by rounding ``(n - 1) * q``."""
    return lambda n: F.round((n - 1) * F.lit(float(q))).cast("bigint")


def floor_rank(percent: float) -> Callable[[Column], Column]:
    """Rank ``min(int(n * percent / 100), n - 1)``."""
    return lambda n: F.least(F.floor(n * F.lit(float(percent)) / 100), n - 1).cast("bigint")


def linear_edges(dist: DataFrame, n_bins: int) -> DataFrame:
    """``(feature, edges)``: ``n_bins + 1`` linearly interpolated quantile edges."""
    steps = F.expr("array(" + ", ".join(f"{i / n_bins!r}D" for i in range(n_bins + 1)) + ")")

    def ranks(n: Column) -> Column:
        at = F.transform(steps, lambda q: (n - 1) * q)
        return F.concat(
            F.transform(at, lambda p: F.floor(p).cast("bigint")), F.transform(at, lambda p: F.ceil(p).cast("bigint"))
        )

    # A few dozen picked ranks per feature.
    picked = order_statistics(dist, ranks).groupBy("feature", "total").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")
    )

    def edge(q: Column) -> Column:
        p = (F.col("total") - 1) * q
        low = F.element_at("at", F.floor(p).cast("bigint"))
        high = F.element_at("at", F.ceil(p).cast("bigint"))
        return low + (high - low) * (p - F.floor(p))

    return picked.select("feature", F.transform(steps, edge).alias("edges"))


def bin_counts(dist: DataFrame, edges: DataFrame, n_bins: int) -> DataFrame:
    """``(feature, edges, counts)``: half-open bins, the last one closed.

    Counted as differences of cumulative counts, so repeated edges give empty bins
    and values outside the edges are dropped.
    """
    # One row per feature: safe to broadcast.
    joined = dist.join(F.broadcast(edges), "feature")
    below = F.expr(
        "array("
        + ", ".join(f"sum(IF(value {'<=' if i == n_bins else '<'} edges[{i}], n, 0L))" for i in range(n_bins + 1))
        + ")"
    )
    counted = joined.groupBy("feature", "edges").agg(below.alias("below"))
    counts = F.expr(f"transform(sequence(1, {n_bins}), i -> below[i] - below[i - 1])")
    return counted.select("feature", "edges", counts.alias("counts"))
