"""Reference distributions and drift of current data against them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import (
    CONTINUOUS,
    CORRELATION_ALERT,
    FEATURES,
    KS_ALPHA,
    PSI_ALERT,
    PSI_EPSILON,
    PSI_WARNING,
)
from zonecast.functions.ordered import bin_counts, distribution, linear_edges, pairs
from zonecast.functions.sampling import bottom_k, latest_n
from zonecast.functions.textfns import row_digest
from zonecast.operators.moments import correlations, total_moments
from zonecast.session import materialize, shuffle_partitions

# One in so many keys is digested first, to bound a sample.
_PROBE = 4


def reference_bins(train: DataFrame, features: Sequence[str] = FEATURES, n_bins: int = 10) -> DataFrame:
    """``(feature, edges, counts)``: quantile edges and the training rows in each bin.

    The distribution is stored: ranks, picked values and bin counts all read it.
    """
    dist = materialize(distribution(train, features), "distribution")
    return bin_counts(dist, linear_edges(dist, n_bins), n_bins)


def reference_sample(
    train: DataFrame,
    keys: Sequence[str] = ("zone_id", "hour_ts"),
    features: Sequence[str] = FEATURES,
    size: int = 5000,
    seed: int = 42,
) -> DataFrame:
    """``(feature, value, digest)``: a reproducible draw without replacement per feature."""
    # The key text is built once per row, before the row is spread over its features.
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("_key")

    def digested(rows: DataFrame) -> DataFrame:
        spread = rows.select(*features, key).select("_key", F.inline(pairs(features)))
        return spread.select("feature", "value", row_digest("_key", "feature", seed=seed).alias("digest"))

    # Digests cost most here: a part of the keys bounds the draw, so that only that part is digested twice.
    probe = train.where(F.pmod(F.xxhash64(*keys), F.lit(_PROBE)) == 0)
    return bottom_k(digested(train), size, probe=digested(probe))


def correlation_matrix(df: DataFrame, features: Sequence[str] = CONTINUOUS) -> DataFrame:
    """``(f1, f2, corr)`` for all pairs, from one pass over ``df``.

    Co-moments are folded per task and merged, with differences from a first value, so
    constant columns are exact and a large common offset costs no digits.  Constant
    columns have correlation 0 with everything, themselves included.
    """
    return correlations(total_moments(df, features), features)


def correlation_shift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """One row ``(correlation_shift, n_excluded)``.

    The Frobenius norm runs over the full matrix and is divided by the number of
    unordered pairs.  Columns constant on either side are left out; with fewer than
    two left the shift is 0.0.
    """
    cells = reference.join(current.withColumnRenamed("corr", "now"), ["f1", "f2"])
    valid = F.when(F.col("f1") == F.col("f2"), (F.col("corr") != 0) & (F.col("now") != 0))
    good = cells.withColumns(
        {
            "_ok1": F.max(valid).over(Window.partitionBy("f1")),
            "_ok2": F.max(valid).over(Window.partitionBy("f2")),
        }
    )
    both = F.col("_ok1") & F.col("_ok2")
    diag = F.col("f1") == F.col("f2")
    sums = good.agg(
        F.count_if(diag).alias("n"),
        F.count_if(diag & F.col("_ok1")).alias("k"),
        F.sqrt(F.sum(F.when(both, F.pow(F.col("now") - F.col("corr"), F.lit(2.0))).otherwise(F.lit(0.0)))).alias("norm"),
    )
    pairs = F.greatest(F.col("k") * (F.col("k") - 1) / 2, F.lit(1.0))
    return sums.select(
        F.when(F.col("k") < 2, F.lit(0.0)).otherwise(F.col("norm") / pairs).alias("correlation_shift"),
        (F.col("n") - F.col("k")).alias("n_excluded"),
    )


def psi(bins: DataFrame, current: DataFrame, n_bins: int = 10) -> DataFrame:
    """``(feature, psi)`` of current values against the reference bins."""
    features = [c for c in FEATURES if c in current.columns]
    now = bin_counts(distribution(current, features), bins.select("feature", "edges"), n_bins)
    both = bins.select("feature", F.col("counts").alias("ref")).join(
        now.select("feature", F.col("counts").alias("cur")), "feature"
    )
    zero = F.lit(0).cast("bigint")

    def total(c: str) -> Column:
        return F.aggregate(c, zero, lambda a, x: a + x)

    cells = both.select(
        "feature",
        total("ref").alias("ref_n"),
        total("cur").alias("cur_n"),
        F.inline(F.arrays_zip("ref", "cur")),
    )
    r = (F.col("ref") + PSI_EPSILON) / (F.col("ref_n") + PSI_EPSILON * n_bins)
    c = (F.col("cur") + PSI_EPSILON) / (F.col("cur_n") + PSI_EPSILON * n_bins)
    return cells.groupBy("feature").agg(F.sum((c - r) * F.ln(c / r)).alias("psi"))


def ks_statistic(sample: DataFrame, current: DataFrame) -> DataFrame:
    """``(feature, n_ref, n_cur, ks_statistic)`` between two ``(feature, value)`` tables.

    Both sides are bounded (sample size, buffer size) and equal values are merged
    first, so the running window per feature stays small.
    """
    tagged = sample.select("feature", "value", F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        current.select("feature", "value", F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    merged = tagged.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        merged.select(
            "feature",
            F.sum("r").over(whole).alias("n_ref"),
            F.sum("c").over(whole).alias("n_cur"),
            F.sum("r").over(upto).alias("r_upto"),
            F.sum("c").over(upto).alias("c_upto"),
        )
        .groupBy("feature", "n_ref", "n_cur")
        .agg(F.max(F.abs(F.col("r_upto") / F.col("n_ref") - F.col("c_upto") / F.col("n_cur"))).alias("ks_statistic"))
    )


def asymptotic_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Two-sided limit distribution of the statistic, clamped to [0, 1]."""
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # The cut-off series is wrong near zero, where the probability is 1.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def _outside_probability(d: float, n: int, m: int) -> float:
    """P(statistic >= d) when all orders of n + m values are equally likely.

    Draws values one by one.  ``w[k]`` is the probability that ``low + k`` of the first
    ``s`` values are of the first kind and the statistic has stayed below ``d`` so far;
    only counts inside the band are kept, and what leaves it is added up.
    """
    if d <= 0:
        return 1.0
    band = round(d * n * m) - 0.5
    outside, low, w = 0.0, 0, np.ones(1)
    for s in range(1, n + m + 1):
        left = n + m - s + 1
        i = np.arange(low, low + len(w))
        step = np.zeros(len(w) + 1)
        step[:-1] = w * np.maximum(m - (s - 1 - i), 0)
        step[1:] += w * (n - i)
        step /= left
        # |i * m - (s - i) * n| < band
        first = max(int(np.floor((s * n - band) / (n + m))) + 1, low, s - m, 0)
        last = min(int(np.ceil((s * n + band) / (n + m))) - 1, low + len(w), s, n)
        if last < first:
            return 1.0
        keep = slice(first - low, last - low + 1)
        outside += step[: keep.start].sum() + step[keep.stop :].sum()
        low, w = first, step[keep]
    return float(min(1.0, max(0.0, outside)))


def ks_test(sample: DataFrame, current: DataFrame, exact: bool = False) -> DataFrame:
    """Statistic and p-value per feature.

    ``exact`` counts lattice paths in a small Python helper that sees one row of three
    numbers per feature; otherwise the limit distribution is used, all in the JVM.
    """
    stats = ks_statistic(sample, current)
    if not exact:
        p = asymptotic_p_value(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
        return stats.withColumn("ks_pvalue", p)

    def p_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["ks_pvalue"] = [
                _outside_probability(d, min(int(a), int(b)), max(int(a), int(b)))
                for d, a, b in zip(rows["ks_statistic"], rows["n_ref"], rows["n_cur"])
            ]
            yield rows

    # One feature per task; adaptive coalescing would put these few rows together.
    stats = stats.repartition(max(1, shuffle_partitions(stats.sparkSession)), "feature")
    return stats.mapInPandas(p_values, "feature string, n_ref bigint, n_cur bigint, ks_statistic double, ks_pvalue double")


def current_buffer(scored: DataFrame, maxlen: int = 1000, ts: str = "scored_at", tie: str = "request_id") -> DataFrame:
    """The newest scored feature rows."""
    return latest_n(scored, maxlen, ts, tie)


def long_values(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return df.select(F.inline(pairs(features)))


def feature_drift(bins: DataFrame, sample: DataFrame, current: DataFrame, n_bins: int = 10, exact: bool = False) -> DataFrame:
    """``(feature, psi, ks_statistic, ks_pvalue, verdict)``."""
    joined = psi(bins, current, n_bins).join(ks_test(sample, long_values(current), exact), "feature")
    verdict = (
        F.when((F.col("psi") > PSI_ALERT) | (F.col("ks_pvalue") < KS_ALPHA), F.lit("alert"))
        .when(F.col("psi") > PSI_WARNING, F.lit("warning"))
        .otherwise(F.lit("ok"))
    )
    return joined.select(
        "feature",
        F.round("psi", 6).alias("psi"),
        F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("ks_pvalue", 6).alias("ks_pvalue"),
        verdict.alias("verdict"),
    )


def drift_status(
    per_feature: DataFrame, shift: DataFrame, current: DataFrame, min_samples: int = 100
) -> DataFrame:
    """One row: overall status, sample counts and correlation shift."""
    collected = current.agg(F.count(F.lit(1)).alias("n")).scalar()
    worst = per_feature.agg(
        F.max(F.when(F.col("verdict") == "alert", 2).when(F.col("verdict") == "warning", 1).otherwise(0)).alias("worst")
    )
    facts = shift.withColumns({"worst": worst.scalar(), "collected": collected})
    enough = F.col("collected") >= min_samples
    status = (
        F.when(~enough, F.lit("insufficient_samples"))
        .when((F.col("worst") == 2) | (F.col("correlation_shift") > CORRELATION_ALERT), F.lit("alert"))
        .when(F.col("worst") == 1, F.lit("warning"))
        .otherwise(F.lit("ok"))
    )
    return facts.select(
        status.alias("status"),
        "collected",
        F.lit(min_samples).cast("bigint").alias("required"),
        F.when(enough, F.round("correlation_shift", 6)).alias("correlation_shift"),
        F.when(enough, F.col("n_excluded")).alias("n_excluded"),
    )
