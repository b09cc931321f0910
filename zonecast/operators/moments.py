"""Mergeable co-moments: counts, means and centred products per day, added up over any range."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import CONTINUOUS
from zonecast.session import shuffle_partitions

SCHEMA = "day int, n bigint, means array<double>, comoments array<double>"


def _combine(day, n, means, co, left, right):
    """Adds up parts of equal days; a part is a count, means and the centred products of the pairs.

    A single row is a part of count 1 without products.  Means are taken as differences
    from a day's first part, so a large common offset costs no digits and a constant
    column keeps products of exactly zero.
    """
    order = np.argsort(day, kind="stable")
    day, n, means, co = day[order], n[order], means[order], co[order]
    starts = np.flatnonzero(np.r_[True, day[1:] != day[:-1]])
    group = np.cumsum(np.r_[False, day[1:] != day[:-1]])
    total = np.add.reduceat(n, starts)
    base = means[starts]
    mean = base + np.add.reduceat(n[:, None] * (means - base[group]), starts) / total[:, None]
    off = means - mean[group]
    products = np.add.reduceat(co + n[:, None] * off[:, left] * off[:, right], starts)
    return day[starts], total, mean, products


def _pairs(k: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = zip(*combinations_with_replacement(range(k), 2))
    return np.array(left), np.array(right)


def _folder(k: int, read):
    """A task that folds its batches into one part per day: memory for its days alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _pairs(k)
        held = None
        for batch in batches:
            parts = read(batch, len(left))
            if held is not None:
                parts = tuple(np.concatenate(p) for p in zip(held, parts))
            if len(parts[0]):
                held = _combine(*parts, left, right)
        if held is not None:
            day, n, means, co = held
            arrays = [pa.array(day, pa.int32()), pa.array(n, pa.int64()), *(pa.array(list(a), pa.list_(pa.float64())) for a in (means, co))]
            yield pa.RecordBatch.from_arrays(arrays, ["day", "n", "means", "comoments"])

    return run


def _of_rows(batch: pa.RecordBatch, pairs: int):
    columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    means = np.column_stack(columns[1:]).astype(float)
    whole = ~np.isnan(means).any(axis=1)
    means = means[whole]
    return columns[0][whole], np.ones(len(means), np.int64), means, np.zeros((len(means), pairs))


def _of_parts(batch: pa.RecordBatch, pairs: int):
    day, n, means, co = batch.columns
    flat = (a.flatten().to_numpy(zero_copy_only=False) for a in (means, co))
    return day.to_numpy(), n.to_numpy(), *(a.reshape(batch.num_rows, -1) for a in flat)


def _fold(df: DataFrame, day, features: Sequence[str], partitions: int) -> DataFrame:
    values = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)]
    parts = df.select(day.cast("int").alias("day"), *values).mapInArrow(_folder(len(features), _of_rows), SCHEMA)
    # One part per day and task travels; its receiver folds parts as they come.
    return parts.repartition(partitions, "day").mapInArrow(_folder(len(features), _of_parts), SCHEMA)


def daily_moments(df: DataFrame, features: Sequence[str] = CONTINUOUS, ts: str = "hour_ts") -> DataFrame:
    """``(day, n, means, comoments)``: one row per day, in one pass over ``df``.

    ``comoments`` lists the sums of products of centred values for the pairs of
    ``features`` in order: first with first, first with second, and so on to last with
    last.  Rows without a time, or with a NULL or NaN feature, are left out.  No rows
    give no days.
    """
    rows = df.where(F.col(ts).isNotNull())
    folded = _fold(rows, F.unix_date(F.to_date(ts)), features, shuffle_partitions(df.sparkSession))
    return folded.withColumn("day", F.date_from_unix_date("day"))


def total_moments(df: DataFrame, features: Sequence[str] = CONTINUOUS) -> DataFrame:
    """The moments of all rows as one row, in one pass; rows with a NULL or NaN feature are left out."""
    return _fold(df, F.lit(0), features, 1).drop("day")


def merge_moments(daily: DataFrame, features: Sequence[str] = CONTINUOUS) -> DataFrame:
    """One row for all given days (filter them before); the calendar bounds their number."""
    parts = daily.select(F.lit(0).alias("day"), "n", "means", "comoments").coalesce(1)
    return parts.mapInArrow(_folder(len(features), _of_parts), SCHEMA).drop("day")


def pair_moments(moments: DataFrame, features: Sequence[str] = CONTINUOUS) -> DataFrame:
    """``f1, f2, m1, s, v1, v2`` beside the other columns: every pair once, with the first one's mean, its sum of products
    and both columns' own."""
    left, right = _pairs(len(features))
    own = {int(a): p for p, (a, b) in enumerate(zip(left, right)) if a == b}
    cells = [
        F.struct(
            F.lit(features[a]).alias("f1"),
            F.lit(features[b]).alias("f2"),
            F.get("means", F.lit(a)).alias("m1"),
            F.get("comoments", F.lit(p)).alias("s"),
            F.get("comoments", F.lit(own[a])).alias("v1"),
            F.get("comoments", F.lit(own[b])).alias("v2"),
        )
        for p, (a, b) in enumerate(zip(left.tolist(), right.tolist()))
    ]
    return moments.select("*", F.inline(F.array(*cells))).drop("means", "comoments")


def correlations(moments: DataFrame, features: Sequence[str] = CONTINUOUS) -> DataFrame:
    """``(f1, f2, corr)`` for all pairs, from at most one row of moments.

    Constant columns have correlation 0 with everything, themselves included, so the
    diagonal tells which columns are valid; without rows all are 0.
    """
    one = moments.agg(F.first("comoments").alias("comoments"), F.first("means").alias("means"))
    corr = "CASE WHEN v1 > 0 AND v2 > 0 THEN IF(f1 = f2, 1.0D, s / sqrt(v1) / sqrt(v2)) ELSE 0.0D END AS corr"
    mirrored = "array_compact(array(struct(f1, f2, corr), IF(f1 = f2, NULL, struct(f2 AS f1, f1 AS f2, corr))))"
    return pair_moments(one, features).selectExpr("f1", "f2", corr).selectExpr(f"inline({mirrored})")
