"""Half-open temporal splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import DatasetConfig, Split
from zonecast.functions.timefns import ts_lit


def split_name(split: Split, ts: str = "hour_ts") -> Column:
    """``train`` / ``val`` / ``test``, NULL outside all three."""
    c = F.col(ts)
    return (
        F.when((c >= ts_lit(split.train_start)) & (c < ts_lit(split.train_end)), F.lit("train"))
        .when((c >= ts_lit(split.train_end)) & (c < ts_lit(split.val_end)), F.lit("val"))
        .when((c >= ts_lit(split.val_end)) & (c < ts_lit(split.test_end)), F.lit("test"))
    )


def temporal_split(
    df: DataFrame, train_start, train_end, val_end, test_end, ts_column: str = "hour_ts"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows as three pushed-down range filters."""
    s = Split.of(train_start, train_end, val_end, test_end)
    c = F.col(ts_column)
    edges = [s.train_start, s.train_end, s.val_end, s.test_end]
    return tuple(df.where((c >= ts_lit(a)) & (c < ts_lit(b))) for a, b in zip(edges, edges[1:]))


def split_from_config(df: DataFrame, cfg: DatasetConfig, ts_column: str = "hour_ts"):
    s = cfg.split
    return temporal_split(df, s.train_start, s.train_end, s.val_end, s.test_end, ts_column)


def split_counts(df: DataFrame, split: Split) -> DataFrame:
    return (
        df.select("hour_ts", split_name(split).alias("split"))
        .where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("hour_ts").alias("first_hour"),
            F.max("hour_ts").alias("last_hour"),
        )
    )
