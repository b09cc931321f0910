"""Reproducible samples and latest-N buffers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.timefns import hour_floor
from zonecast.session import shuffle_partitions

_DIGEST_LENGTH = 32


def bottom_k(df: DataFrame, k: int, digest: str = "digest", by: str = "feature", probe: DataFrame | None = None) -> DataFrame:
    """The ``k`` rows of each group with the smallest hex digest, exactly.

    ``probe`` is any part of ``df``, by default all of it.  Its rows are counted by the
    beginning of the digest: leading zeros and two more digits, at most a few thousand
    beginnings per group.  The last beginning that ``k`` rows of the probe reach bounds
    the ``k`` smallest digests of all rows too, so everything behind it is filtered out on
    the map side.  A probe of one in ``m`` rows leaves about ``m * k`` rows per group to
    rank whatever the input size; a group with fewer than ``k`` rows in the probe is
    ranked whole.  Groups are features: a fixed few.
    """
    zeros = F.lit(_DIGEST_LENGTH) - F.length(F.ltrim(F.col(digest), F.lit("0")))
    # Zeros are counted only where there are some: most digests have none.
    size = F.when(F.col(digest) >= "1", F.lit(2)).otherwise(zeros + 2)
    begun = (df if probe is None else probe).select(by, F.substring(F.col(digest), F.lit(1), size).alias("_begin"))
    upto = Window.partitionBy(by).orderBy(F.asc_nulls_last("_begin"))
    last = F.min(F.when(F.col("_held") >= k, F.col("_begin")))
    bounds = (
        begun.groupBy(by, "_begin")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_held", F.sum("_n").over(upto))
        .groupBy(by)
        # Behind all digests with that beginning: "g" follows the hex digits.
        .agg(F.concat(last, F.lit("g")).alias("_bound"))
    )
    ranked = Window.partitionBy(by).orderBy(digest)
    return (
        df.where(F.col(by).isNotNull())
        .join(F.broadcast(bounds), by, "left")
        .where(F.col(digest) < F.coalesce("_bound", F.lit("g")))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= k)
        .drop("_bound", "_rank")
    )


def latest_n(df: DataFrame, n: int, ts: str, tie: str) -> DataFrame:
    """The ``n`` newest rows by ``(ts, tie)``.

    The hour from which at least ``n`` rows exist is found from hourly counts, and older
    rows are filtered at the scan.  What is left is ranked within hash buckets first, so
    even when a burst falls into that one hour the last task sees at most ``n`` rows per
    bucket.
    """
    newest_first = Window.orderBy(F.desc("_hour"))
    # One row per hour of the calendar.
    cutoff = (
        df.groupBy(hour_floor(ts).alias("_hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_held", F.sum("_n").over(newest_first))
        .agg(F.coalesce(F.max(F.when(F.col("_held") >= n, F.col("_hour"))), F.min("_hour")).alias("_cutoff"))
    )
    buckets = shuffle_partitions(df.sparkSession)
    in_bucket = Window.partitionBy("_bucket").orderBy(F.desc(ts), F.desc(tie))
    return (
        df.where(F.col(ts) >= cutoff.scalar())
        .withColumn("_bucket", F.pmod(F.xxhash64(ts, tie), F.lit(buckets)))
        .withColumn("_rank", F.row_number().over(in_bucket))
        .where(F.col("_rank") <= n)
        .drop("_bucket", "_rank")
        .orderBy(F.desc(ts), F.desc(tie))
        .limit(n)
    )
