"""Replay of the sliding-window request limit over a request log.

A request is admitted while fewer than ``limit`` admitted requests lie in the
``seconds`` before it (the boundary included).  Rejected requests leave no trace, so
admission depends on earlier decisions and is a fold in time order.  Most of it needs
no fold:

* Time is cut into buckets of the window's length, so what a request can see lies in
  its own and the preceding bucket.  Where those two hold at most ``limit`` requests
  together, every request is admitted.
* Such a calm bucket also fixes the state at its end.  The log therefore falls apart
  into independent bursts: runs of busy buckets, each after one calm bucket as lead-in.

Only bursts reach Python.  They are sorted by Spark and streamed batch by batch; the
state is at most ``limit`` times, whatever the length of a burst.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.operators.usage import bucket_of
from zonecast.session import shuffle_partitions


def bursts(log: DataFrame, limit: int, seconds: int = 60) -> DataFrame:
    """Per client and bucket: request count, whether it is busy or starts a burst, and the burst.

    One row per client and active bucket, so its window is bounded by the calendar.
    """
    active = log.groupBy("client", bucket_of(F.col("ts"), seconds).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("client").orderBy("bucket")
    before = F.sum("n").over(order.rangeBetween(-1, -1))
    busy = (F.col("n") + F.coalesce(before, F.lit(0))) > limit
    marked = active.withColumn("busy", busy)
    follows = F.max("busy").over(order.rangeBetween(-1, -1))
    marked = marked.withColumn("starts", F.col("busy") & ~F.coalesce(follows, F.lit(False)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("burst", F.sum(F.col("starts").cast("bigint")).over(upto))


def replay_admission(log: DataFrame, limit: int, seconds: int = 60, order: str = "request_id") -> DataFrame:
    """The log with ``admitted``; equal times are taken in ``order``.

    Reads the log twice (bucket counts, then rows).
    """
    # A calm bucket right before a burst belongs to it as lead-in.
    own = F.struct(F.col("bucket").alias("_bucket"), "burst", F.lit(False).alias("lead"))
    lead_in = F.struct((F.col("bucket") - 1).alias("_bucket"), "burst", F.lit(True).alias("lead"))
    roles = F.array_compact(F.array(own, F.when(F.col("starts"), lead_in)))
    members = bursts(log, limit, seconds).where("busy").select("client", F.inline(roles))
    rows = log.withColumn("_bucket", bucket_of(F.col("ts"), seconds))
    busy_keys = members.where(~F.col("lead")).select("client", "_bucket")
    calm = rows.join(busy_keys, ["client", "_bucket"], "left_anti").drop("_bucket").withColumn("admitted", F.lit(True))

    cols = log.columns
    folded = (
        rows.join(members, ["client", "_bucket"])
        .withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
        .repartition(shuffle_partitions(log.sparkSession), "client", "burst")
        .sortWithinPartitions("client", "burst", "_us", order)
    )
    width = seconds * 1_000_000

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, recent = None, deque()
        for batch in batches:
            admitted = []
            for client, burst, us in zip(batch["client"], batch["burst"], batch["_us"]):
                if (client, burst) != current:
                    current, recent = (client, burst), deque()
                while recent and recent[0] < us - width:
                    recent.popleft()
                ok = len(recent) < limit
                if ok:
                    recent.append(us)
                admitted.append(ok)
            batch["admitted"] = admitted
            yield batch.loc[~batch["lead"].astype(bool), [*cols, "admitted"]]

    schema = log.withColumn("admitted", F.lit(True)).schema
    return calm.unionByName(folded.mapInPandas(fold, schema))
