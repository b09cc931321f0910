"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one in HOT_SHARE rows, so at most HOT_SHARE keys are.
HOT_SHARE = 1000
_SALTS = 1 << 20


def key_counts(rows: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Rows per key, combined on the map side."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Left join to a table with one row per key, which also holds the key's row count ``n``.

    The at most ``HOT_SHARE`` hot keys are broadcast.  Their rows then carry a salt that
    matches nothing and spreads them evenly over the shuffle of the remaining keys.
    Adaptive skew handling cannot do this: it leaves a join alone when one side is an
    aggregate over its shuffle.  NULL keys match NULL keys.  Reads ``right`` three times:
    pass a stored table.  Its files can be far smaller than its rows, so the remaining keys
    carry a hint that keeps them from being collected for a broadcast.
    """
    values = [c for c in right.columns if c not in (*keys, n)]
    total = right.agg(F.sum(n).alias("total")).scalar()
    hot = F.col(n) * HOT_SHARE > total
    packed = F.struct(*values)

    def named(prefix: str, *extra: Column) -> list[Column]:
        return [*[F.col(k).alias(f"{prefix}{k}") for k in keys], packed.alias(f"{prefix}row"), *extra]

    def same(prefix: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])

    hot_rows = right.where(hot).select(*named("_h_"))
    # Always 0, but not a literal: a literal would drop out of the join keys.
    cold_rows = right.where(~hot).select(*named("_c_", F.pmod(F.col(n), F.lit(1)).cast("bigint").alias("_c_salt")))
    # Identical rows of different partitions get different salts; maps have no hash.
    hashed = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    salt = F.when(F.col("_h_row").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.lit(_SALTS)))
    joined = left.join(F.broadcast(hot_rows), same("_h_"), "left").withColumn("_salt", salt.cast("bigint"))
    joined = joined.join(cold_rows.hint("merge"), same("_c_") & (F.col("_salt") == F.col("_c_salt")), "left")
    found = F.coalesce("_h_row", "_c_row")
    return joined.select(*left.columns, *[found[c].alias(c) for c in values])
