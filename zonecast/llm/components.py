"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v) rows.  Large: every larger neighbour of u moves to the least of u and its neighbours.  Small: u and
    its smaller neighbours move to the least of them.  The least is stored, so that a join with a hub's many rows can be split."""
    if large:
        rows = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        rows = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = store(rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    moved = rows.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node of ``edges`` (columns u and v); edge tables only, never collected."""
    now = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = store(_stars(store(_stars(now, True), "large"), False), "small")
        before, state = state, _state(now)
        if before == state:
            break
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (node, component) after more ``links`` (u, v).  Ends are replaced by their components first, so only what joins two is left to do."""
    ends = links.select(F.col("u").alias("node")).union(links.select(F.col("v").alias("node"))).distinct()
    fresh = ends.join(parts, "node", "left_anti").select("node", F.col("node").alias("component"))
    known = store(parts.union(fresh), "known")
    side = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    across = links.join(side("u"), "u").join(side("v"), "v").select(F.col("u_part").alias("u"), F.col("v_part").alias("v")).where("u <> v")
    across = store(across.distinct(), "across")
    if across.isEmpty():
        return known
    moved = components(across).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return store(known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "parts")
