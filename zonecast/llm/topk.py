"""Exact top-k inner-product search (operator 5).

Method: pivot-table elimination.  For every vector its distances to many pivots are computed once.  With |q - x|^2 = |q|^2 + |x|^2 -
2 q.x, the triangle inequality gives, from each pivot p, |q - x| >= | |q - p| - |x - p| |; the largest of these bounds turns into the
highest score that x can reach.  Candidates are evaluated in the order of that bound, and a query stops as soon as its
k-th best score is above the bound of the next candidate.  Scores are integers, so results are exact, ties included.

Scale: candidates are dealt into blocks, queries into blocks, and every pair of blocks is one row of work.  A query block keeps its
best scores of one candidate block (k rows for each query), and a window over those picks the k best of all.  Blocks have a fixed
size, so the memory of a task does not depend on the table.  Pivots are a bounded, documented sample (``PIVOTS`` vectors, by
smallest hash); they affect speed alone.  The work grows with queries times candidates: both grow with the table here.

Vectors that are null or hold a null or non-finite component take no part, and so do rows without an id.  All vectors must have
one dimension, and squared lengths must fit 60 bits; others raise.  Every row is a candidate, so a row that is stored m times can take m
ranks.  Every row of a query's id is asked, and the hits of all of them are ranked together.  A candidate with the query's own id is
left out, whatever its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, store

K, PIVOTS, BLOCK = 5, 64, 2048
#: Candidates evaluated at a time before the stopping rule is looked at again.
STEP = 256


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component, for the rows that take part."""
    v = F.col(vector)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select(F.col(key).cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != width).any():
        raise ValueError(f"vectors of {sorted(set(sizes.tolist()) | {width})} components cannot be compared")
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
    if m.size and np.abs(m).max() > (1 << 30) / width**0.5:
        raise ValueError("components are too large for exact 64-bit scores; choose a smaller scale")
    return m


def _blocks(rows: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """``block``, ``ids`` and ``vectors`` and ``table`` (distances to the pivots) as raw bytes; at most ``size`` vectors each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                m = _matrix(part.column("v"), pivots.shape[1])
                to = np.sqrt(np.maximum(0, (m * m).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (m @ pivots.T))).astype(np.float64)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(ids)], pa.int32()), "ids": [ids.tobytes()], "vectors": [m.tobytes()], "table": [to.tobytes()]})

    return rows.mapInArrow(run, "n int, ids binary, vectors binary, table binary")


def best_in_block(q_ids: np.ndarray, q: np.ndarray, q_to: np.ndarray, c_ids: np.ndarray, c: np.ndarray, c_to: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the k best of this block for each query."""
    q_norm, c_norm = (q * q).sum(1), (c * c).sum(1)
    out = []
    c_float, all_c = np.ascontiguousarray(c_to.T), np.arange(len(c))
    for i in range(len(q)):
        lower = np.abs(c_float - q_to[i][:, None]).max(axis=0) if c_float.size else np.zeros(len(c))
        # A little more than the bound itself: square roots and doubles are rounded.
        both = q_norm[i] + c_norm
        upper = np.floor((both - lower * lower * (1 - 1e-12)) / 2).astype(np.int64) + 1 + (both >> 50)
        own = all_c[c_ids != q_ids[i]]
        order = own[np.argsort(-upper[own], kind="stable")]
        best_s, best_c = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(order), STEP):
            if len(best_s) == k and upper[order[start]] < best_s[-1]:
                break  # no later candidate can reach the k-th best, not even by a tie
            part = order[start : start + STEP]
            s, ids = np.concatenate([best_s, c[part] @ q[i]]), np.concatenate([best_c, c_ids[part]])
            top = np.lexsort((ids, -s))[:k]
            best_s, best_c = s[top], ids[top]
        out += zip([int(q_ids[i])] * len(best_s), best_c.tolist(), best_s.tolist())
    return out


def search(queries: DataFrame, candidates: DataFrame, k: int = K, n_pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; both inputs as ``integer_vectors`` gives them."""
    spark = queries.sparkSession
    queries, candidates = queries.select("vec_id", "v"), candidates.select("vec_id", "v")
    chosen = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("v").collect()  # PIVOTS rows
    if len({len(r["v"]) for r in chosen}) > 1:
        raise ValueError("vectors of different numbers of components cannot be compared")
    if not chosen:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivots = np.array([r["v"] for r in chosen], np.int64)
    # Blocks are rows of bytes, so a shuffle moves each block whole and tasks get equal shares.
    left = _blocks(queries, pivots, block).withColumn("q_block", F.monotonically_increasing_id())
    right = _blocks(candidates, pivots, block).withColumn("c_block", F.monotonically_increasing_id())
    left, right = store(left, "queries"), store(right, "candidates")
    # Query blocks get running numbers (a row for each block, no vectors), so that each candidate block can name them all.
    numbers = left.select("q_block", (F.row_number().over(Window.orderBy("q_block")) - 1).alias("number"))
    count = left.count()
    pairs = right.select("c_block", F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1)))).alias("number")).where(F.lit(count > 0))
    pairs = pairs.join(numbers, "number").select("q_block", "c_block").repartition(shuffle_partitions(spark), "q_block", "c_block")
    work = pairs.join(left.selectExpr("q_block", "ids q_ids", "vectors q_vectors", "table q_table"), "q_block").join(right, "c_block")
    wide = len(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                ints = [np.frombuffer(row[x], np.int64).reshape(n, -1) for x, n in (("q_vectors", len(q_ids)), ("vectors", len(c_ids)))]
                tables = [np.frombuffer(row[x], np.float64).reshape(n, wide) for x, n in (("q_table", len(q_ids)), ("table", len(c_ids)))]
                found = best_in_block(q_ids, ints[0], tables[0], c_ids, ints[1], tables[1], k)
                cols = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["query_id", "vec_id", "score"])

    hits = work.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(vectors.where("vec_id % 50 = 0"), vectors)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
