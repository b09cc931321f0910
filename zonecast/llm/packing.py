"""Best-fit packing of documents into training sequences (operator 7).

Method: vector best fit.  A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece
lengths).  Pieces are placed from the longest to the shortest; each goes to the open sequence with the best score among
those where *every* residual suffices.  The score is the weighted dot product of demand and residual, or the weighted norm
of what would be left.  A document longer than a sequence is cut, the remainder first, so that all its other pieces are full.

Scale: a piece's demand depends on its length alone, so the placing works on counts per length, at most ``max_tokens`` of
them, however many documents there are; sequences with equal residuals are one kind with a multiplicity.  That part
runs on the driver over a bounded table and gives rows "pieces number a .. b of length l go to sequences from s on".  The pieces
themselves are written once and never shuffled, ids least of all: the task that cuts them numbers them within their length, counts
per task and length say where each task's numbers begin (a hot length is spread over all tasks), and pieces meet their row by
a broadcast join.  Full pieces need no partner and are numbered the same way.

Null text is the empty text (its end id alone).  Rows that share a doc_id, or have none, are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_rows, store
from .tokens import default_path, fast_encoder, text_groups


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold.  By default the token capacity alone can bind: 2,048 pieces of one token cost 2,048 documents,
    and the squares of lengths that sum to 2,048 never pass its square; so no sequence more is opened than tokens need."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    score: str = "norm"  # or "dot"


def cut_lengths(n: int, most: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: the remainder first, then full pieces."""
    if n <= most:
        return [n]
    return [n % most] * bool(n % most) + [most] * (n // most)


def pieces_of(docs: DataFrame, most: int = 2048, path: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if wanted) of every piece of every document; ``part`` is the partition that a
    piece was cut in, ``number`` counts those of its length there.  To be stored at once: a second run may lay the rows out otherwise."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = fast_encoder(path), np.array([end_id], np.uint32)
        part, numbers = TaskContext.get().partitionId(), [0] * (most + 1)
        for group in text_groups(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "part", "number", "piece", "start", "length", "ids_crc32", "ids")}
            for key, text in zip(*(group.column(c).to_pylist() for c in ("doc_id", "text"))):
                ids, start = np.concatenate([encode(text), end]).astype("<u4"), 0
                for piece, n in enumerate(cut_lengths(len(ids), most)):
                    own = ids[start : start + n]
                    values = (key, part, numbers[n], piece, start, n, zlib.crc32(own.tobytes()), own.astype("i4") if with_ids else None)
                    for k, v in zip(out, values):
                        out[k].append(v)
                    start, numbers[n] = start + n, numbers[n] + 1
            kinds = {"part": pa.int32(), "piece": pa.int32(), "ids": pa.list_(pa.int32())}
            yield from pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items() if k != "ids" or with_ids}).to_batches()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, part int, number bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_rows(rows, run, schema + ", ids array<int>" * with_ids)


def best_fit(counts: dict[int, int], capacity: Capacity = Capacity()) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places ``counts`` (length: number of pieces); gives (length, first, count, sequence, offset) rows and the number of
    sequences: pieces first .. first+count-1 of that length go to sequences from ``sequence`` on, one each, at ``offset``."""
    if any(n < 1 or n > capacity.tokens or n * n > capacity.attention for n in counts) or capacity.documents < 1:
        raise ValueError("a piece fits no empty sequence")
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights) / full
    kinds: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # residual: runs of sequences
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], float)
        left, first = counts[length], 0
        while left:
            residual = np.array(list(kinds), float).reshape(-1, 3)
            after = residual - demand
            fits = np.flatnonzero((after >= 0).all(axis=1))
            if len(fits):
                if capacity.score == "dot":
                    score = -(residual[fits] / full) @ (weights * demand)
                else:
                    score = ((after[fits] * weights) ** 2).sum(axis=1)
                order = fits[np.lexsort([residual[fits][:, 2], residual[fits][:, 1], residual[fits][:, 0], score])]
                names = list(kinds)
                chosen = [names[i] for i in order]
            else:
                chosen = []
            fresh = not chosen
            if fresh:
                # New sequences take as many pieces of this length, one in each, as are left; then they are open like others.
                per = min(capacity.tokens // length, capacity.documents, capacity.attention // (length * length))
                need = -(-left // per)
                chosen = [tuple(int(x) for x in full)]
                kinds[chosen[0]] = [(opened, need)]
                opened += need
            # Kinds made by this length only get more of it once the present ones are used up or no longer best.
            for kind in chosen:
                runs = kinds.pop(kind)
                to = (kind[0] - length, kind[1] - 1, kind[2] - length * length)
                while runs and left:
                    at, n = runs.pop()
                    use = min(n, left)
                    placed.append((length, first, use, at, capacity.tokens - kind[0]))
                    if to[0] > 0:
                        kinds.setdefault(to, []).append((at, use))
                    if n > use:
                        runs.append((at + use, n - use))
                    first, left = first + use, left - use
                if runs:
                    kinds[kind] = runs
                if not left:
                    break
                again = to[0] >= length and to[1] >= 1 and to[2] >= length * length
                if again and not fresh:
                    break  # the new residual may now be the best
    return placed, opened


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` (stored; with part, number, length) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one per length
    placed, _ = best_fit(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "part", "base")
    # lengths x parts rows at most, so the bases are broadcast
    numbered = pieces.join(F.broadcast(ranks), ["length", "part"]).withColumn("k", F.col("number") + F.col("base")).drop("base", "part", "number")
    # Rows of the plan: bounded by lengths times kinds of residuals, not by pieces.
    plan = spark.createDataFrame(placed, "length bigint, first bigint, n bigint, sequence bigint, offset bigint")
    hit = (F.col("k") >= F.col("first")) & (F.col("k") < F.col("first") + F.col("n"))
    return (
        numbered.join(F.broadcast(plan), "length")
        .where(hit)
        .withColumn("sequence_id", F.col("sequence") + F.col("k") - F.col("first"))
        .drop("k", "first", "n", "sequence")
    )


def sequences(docs: DataFrame, capacity: Capacity = Capacity(), path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its place; ``with_ids`` also gives the ids."""
    pieces = store(pieces_of(docs, capacity.tokens, path, with_ids=with_ids), "pieces")
    return pack(pieces, capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return sequences(documents(spark, sf_dir)).select(*columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places, ids included: the training sequences."""
    return sequences(docs, with_ids=True)
