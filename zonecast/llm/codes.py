"""Vector code compression (operator 12).

Method: product codes by integer k-means, every assignment by an integer Walsh-Hadamard transform.  Parts and entries are padded with zeros to a
power of two P and transformed; the transform scales squared distances by exactly P.  Coefficients are ordered by sequency (number of
sign changes), where smooth parts of a vector concentrate, and their squared differences are added up in that order.  A
partial sum never exceeds the whole, so an entry whose partial sum is above the whole distance of the best entry so far is out; the
few that remain are summed further.  All arithmetic is on integers, so nothing is rounded and ties go to the lower index.

Scale: vectors become integers once, are dealt evenly over the tasks (an assignment is much work for few bytes) and stored.  Each round sends the codebooks (parts x entries x part
length) to the tasks; each task gives one row of sums and counts, which are added up in a second, bounded step before the driver divides.
``label_error`` is summed by label with map-side combine, stored, and joined back, so that Spark can split a hot label.

Rows whose vector is null, empty, or holds null or non-finite components take no part.  Vectors of different lengths, or of one that the
number of parts doesn't divide, raise ``ValueError``; so does a vector whose error exceeds 64 bits.  Rows with equal vec_id are rows of their own
(the smaller vector starts first), null ids come last.  With fewer rows than entries each row starts one.  Components that could overflow 64-bit sums are
worked on as Python integers.  An empty table gives no rows.  Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, shuffle_partitions, store

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors compared with a codebook at a time, and tasks that add up the sums of all others.
STEP, ADDERS = 1024, 16


def transformed(parts: np.ndarray) -> np.ndarray:
    """Coefficients of every row in sequency order; rows are padded with zeros to a power of two.  Butterflies, then the order."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    x = np.zeros((len(parts), size), parts.dtype)
    x[:, : parts.shape[1]] = parts
    width = 1
    while width < size:
        y = x.reshape(len(x), size // (2 * width), 2, width)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), size)
        width *= 2
    return x[:, _sequency(size)]


@lru_cache(maxsize=8)
def _sequency(size: int) -> np.ndarray:
    """Places of the coefficients, as the butterflies leave them, by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")


def safe_dtype(*arrays: np.ndarray):
    """64-bit integers where P times a squared distance fits them, else Python's."""
    size = max((a.shape[1] for a in arrays), default=1)
    padded = 1 << max(0, size - 1).bit_length()
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    return np.int64 if padded * padded * (2 * top) ** 2 < 1 << 62 else object


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every part (ties to the lower index) and the squared distance."""
    kind = safe_dtype(parts, entries)
    if kind is object:
        parts, entries = parts.astype(object), entries.astype(object)
    b = transformed(entries)
    padded = b.shape[1]
    steps = [0, *(k for k in (padded // 4, padded // 2) if k), padded]
    index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), kind)
    for start in range(0, len(parts), STEP):
        a = transformed(parts[start : start + STEP])
        n = len(a)
        # The first coefficients of all pairs; then the likeliest entry's whole distance is what others have to stay below.
        partial = np.zeros((n, len(b)), kind)
        for k in range(steps[1]):
            d = a[:, k : k + 1] - b[None, :, k]
            partial += d * d
        likely = partial.argmin(axis=1)
        rest = a - b[likely]
        least = (rest * rest).sum(axis=1)
        rows, cols = np.nonzero(partial <= least[:, None])
        sums = partial[rows, cols]
        for low, high in zip(steps[1:], steps[2:]):
            d = a[rows, low:high] - b[cols, low:high]
            sums = sums + (d * d).sum(axis=1)
            left = sums <= least[rows]
            rows, cols, sums = rows[left], cols[left], sums[left]
        # rows are in order, and so are the entries of each; a stable sort by distance keeps the lower index first
        order = np.lexsort((sums, rows)) if kind is not object else np.array(sorted(range(len(rows)), key=lambda i: (rows[i], sums[i])), np.int64)
        first = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
        index[start : start + n] = cols[first]
        distance[start : start + n] = sums[first] // padded
    return index, distance


def integer_rows(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``v`` (floor(scale * x) of every component) of the rows that take part."""
    v = F.col(vector)
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    exact = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return df.where(F.coalesce(usable, F.lit(False))).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), exact.alias("v"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if any(n != size for n in column.value_lengths().to_pylist()):
        raise ValueError(f"a vector hasn't {size} components")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _cut(m: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(x) for x in np.split(m, parts, axis=1)]


def _sums(rows: DataFrame, books: list[np.ndarray], size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part: sums of the parts that each entry is nearest to, and their number."""
    parts, entries = len(books), len(books[0])

    def packed(total: list) -> pa.RecordBatch:
        # decimal digits, as sums may pass 64 bits
        return pa.RecordBatch.from_pydict({"total": [" ".join(str(int(x)) for t, n in total for x in (*t.ravel(), *n))]})

    def zero() -> list:
        return [(np.zeros((entries, size // parts), object), np.zeros(entries, np.int64)) for _ in range(parts)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = zero(), False
        for batch in batches:
            for (sums, counts), part, book in zip(total, _cut(_matrix(batch.column("v"), size), parts), books):
                index, _ = nearest(part, book)
                order = np.argsort(index, kind="stable")
                own, starts = np.unique(index[order], return_index=True)
                if len(own):
                    wide = part if abs(part).max(initial=0) < 1 << 40 else part.astype(object)
                    sums[own] += np.add.reduceat(wide[order], starts, axis=0)
                    counts += np.bincount(index, minlength=entries)
                    any_row = True
        if any_row:
            yield packed(total)

    def parsed(text: str) -> list:
        numbers, out, at = np.array([int(x) for x in text.split(" ")], object), [], 0
        for _ in range(parts):
            end = at + entries * (size // parts)
            out.append((numbers[at:end].reshape(entries, -1), numbers[end : end + entries].astype(np.int64)))
            at = end + entries
        return out

    def add(texts: Iterator[str]) -> list:
        total = zero()
        for text in texts:
            total = [(s + t, n + c) for (s, n), (t, c) in zip(total, parsed(text))]
        return total

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for batch in batches for t in batch.column("total").to_pylist())
        yield packed(add(texts))

    each = map_rows(rows.select("v"), assign, "total string")
    return add(r["total"] for r in each.repartition(ADDERS).mapInArrow(add_up, "total string").collect())  # ADDERS rows


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one array (entries, part length) for each part; none for an empty table.  ``rows`` as ``integer_rows`` gives them, stored."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    if not first:
        return []
    size = len(first[0]["v"])
    if size % parts or any(len(r["v"]) != size for r in first):
        raise ValueError(f"vectors must have one length, and {parts} parts")
    books = _cut(np.array([r["v"] for r in first], np.int64), parts)
    for _ in range(rounds):
        for book, (sums, counts) in zip(books, _sums(rows, books, size)):
            used = np.flatnonzero(counts)
            book[used] = (sums[used] // counts[used, None].astype(object)).astype(np.int64)
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every row."""
    kinds = dict(rows.dtypes)
    size = sum(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(part, book) for part, book in zip(_cut(_matrix(batch.column("v"), size), len(books)), books)]
            code = np.stack([index for index, _ in found], axis=1).astype(np.uint8 if len(books[0]) <= 256 else ">u2")
            error = sum(d.astype(object) for _, d in found)
            if any(e >= 1 << 63 for e in error):
                raise ValueError("a squared distance exceeds 64 bits")
            codes = [r.tobytes().hex() for r in code]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error.tolist(), pa.int64())], names=["vec_id", "label", "code", "error"])

    return map_rows(rows, run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every row of ``df`` (vec_id, embedding, label) that takes part."""
    rows = store(integer_rows(df, scale=scale).repartition(shuffle_partitions(df.sparkSession)), "vectors")
    books = train(rows, parts, entries, rounds)
    kinds = dict(rows.dtypes)
    if not books:
        return df.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    coded = store(encode(rows, books), "codes")
    errors = store(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return joined.withColumn("codebooks_sha256", F.lit(digest(books)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return compress(rows).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _oracle(rounds: int) -> str:
    """Row per (row, part), brute-force assignment to all entries, and the rounds one after the other."""
    assign = """SELECT n, part, any_value(p) AS p, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT x.n, x.part, x.p, e.entry, list_sum(list_transform(list_zip(x.p, e.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts x JOIN {book} e USING (part)) GROUP BY n, part"""
    steps = []
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({assign.format(book=f'book{k}')})")
        steps.append(
            f"""sums{k} AS (SELECT part, entry, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS c
    FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM near{k}) GROUP BY part, entry, i),
moved{k} AS (SELECT part, entry, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS p FROM sums{k} GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.p, b.p) AS p FROM book{k} b LEFT JOIN moved{k} m USING (part, entry))"""
        )
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS n FROM kept
), parts AS MATERIALIZED (
  SELECT n, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS p FROM numbered, (SELECT unnest(range(4)) AS part)
), book0 AS MATERIALIZED (SELECT part, n AS entry, p FROM parts WHERE n < 256),
{", ".join(steps)}, last AS MATERIALIZED ({assign.format(book=f'book{rounds}')}
), coded AS (
  SELECT n, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY n
), whole AS (SELECT vec_id, label, code, error FROM numbered JOIN coded USING (n)
), books AS (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM whole, books
"""


ORACLE_SQL = _oracle(ROUNDS)
