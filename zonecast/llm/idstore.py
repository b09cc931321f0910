"""Token-id output with keyed access (operator 3).

Method: ids are written as raw little-endian unsigned 32-bit payloads, and a minimal perfect hash maps each document key to
its place.  A key hashes to a small group, the group's stored seed sends it to one of exactly ``n`` slots, and the slot
holds a fingerprint, an offset and a length.  An access is one seed, one slot and one comparison, whatever the number of
documents; a key that was never stored fails its fingerprint.

Layout: ``segments`` holds Parquet rows, one per segment of about ``SEGMENT_IDS`` ids (documents are never cut; a longer one is a
segment of its own).  ``part`` numbers the ascending ranges of doc_id, ``segment`` the segments in a range.  Each row holds its
payload and its own index, so building that needs no shuffle: the only exchange of texts is the one that orders them.  The
running position of a segment is counted inside its range; the totals of the ranges (as many as shuffle partitions) are
added up on the driver.  ``directory`` leads from any key to its segments without touching payloads: keys are dealt by hash into
buckets of about ``BUCKET_KEYS``, and a bucket's own perfect hash gives the first and last segment that hold the key
(rows are ordered, so those between hold it, too).  ``lookup`` reads the wanted buckets, then the segments they name.

Null text is the empty text (the end id alone).  Rows that share a doc_id are kept as occurrences 0, 1, ... of it, ordered by
a hash of their text (counted inside each segment); rows without a doc_id come first and are kept under the null key.  An empty table
gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, new_folder, shuffle_partitions, store
from .tokens import default_path, fast_encoder, text_groups

SEGMENT_IDS = 1 << 18
#: Mean number of keys in a bucket of the directory, and of wanted keys that are looked up in one together.
BUCKET_KEYS = 1 << 15
#: Mean number of keys that share a seed.
GROUP = 4
_M = (1 << 64) - 1

SEGMENT = (
    "part int, segment int, local_start bigint, n_ids bigint, n_docs int, null_ids bigint, payload binary,"
    " keys binary, occurrences binary, seeds binary, fingerprints binary, offsets binary, lengths binary"
)
DIRECTORY = "bucket bigint, null_slot int, keys binary, seeds binary, fingerprints binary, first binary, last binary"


def key_hash(key: int | None, occurrence: int) -> int:
    """64 well-mixed bits of a key and its occurrence."""
    x = (occurrence * 0x9E3779B97F4A7C15 + (0x5851F42D4C957F2D if key is None else key + 1)) & _M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
    return x ^ (x >> 31)


def _slot(h: int, seed: int, n: int) -> int:
    return ((h * (2 * seed + 1) & _M) >> 20) % n


class PerfectHash:
    """``n`` distinct 64-bit hashes to the slots 0 .. n-1."""

    def __init__(self, seeds: np.ndarray, fingerprints: np.ndarray):
        self.seeds, self.fingerprints, self.n = seeds, fingerprints, len(fingerprints)

    @staticmethod
    def build(hashes: list[int]) -> "PerfectHash":
        n = len(hashes)
        groups: list[list[int]] = [[] for _ in range(-(-n // GROUP) or 1)]
        for h in hashes:
            groups[(h >> 40) % len(groups)].append(h)
        seeds, prints = np.zeros(len(groups), "<u4"), np.zeros(n, "<u2")
        free = bytearray(b"\1") * n
        for g in sorted(range(len(groups)), key=lambda g: -len(groups[g])):  # large groups while there is room
            own, seed = groups[g], 0
            if not own:
                break
            while True:
                slots = [_slot(h, seed, n) for h in own]
                if all(map(free.__getitem__, slots)) and len(set(slots)) == len(own):
                    break
                seed += 1
            seeds[g] = seed
            for h, s in zip(own, slots):
                free[s], prints[s] = 0, h & 0xFFFF
        return PerfectHash(seeds, prints)

    def slot(self, h: int) -> int | None:
        """The slot of a stored hash; None for others (but for 1 in 65,536 of them)."""
        if not self.n:
            return None
        s = _slot(h, int(self.seeds[(h >> 40) % len(self.seeds)]), self.n)
        return s if self.fingerprints[s] == h & 0xFFFF else None


def _occurrences(keys: list[int | None]) -> list[int]:
    """How often each key came before in this ascending list."""
    out, k = [], 0
    for i, key in enumerate(keys):
        k = k + 1 if i and keys[i - 1] == key else 0
        out.append(k)
    return out


def _segment(part: int, segment: int, start: int, keys: list[int | None], ids: list[np.ndarray]) -> dict:
    occurrences = _occurrences(keys)
    hashes = [key_hash(k, o) for k, o in zip(keys, occurrences)]
    index = PerfectHash.build(hashes)
    ends = np.cumsum([len(x) for x in ids])
    offsets, lengths = np.zeros(len(ids), "<u8"), np.zeros(len(ids), "<u8")
    stored, nth = np.zeros(len(ids), "<i8"), np.zeros(len(ids), "<u4")
    for h, key, o, x, end in zip(hashes, keys, occurrences, ids, ends.tolist()):
        s = index.slot(h)
        offsets[s], lengths[s], stored[s], nth[s] = end - len(x), len(x), key or 0, o
    return {
        "part": part, "segment": segment, "local_start": start, "n_ids": int(ends[-1]), "n_docs": len(ids),
        "null_ids": sum(len(x) for k, x in zip(keys, ids) if k is None),
        "payload": np.concatenate(ids).astype("<u4").tobytes(), "keys": stored.tobytes(), "occurrences": nth.tobytes(),
        "seeds": index.seeds.tobytes(), "fingerprints": index.fingerprints.tobytes(), "offsets": offsets.tobytes(), "lengths": lengths.tobytes(),
    }


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes ``docs`` (doc_id, text) and writes the store to ``folder``, in ascending doc_id order."""
    spark, path = docs.sparkSession, path or default_path()
    fields = spark.createDataFrame([], SEGMENT).schema
    kinds = pa.schema([(f.name, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, start, keys, ids, held = TaskContext.get().partitionId(), 0, 0, [], [], 0
        encode, end = fast_encoder(path), np.array([end_id], np.uint32)

        def flush():
            nonlocal segment, start, keys, ids, held
            row = _segment(part, segment, start, keys, ids)
            segment, start, keys, ids, held = segment + 1, start + held, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=kinds)

        for group in text_groups(batches):
            for key, text in zip(group.column("doc_id").to_pylist(), group.column("text").to_pylist()):
                own = np.concatenate([encode(text), end])
                if held and held + len(own) > segment_ids:
                    yield flush()
                keys.append(key)
                ids.append(own)
                held += len(own)
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The tie-breaker also splits a doc_id that many rows share over several ranges.
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shuffle_partitions(spark), "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(run, SEGMENT).write.option("compression", "zstd").mode("overwrite").parquet(f"{folder}/segments")
    _directory(spark, folder).write.option("compression", "zstd").mode("overwrite").parquet(f"{folder}/directory")


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``, the number of ids before them, and ``number``, the number of segments before them."""
    segments = spark.read.schema(SEGMENT).parquet(f"{folder}/segments")
    totals = sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids"), F.count("*")).collect())  # one row per range
    base, before, bases = 0, 0, []
    for part, n, count in totals:
        bases.append((part, base, before))
        base, before = base + n, before + count
    known = spark.createDataFrame(bases, "part int, base bigint, before bigint")
    placed = segments.join(F.broadcast(known), "part").withColumn("start", F.col("base") + F.col("local_start"))
    return placed.withColumn("number", F.col("before") + F.col("segment")).drop("base", "before")


def _directory(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each bucket of keys: its perfect hash, and by slot the first and last segment (running number) of the key."""
    stored = _stored(spark, folder)
    n = stored.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    buckets = max(1, -(-n // BUCKET_KEYS))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = sorted(set(_Reader.stored(row)), key=lambda k: (k is not None, k))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(own, pa.int64()), "number": pa.array([row["number"]] * len(own), pa.int64())})

    def build(table: pa.Table) -> pa.Table:
        own, first, last = (table.column(c).to_pylist() for c in ("doc_id", "first", "last"))
        hashes = [key_hash(k, 0) for k in own]
        index, null_slot = PerfectHash.build(hashes), -1
        places = np.zeros((3, len(own)), "<i8")
        for h, k, a, b in zip(hashes, own, first, last):
            s = index.slot(h)
            places[:, s] = (k or 0, a, b)
            null_slot = s if k is None else null_slot
        row = {"bucket": table.column("bucket")[0].as_py(), "null_slot": null_slot, "keys": places[0].tobytes(), "seeds": index.seeds.tobytes(),
               "fingerprints": index.fingerprints.tobytes(), "first": places[1].tobytes(), "last": places[2].tobytes()}
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.table({k: pa.array([v], kind) for (k, v), kind in zip(row.items(), kinds)})

    rows = stored.select("number", "keys", "offsets", "null_ids").mapInArrow(keys, "doc_id bigint, number bigint")
    rows = rows.groupBy("doc_id").agg(F.min("number").alias("first"), F.max("number").alias("last"))
    return rows.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInArrow(build, DIRECTORY)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets).cast("bigint"))


class _Reader:
    """Keyed access to one segment row."""

    def __init__(self, row: dict):
        self.start, self.payload, self.null_ids = row["start"], row["payload"], row["null_ids"]
        self.index = PerfectHash(np.frombuffer(row["seeds"], "<u4"), np.frombuffer(row["fingerprints"], "<u2"))
        self.offsets, self.lengths = np.frombuffer(row["offsets"], "<u8"), np.frombuffer(row["lengths"], "<u8")
        self.keys, self.occurrences = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["occurrences"], "<u4")

    @staticmethod
    def stored(row: dict) -> list[int | None]:
        """The segment's keys in the order of its documents."""
        offsets = np.frombuffer(row["offsets"], "<u8")
        order = np.argsort(offsets)
        nulls = int((offsets < row["null_ids"]).sum())  # rows without a key come first
        return [None] * nulls + np.frombuffer(row["keys"], "<i8")[order[nulls:]].tolist()

    def get(self, key: int | None, occurrence: int = 0) -> tuple[int, memoryview] | None:
        """(ids before the document, its raw ids), or None: a seed, a slot and its fingerprint, then the stored key, whatever the number of documents."""
        s = self.index.slot(key_hash(key, occurrence))
        if s is None or self.occurrences[s] != occurrence or self.keys[s] != (key or 0) or (self.offsets[s] < self.null_ids) != (key is None):
            return None
        at, n = int(self.offsets[s]), int(self.lengths[s])
        return self.start + at, memoryview(self.payload)[4 * at : 4 * (at + n)]


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per stored document, read through the index: doc_id, start, n_tokens, ids_crc32, and the part and segment that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", "part", "segment")}
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                reader, keys = _Reader(row), _Reader.stored(row)
                for key, occurrence in zip(keys, _occurrences(keys)):
                    start, raw = reader.get(key, occurrence)
                    for name, value in zip(out, (key, start, len(raw) // 4, zlib.crc32(raw), row["part"], row["segment"])):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k in ("part", "segment") else pa.int64()) for k, v in out.items()})

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int, segment int"
    return _stored(spark, folder).drop("local_start", "n_ids", "n_docs", "number").mapInArrow(run, schema)


def _addressed(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id`` and ``number`` of every segment that holds a wanted key (null is one, too)."""
    directory = spark.read.schema(DIRECTORY).parquet(f"{folder}/directory")
    buckets = (directory.agg(F.max("bucket")).first()[0] or 0) + 1
    wanted = store(keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().withColumn("bucket", _bucket(buckets)), "wanted")
    slices = 1 + wanted.count() // (buckets * BUCKET_KEYS)  # many more keys than the store has are asked in turns
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(slices).cast("bigint"))
    wanted = wanted.groupBy("bucket", part.alias("turn")).agg(F.collect_list(F.struct("doc_id")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                index = PerfectHash(np.frombuffer(row["seeds"], "<u4"), np.frombuffer(row["fingerprints"], "<u2"))
                stored, first, last = (np.frombuffer(row[c], "<i8") for c in ("keys", "first", "last"))
                for key in (w["doc_id"] for w in row["wanted"]):
                    s = index.slot(key_hash(key, 0))
                    if s is not None and stored[s] == (key or 0) and (s == row["null_slot"]) == (key is None):
                        found.append((key, int(first[s]), int(last[s])))
            cols = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "first", "last"])

    places = directory.join(wanted, "bucket").mapInArrow(run, "doc_id bigint, first bigint, last bigint")
    return places.select("doc_id", F.explode(F.sequence("first", "last")).alias("number"))


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """The wanted documents: ``doc_id``, ``start`` (ids before it), ``occurrence`` (in its segment), ``ids`` (array<bigint>).  Unknown keys give no row."""
    places = store(_addressed(spark, folder, keys), "places")
    stored = _stored(spark, folder)
    parts = [r["part"] for r in stored.select("number", "part").join(places.select("number").distinct(), "number").select("part").distinct().collect()]
    wanted = places.groupBy("number").agg(F.collect_list(F.struct("doc_id")).alias("wanted"))  # no more than the segment has keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                reader = _Reader(row)
                for key in (w["doc_id"] for w in row["wanted"]):
                    occurrence = 0
                    while (hit := reader.get(key, occurrence)) is not None:
                        found.append((key, hit[0], occurrence, np.frombuffer(hit[1], "<u4").astype("i8")))
                        occurrence += 1
            cols = list(zip(*found)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(list(cols[3]), pa.list_(pa.int64()))],
                names=["doc_id", "start", "occurrence", "ids"],
            )

    # The ranges are as many as shuffle partitions; a file holds one, so its statistics leave the others unread.
    opened = stored.where(F.col("part").isin(parts)).join(wanted, "number")
    return opened.mapInArrow(run, "doc_id bigint, start bigint, occurrence int, ids array<bigint>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ids")
    write(documents(spark, sf_dir), folder)
    return digests(spark, folder)
