"""BPE encoding and decoding (operator 1).

Method: a priority queue of merge ranks over a doubly linked list of symbols.  Entries whose symbols have changed since
they were queued are skipped when they come up.  Decoding concatenates the vocabulary's byte strings.

A text is cut at single spaces; where no two spaces meet, those cuts are always borders of the tokenizer's own words, so
the ids of a piece do not depend on its surroundings and each Python worker keeps the ones it has merged.  Nothing is
shuffled: one scan, whatever the size of the table, and a hot source or repeated row costs no more than any other.

Null text is the empty text (no ids, the hash of nothing).  Repeated rows and null ids give one row each; columns of the
input other than the id and the text are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import WORD_PATTERN, default_path, text_groups, vocabulary

#: Pieces, and words in them, that one Python worker keeps; a full table is emptied and fills again.
KEPT = 600_000


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        self._vocab = vocab = vocabulary(path)
        if len(vocab.bytes) > 1 << 16:
            raise ValueError("pairs are keyed by two ids of 16 bits")
        self._rank = {a << 16 | b: r for r, (a, b, _) in enumerate(vocab.merges)}
        self._made = [n for _, _, n in vocab.merges]
        self._words = regex.compile(WORD_PATTERN).findall
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(vocab.special, key=len, reverse=True))) + ")").split if vocab.special else None
        self._known_words: dict[str, tuple[int, ...]] = {}
        self._known_pieces: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: the lowest rank first, equal ranks from left to right."""
        n = len(word)
        known, shift = self._rank.get, 12 if n <= 4096 else 32
        mask = (1 << shift) - 1
        symbol = list(map(self._vocab.of_byte.__getitem__, word))
        # waiting[i]: rank of the pair that starts at symbol i, as it stands now; -1 if it doesn't merge.
        waiting = [known(a << 16 | b, -1) for a, b in zip(symbol, symbol[1:])]
        queue = [r << shift | i for i, r in enumerate(waiting) if r >= 0]
        if not queue:
            return tuple(symbol)
        heapify(queue)
        made, last = self._made, n - 1
        waiting.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, last))
        while queue:
            entry = heappop(queue)
            i = entry & mask
            if waiting[i] != entry >> shift:
                continue  # stale: this pair has changed or gone since it was queued
            gone = after[i]
            symbol[i] = new = made[entry >> shift]
            symbol[gone] = waiting[gone] = -1
            after[i] = right = after[gone]
            if right <= last:
                before[right] = i
                waiting[i] = r = known(new << 16 | symbol[right], -1)
                if r >= 0:
                    heappush(queue, r << shift | i)
            else:
                waiting[i] = -1
            left = before[i]
            if left >= 0:
                waiting[left] = r = known(symbol[left] << 16 | new, -1)
                if r >= 0:
                    heappush(queue, r << shift | left)
        return tuple([s for s in symbol if s >= 0])

    def _ids(self, piece: str) -> tuple[int, ...]:
        out: list[int] = []
        known = self._known_words
        for word in self._words(piece):
            ids = known.get(word)
            if ids is None:
                ids = self.merge(word.encode())
                if len(known) >= KEPT:
                    known.clear()
                known[word] = ids
            out += ids
        return tuple(out)

    def _plain(self, text: str) -> list[int]:
        if "  " in text:  # a run of spaces is one word, which cuts at single spaces would break
            return list(self._ids(text)) if len(text) < 1000 else [i for w in self._words(text) for i in self._ids(w)]
        first, *pieces = text.split(" ")
        known = self._known_pieces
        try:
            rest = list(chain.from_iterable(map(known.__getitem__, pieces)))
        except KeyError:
            if len(known) >= KEPT:
                known.clear()
            for piece in set(pieces).difference(known):
                known[piece] = self._ids(f" {piece}")
            rest = list(chain.from_iterable(map(known.__getitem__, pieces)))
        return [*self._ids(first), *rest]

    def encode(self, text: str) -> list[int]:
        special = self._vocab.special
        if self._cut is None or not any(s in text for s in special):
            return self._plain(text)
        return [i for part in self._cut(text) for i in ([special[part]] if part in special else self._plain(part))]

    def decode(self, ids: list[int]) -> bytes:
        """The text as UTF-8; bytes that are none become replacement characters."""
        joined = b"".join(map(self._vocab.bytes.__getitem__, ids))
        return joined.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each Python worker and vocabulary, so that its merged words outlive a task."""
    return Codec(path)


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array<int>) of every text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, "text"):
            ids = [codec(path).encode(t) for t in group.column("text").to_pylist()]
            yield from pa.table({"key": group.column("key"), "ids": pa.array(ids, pa.list_(pa.int32()))}).to_batches()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {dict(rows.dtypes)['key']}, ids array<int>"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(tokens: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of every list of ids; a null list is the empty text, an id outside the vocabulary an error."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(x or []).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "text": pa.array(texts, pa.string())})

    rows = tokens.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = f"key {dict(rows.dtypes)['key']}, text string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the text decoded from them."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(map(str, range(len(vocabulary(path).bytes))))
        for group in text_groups(batches):
            counts, digests, decoded = [], [], []
            for text in group.column("text").to_pylist():
                ids = codec(path).encode(text)
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec(path).decode(ids)).hexdigest())
            yield from pa.table(
                {
                    "doc_id": group.column("doc_id"),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(digests, pa.string()),
                    "decoded_sha256": pa.array(decoded, pa.string()),
                }
            ).to_batches()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
