"""Quality classifier (operator 8).

Method: supervised subword embeddings.  Every word and each of its character n-grams hashes to a row of a table of vectors; a word
is the mean of its rows, a document the mean of its words, and a softmax over two classes follows.  Table and output layer
are learned together by stochastic gradient descent in numpy.

The model is fitted on a bounded sample (``SAMPLE`` labelled documents of the learning folds, whole texts) in one task, as
the order of the steps matters; it is a few hundred kilobytes and is broadcast.  Scoring is one scan without a shuffle.
As the output is linear in the word vectors, a word enters a document's score through one number, which each Python
worker keeps.

Only the text is an input.  Null, empty and blank texts have no words: they get the score of the bias alone.  Null ids count as
held out.  Without any usable label the score is 0.5.  Repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows
from .samples import held_out, labelled
from .tokens import text_groups
from .words import mixed, words

SAMPLE, BUCKETS, WIDTH, EPOCHS, RATE, SEED = 6000, 1 << 16, 8, 4, 1.0, 17
GRAMS = (2, 3, 4)
THRESHOLD = 0.3
KEPT = 200_000
#: Words whose features are drawn at a time, and documents whose features are laid end to end for learning.
WORDS_AT_ONCE, DOCUMENTS_AT_ONCE = 1 << 14, 256
#: Holds a space, so no word equals it.
AGAIN = b"the same again"


def features(distinct: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word index, table row) of every feature of every word: the word itself and the n-grams of ``<word>``."""
    sizes = np.array([len(w) + 2 for w in distinct])
    raw = np.frombuffer(b"".join([b"<" + w + b">" for w in distinct]), np.uint8).astype(np.uint64) + np.uint64(1)
    owner, starts = np.repeat(np.arange(len(distinct)), sizes), np.cumsum(sizes) - sizes
    rows, owners, gram = [], [], np.zeros(len(raw), np.uint64)
    # a word's own hash: its bytes weighted by powers that depend on their place
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    own = np.add.reduceat(raw * mixed(place.astype(np.uint64) + np.uint64(77)), starts)
    rows.append(mixed(own))
    owners.append(np.arange(len(distinct)))
    for n in range(1, max(GRAMS) + 1):
        keep = len(raw) - n + 1
        if keep <= 0:
            break
        gram = gram[:keep] * np.uint64(0x100000001B3) + raw[n - 1 :]
        if n in GRAMS:
            inside = owner[:keep] == owner[n - 1 :]
            rows.append(mixed(gram[inside] + np.uint64(n << 56)))
            owners.append(owner[:keep][inside])
    return np.concatenate(owners), (np.concatenate(rows) & np.uint64(buckets - 1)).astype(np.int64)


def tokens(text: str) -> list[bytes]:
    """The words of a text and, for every word that repeats the one before it, a mark (the one word pair that is told apart)."""
    own = words(text, lower=False)
    return own + [AGAIN] * sum(map(eq, own, own[1:]))


class Model:
    """Vectors of the hashed features, output weights and biases."""

    def __init__(self, table: np.ndarray, out: np.ndarray, bias: np.ndarray):
        self.table, self.out, self.bias = table, out, bias
        self._line = table @ (out[:, 1] - out[:, 0])
        self._known: dict[bytes, float] = {}

    @staticmethod
    def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table and their weights in the document's mean."""
        counts: dict[bytes, int] = {}
        for w in tokens(text):
            counts[w] = counts.get(w, 0) + 1
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0)
        owner, row = features(list(counts))
        share = np.array(list(counts.values()), float) / sum(counts.values())
        weight = (share / np.bincount(owner, minlength=len(counts)))[owner]
        unique, inverse = np.unique(row, return_inverse=True)
        return unique, np.bincount(inverse, weights=weight)

    @classmethod
    def _documents(cls, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``_document`` of all texts.  All are held while learning: in narrow types, and in few large arrays that are given back whole."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(texts), DOCUMENTS_AT_ONCE):
            rows, weights = zip(*[cls._document(t) for t in texts[at : at + DOCUMENTS_AT_ONCE]])
            ends = np.cumsum([len(r) for r in rows])[:-1]
            flat = np.concatenate([r.astype(np.min_scalar_type(BUCKETS - 1)) for r in rows])
            out += zip(np.split(flat, ends), np.split(np.concatenate([w.astype(np.float32) for w in weights]), ends))
        return out

    @classmethod
    def train(cls, texts: list[str], labels: list[int]) -> "Model":
        rng = np.random.default_rng(SEED)
        table, out, bias = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)), np.zeros((WIDTH, 2)), np.zeros(2)
        seen = cls._documents(texts)
        steps, total = 0, EPOCHS * len(seen)
        for _ in range(EPOCHS if len(seen) else 0):
            for i in rng.permutation(len(seen)):
                rows, weight = seen[i][0].astype(np.intp), seen[i][1].astype(float)
                rate = RATE * (1 - steps / total)
                steps += 1
                hidden = weight @ table[rows]
                z = hidden @ out + bias
                p = np.exp(z - z.max())
                wrong = p / p.sum()
                wrong[labels[i]] -= 1
                back = out @ wrong
                out -= rate * np.outer(hidden, wrong)
                bias -= 0.1 * rate * wrong
                # a document's weights are small; scaled by their sum of squares a step has a fixed effect on its vector
                table[rows] -= (rate * 0.2 / max(weight @ weight, 1e-9)) * weight[:, None] * back
        return cls(table, out, bias)

    def dump(self) -> bytes:
        to = io.BytesIO()
        np.savez_compressed(to, table=self.table.astype(np.float32), out=self.out, bias=self.bias)
        return to.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> "Model":
        got = np.load(io.BytesIO(raw))
        return cls(got["table"].astype(float), got["out"], got["bias"])

    def scores(self, texts: list[str]) -> list[float]:
        """Probability of label 1."""
        cut, known = [tokens(t) for t in texts], self._known
        if len(known) > KEPT:
            known.clear()
        new = list(set().union(*cut).difference(known))
        for at in range(0, len(new), WORDS_AT_ONCE):
            owner, row = features(part := new[at : at + WORDS_AT_ONCE])
            known.update(zip(part, (np.bincount(owner, weights=self._line[row]) / np.bincount(owner)).tolist()))
        base = float(self.bias[1] - self.bias[0])
        z = np.array([base + sum(map(known.__getitem__, c)) / (len(c) or 1) for c in cut])
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The model learned from ``labels.quality``, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["rank"], r["doc_id"], r["text"], r["label"]) for b in batches for r in b.to_pylist())
        yield pa.RecordBatch.from_pydict({"model": [Model.train([r[2] for r in rows], [r[3] for r in rows]).dump()]})

    got = map_rows(labelled(docs, labels, sample).repartition(1), run, "model binary").collect()
    return bytes(got[0]["model"]) if got else Model.train([], []).dump()


_loaded: dict[int, Model] = {}


def score(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; the columns of ``docs`` pass through, other than those two."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    rows = docs.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = Model.load(shared.value)
        for group in text_groups(batches, " text"):
            s = _loaded[key].scores(group.column(" text").to_pylist())
            group = group.drop_columns([" text"]).append_column("score", pa.array(s, pa.float64()))
            yield from group.append_column("predicted", pa.array([int(x >= threshold) for x in s], pa.int32())).to_batches()

    fields = rows.schema.add("score", "double").add("predicted", "integer")
    return map_rows(rows.withColumn(" text", F.col("text").cast("string")), run, fields)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # held out: crc32(doc_id) mod 5 is 0
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier doesn't reject."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).where("predicted = 1").select(*[f"`{c}`" for c in docs.columns])
