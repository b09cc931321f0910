"""Quality rules by line labelling (operator 6).

Method: a linear-chain conditional random field marks every line of a document as content or boilerplate; Viterbi decoding
finds the best sequence of marks, and the share of words in content lines decides whether the document is kept.  The field is
learned by gradient steps on its conditional likelihood (forward and backward sums) from a bounded sample of ``SAMPLE``
labelled documents, whole texts, outside the held-out fold: lines of documents with quality 1 count as content, those of quality 0 as
boilerplate.  Beside it stand the base counts, which fail a document on their own.

All per-document work is one scan without a shuffle; the model is a few dozen numbers.

Null, empty and blank texts have no words: they fail the base rule.  Ties of the decoding fall to content.  Repeated rows get equal
results; without any usable label all lines are content.  Other columns of the input are ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows
from .samples import labelled
from .tokens import text_groups
from .words import hashes, windows, words

SAMPLE, EPOCHS, RATE, SEED = 3000, 6, 0.05, 23
#: A document is kept if so large a part of its words stands in content lines.
SHARE = 0.5
MIN_WORDS, WINDOW, MAX_REPEAT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"

FEATURES = (
    "any", "one to three words", "over fifteen words", "a tenth symbols", "a quarter symbols", "mostly capitals", "digits",
    "earlier line", "half the words repeat", "nine in ten words repeat", "words end in the same mark", "no final mark",
    "starts with a capital", "long words", "no function words",
)


def line_features(line: str, earlier: bool) -> list[int]:
    """Indices of the features that hold."""
    own = line.split()
    n, chars = len(own), len(line)
    if not n:
        return []
    out = [0]
    if n <= 3:
        out.append(1)
    elif n > 15:
        out.append(2)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols * 10 > n * 4:
        out.append(3)
        if symbols > n * 0.8:
            out.append(4)
    if sum(w.isupper() for w in own) * 2 > n:
        out.append(5)
    if sum(map(line.count, "0123456789")) * 10 > chars:
        out.append(6)
    if earlier:
        out.append(7)
    distinct = len(set(own))
    if n > 5 and distinct * 2 < n:
        out.append(8)
        if distinct * 10 < n:
            out.append(9)
    if n > 3:
        ends = [w[-1] for w in own if not w[-1].isalnum()]
        if len(ends) * 2 > n:
            out.append(10)
    if line.rstrip()[-1:].isalnum():
        out.append(11)
    if own[0][:1].isupper():
        out.append(12)
    if chars > 12 * n:
        out.append(13)
    if n > 5 and not any(len(w) <= 3 for w in own):
        out.append(14)
    return out


def lines_of(text: str) -> tuple[list[list[int]], list[int], int]:
    """Features and number of words of each line with a word; number of lines equal to an earlier one."""
    seen: set[str] = set()
    marks, sizes, repeated = [], [], 0
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            earlier = line in seen
            repeated += earlier
            seen.add(line)
            marks.append(line_features(line, earlier))
            sizes.append(n)
    return marks, sizes, repeated


class ChainField:
    """Two labels, 1 content and 0 boilerplate.  ``weights`` favour content; ``moves[a, b]`` scores label b after a."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros(len(FEATURES)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def decode(self, marks: list[list[int]]) -> list[int]:
        """The best sequence of labels (Viterbi)."""
        w, ((m00, m01), (m10, m11)) = self.weights.tolist(), self.moves.tolist()
        bad = good = 0.0
        back = []
        for k, active in enumerate(marks):
            e = sum(map(w.__getitem__, active))
            if k:
                from_bad, from_good = bad + m01 > good + m11, bad + m00 > good + m10
                back.append((from_bad, from_good))
                bad, good = max(bad + m00, good + m10), max(bad + m01, good + m11)
            good += e
        label = int(good >= bad)
        out = [label]
        for bad_before_good, bad_before_bad in reversed(back):
            label = int(not (bad_before_good if label else bad_before_bad))
            out.append(label)
        return out[::-1] if marks else []

    def _marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(line is content) and the expected number of each move."""
        n, moves = len(e), np.exp(self.moves)
        local = np.stack([np.ones(n), np.exp(np.clip(e, -30, 30))], 1)
        ahead, behind = np.empty((n, 2)), np.ones((n, 2))
        ahead[0] = local[0] / local[0].sum()
        for i in range(1, n):
            x = (ahead[i - 1] @ moves) * local[i]
            ahead[i] = x / x.sum()
        for i in range(n - 2, -1, -1):
            x = moves @ (local[i + 1] * behind[i + 1])
            behind[i] = x / x.sum()
        both = ahead * behind
        expected = np.zeros((2, 2))
        for i in range(n - 1):
            x = ahead[i][:, None] * moves * (local[i + 1] * behind[i + 1])
            expected += x / x.sum()
        return both[:, 1] / both.sum(1), expected

    @classmethod
    def train(cls, sequences: list[list[list[int]]], labels: list[int]) -> "ChainField":
        field, rng = cls(), np.random.default_rng(SEED)
        seen = []
        for marks in sequences:
            x = np.zeros((len(marks), len(FEATURES)))
            for i, active in enumerate(marks):
                x[i, active] = 1
            seen.append(x)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(seen)):
                x, y = seen[i], labels[i]
                if not len(x):
                    continue
                p, expected = field._marginals(x @ field.weights)
                scale = RATE / len(x) ** 0.5
                field.weights += scale * (x.T @ (y - p)) - 1e-4 * field.weights
                observed = np.zeros((2, 2))
                observed[y, y] = len(x) - 1
                field.moves += scale * (observed - expected) - 1e-2 * field.moves
        return field


def repeat_words(own: list[bytes], n: int = WINDOW) -> int:
    """Words inside an ``n``-word window that stands twice or more in the text."""
    grams = windows(hashes(own), n)
    if len(grams) < 2:
        return 0
    _, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[inverse] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(own) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + n, -1)
    return int((np.cumsum(edge) > 0).sum())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[float], list[float]]:
    """Weights and moves of the field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["rank"], r["doc_id"], r["text"], r["label"]) for b in batches for r in b.to_pylist())
        field = ChainField.train([lines_of(r[2])[0] for r in rows], [r[3] for r in rows])
        yield pa.RecordBatch.from_pydict({"weights": [field.weights.tolist()], "moves": [field.moves.ravel().tolist()]})

    got = map_rows(labelled(docs, labels, sample).repartition(1), run, "weights array<double>, moves array<double>").collect()
    return (list(got[0]["weights"]), list(got[0]["moves"])) if got else ([0.0] * len(FEATURES), [0.0] * 4)


RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean,"
    " content_share double, kept boolean"
)


def judge(text: str, field: ChainField, share: float = SHARE) -> tuple:
    """The columns of ``RESULT`` for one text."""
    own = words(text, lower=False)
    marks, sizes, repeated_lines = lines_of(text)
    repeated = repeat_words(own)
    failed = len(own) < MIN_WORDS or 100 * repeated > MAX_REPEAT * len(own)
    content = sum(n for n, label in zip(sizes, field.decode(marks)) if label) / len(own) if own else 0.0
    chars = len(text) - sum(map(text.count, BLANK))
    return len(own), chars, sum(map(text.count, SYMBOLS)), repeated_lines, repeated, failed, content, not failed and content >= share


def apply(docs: DataFrame, weights: list[float], moves: list[float], share: float = SHARE) -> DataFrame:
    """``docs`` with the columns of ``RESULT``; columns of those names in the input are replaced."""
    empty = docs.sparkSession.createDataFrame([], RESULT).schema
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in empty.names}]
    rows = docs.select(*[f"`{c}`" for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = ChainField(np.array(weights), np.array(moves).reshape(2, 2))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        for group in text_groups(batches, " text"):
            found = zip(*(judge(t, field, share) for t in group.column(" text").to_pylist()))
            group = group.drop_columns([" text"])
            for name, kind, values in zip(empty.names, kinds, found):
                group = group.append_column(name, pa.array(values, kind))
            yield from group.to_batches()

    schema = rows.schema
    for f in empty:
        schema = schema.add(f)
    return map_rows(rows.withColumn(" text", F.col("text").cast("string")), run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return apply(docs, *train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass.  As in the query, the field learns from the whole documents table: of what reaches the stage, earlier
    stages have taken most lines of boilerplate away."""
    whole = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    judged = apply(docs, *train(whole, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return judged.where("kept").select(*[f"`{c}`" for c in docs.columns])
