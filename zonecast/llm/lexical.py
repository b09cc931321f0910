"""Ranked lexical search (operator 11).

Method: Best Position Algorithm.  Each term of an item has an impact list: the documents that hold it, by falling impact.  Lists are read from the
top in parallel; each new document is looked up in all other lists by direct access, which gives its whole score and marks its position in every
list as seen.  A list's best position is the end of the run of seen positions from its top, however they were seen.  No unseen document can score
more than the sum of the impacts at the best positions; the search stops once that is strictly below the k-th best score, so
that ties are still settled by id.

Scale: documents are read once for each group of items (``GROUP_TERMS`` terms, one group unless the items are many) and become blocks of postings of
the items' terms, stored in the shared folder; no text is shuffled.  Counts of documents and terms are sums over blocks, document frequencies one array
for each task, added up in a bounded second step.  A task searches its blocks one after the other and carries each item's k best
along, so later blocks mostly stop at once; its k best are exact, and the best of all tasks are ranked by a window.  What is sent to tasks is the
group's vocabulary, bounded by ``GROUP_TERMS`` and the terms of one item.

Null texts have no terms.  Each row of documents is a document, also where rows share a doc_id; a null doc_id ranks last among equal scores.  Equal
(item_id, text) rows are one item; other rows that share an item_id are one item with the terms of all.  A null item_id is an id like
any other.  Items without a hit have no rows, and an empty table on either side gives none.  Other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_rows, store
from .tokens import text_groups

K = 10
#: About so many (item, term) rows are searched in one pass over the documents.
GROUP_TERMS = 200_000
#: A block ends at so many documents, or so many postings.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 500_000
#: Positions read from each list at first; twice as many each time.
FIRST_STEP = 16
ADDERS = 16
#: Letters and digits of ASCII and all bytes of other characters stay, A-Z are lowered, all else parts terms.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term and q (how often the item has it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            for key, text in zip(group.column("item_id").to_pylist(), group.column("text").to_pylist()):
                own = [t.decode() for t in terms(text)]
                if own:
                    yield pa.RecordBatch.from_pydict({"item_id": pa.array([key] * len(own), pa.int64()), "term": pa.array(own, pa.string())})

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    return map_rows(rows, run, "item_id bigint, term string").groupBy("item_id", "term").agg(F.count("*").alias("q"))


_BLOCK = "ids binary, missing binary, n binary, doc binary, term binary, tf binary, with_terms bigint, all_terms bigint"


def blocks(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Blocks of documents that have a term of the vocabulary: ids, lengths and postings; and the counts of all documents read."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    wide = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        held: list[tuple] = []
        size, postings, with_terms, all_terms = 0, 0, 0, 0

        def block() -> pa.RecordBatch:
            starts = np.cumsum([0, *(len(h[0]) for h in held[:-1])]) if held else []
            cols = [np.concatenate([h[k] + (s if k == 3 else 0) for h, s in zip(held, starts)] or [np.zeros(0)]) for k in range(6)]
            kinds = (np.int64, np.bool_, np.int64, np.int32, np.int32, np.int64)
            raw = {c: [x.astype(t).tobytes()] for c, x, t in zip(("ids", "missing", "n", "doc", "term", "tf"), cols, kinds)}
            return pa.RecordBatch.from_pydict(raw | {"with_terms": [with_terms], "all_terms": [all_terms]})

        for group in text_groups(batches):
            split = [terms(t) for t in group.column("text").to_pylist()]
            n = np.array([len(t) for t in split], np.int64)
            with_terms, all_terms = with_terms + int((n > 0).sum()), all_terms + int(n.sum())
            found = np.concatenate([np.fromiter((get(t, -1) for t in own), np.int64, len(own)) for own in split])
            doc = np.repeat(np.arange(len(split)), n)[found >= 0]
            both, tf = np.unique(doc * wide + found[found >= 0], return_counts=True)
            doc, term = both // wide, both % wide
            own, doc = np.unique(doc, return_inverse=True)  # documents without such a term need no place
            ids = group.column("doc_id").combine_chunks()
            missing = ids.is_null().to_numpy(zero_copy_only=False)[own]
            held.append((ids.fill_null(0).to_numpy()[own], missing, n[own], doc, term, tf))
            size, postings = size + len(own), postings + len(tf)
            if size >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield block()
                held, size, postings, with_terms, all_terms = [], 0, 0, 0, 0
        if with_terms:
            yield block()

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run, _BLOCK)


def frequencies(stored: DataFrame, wide: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide, np.int64)
        for batch in batches:
            for raw in batch.column("term"):
                total += np.bincount(np.frombuffer(raw.as_buffer(), np.int32), minlength=wide)
        if total.any():
            yield pa.RecordBatch.from_pydict({"df": [total.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide, np.int64)
        for batch in batches:
            for raw in batch.column("df"):
                total += np.frombuffer(raw.as_buffer(), np.int64)
        yield pa.RecordBatch.from_pydict({"df": [total.tobytes()]})

    each = map_rows(stored.select("term"), count, "df binary").repartition(ADDERS).mapInArrow(add, "df binary").collect()  # ADDERS rows
    return sum((np.frombuffer(r["df"], np.int64) for r in each), np.zeros(wide, np.int64))


class Block:
    """The impact lists of some documents and, for direct access, each document's postings with their positions in the lists."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
            m = 25 + np.array([75 * int(x) * n_docs // n_terms for x in n], np.int64)
        else:
            m = 25 + 75 * n * n_docs // max(1, n_terms)
        self.ids, self.missing, self.doc, self.term = ids, missing, doc, term
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        self.starts = np.searchsorted(doc, np.arange(len(ids) + 1))  # postings are in the order of documents
        order = np.lexsort((doc, -self.impact, term))
        self.list_doc, self.list_impact = doc[order], self.impact[order]
        self.names, self.list_starts = np.unique(term[order], return_index=True)
        self.list_ends = np.append(self.list_starts[1:], len(order))
        self.position = np.empty(len(order), np.int64)
        self.position[order] = np.arange(len(order)) - np.repeat(self.list_starts, self.list_ends - self.list_starts)

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of ``docs``, and for each the number of its document in ``docs``."""
        first, count = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        which = np.repeat(np.arange(len(docs)), count)
        return np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count), which


class Best:
    """An item's k best so far: scores and documents, best first."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.missing, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        known = scores > 0
        if len(self.scores) == self.k:
            known &= scores >= self.scores[-1]
        if known.any():
            scores, missing, ids = (np.concatenate([a, b[known]]) for a, b in ((self.scores, scores), (self.missing, missing), (self.ids, ids)))
            top = np.lexsort((ids, missing, -scores))[: self.k]
            self.scores, self.missing, self.ids = scores[top], missing[top], ids[top]

    @property
    def least(self) -> int:
        """What a document has to reach: the k-th best score, or any score above 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1


def best_positions(block: Block, names: np.ndarray, weights: np.ndarray, slot: np.ndarray, best: Best) -> int:
    """Adds to ``best`` what the block has for an item (its terms and their weights).  ``slot`` is a -1 for every term of the
    vocabulary, and is left so.  Gives the number of documents that were looked up."""
    at = np.searchsorted(block.names, names)
    there = (at < len(block.names)) & (block.names[np.minimum(at, len(block.names) - 1)] == names) if len(block.names) else np.zeros(len(names), bool)
    there &= weights > 0
    at, weights, names = at[there], weights[there], names[there]
    if not len(at):
        return 0
    starts, lengths = block.list_starts[at], block.list_ends[at] - block.list_starts[at]
    offsets = np.cumsum(lengths) - lengths
    seen = np.zeros(int(lengths.sum()), bool)  # positions of all lists, one list after the other
    known = np.zeros(len(block.ids), bool)
    depth = np.zeros(len(at), np.int64)  # best positions: how many from the top are seen without a gap
    slot[names] = np.arange(len(names))
    step, looked_up = FIRST_STEP, 0
    while True:
        open_ = depth < lengths
        at_best = starts + np.maximum(depth - 1, 0)  # before the first round: the top itself
        threshold = int((weights * block.list_impact[at_best])[open_].sum())
        if threshold < best.least:
            break
        new = [block.list_doc[s + d : s + min(d + step, n)] for s, d, n in zip(starts.tolist(), depth.tolist(), lengths.tolist()) if d < n]
        docs = np.unique(np.concatenate(new))
        docs = docs[~known[docs]]
        known[docs] = True
        looked_up += len(docs)
        places, which = block.postings(docs)
        of = slot[block.term[places]]
        own = of >= 0
        places, which, of = places[own], which[own], of[own]
        seen[offsets[of] + block.position[places]] = True
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, which, weights[of] * block.impact[places])
        best.add(scores, block.missing[docs], block.ids[docs])
        for i, (o, d, n) in enumerate(zip(offsets.tolist(), depth.tolist(), lengths.tolist())):
            if d < n:
                rest = seen[o + d : o + n]
                gap = int(rest.argmin())
                depth[i] = d + gap if not rest[gap] else n
        step *= 2
    slot[names] = -1
    return looked_up


def _search_group(docs: DataFrame, of_items: list, k: int) -> DataFrame:
    """item (its number), rank, doc_id, score for the collected rows (item number, term, q)."""
    vocabulary: dict[bytes, int] = {}
    lists: dict[int, list[tuple[int, int]]] = {}
    for number, term, q in of_items:
        lists.setdefault(number, []).append((vocabulary.setdefault(term.encode(), len(vocabulary)), q))
    wide = len(vocabulary)
    stored = store(blocks(docs, vocabulary), "postings")
    total = stored.agg(F.sum("with_terms"), F.sum("all_terms")).first()
    n_docs, n_terms = int(total[0] or 0), int(total[1] or 0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequencies(stored, wide)], np.int64)
    items = []
    for number, own in lists.items():
        names, q = (np.array(x, np.int64) for x in zip(*sorted(own)))
        items.append((number, names, q * weight[names]))
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in shared.value]
        slot = np.full(wide, -1, np.int64)
        kinds = {"ids": np.int64, "missing": np.bool_, "n": np.int64, "doc": np.int32, "term": np.int32, "tf": np.int64}
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*(np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in kinds.items()), n_docs, n_terms)
                for (_, names, weights), own in zip(shared.value, best):
                    best_positions(block, names, weights, slot, own)
        out = [(number, None if gone else int(d), int(s)) for (number, _, _), own in zip(shared.value, best) for s, gone, d in zip(own.scores, own.missing, own.ids)]
        if out:
            item, doc, score = zip(*out)
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int64()), "doc_id": pa.array(doc, pa.int64()), "score": pa.array(score, pa.int64())})

    hits = map_rows(stored.drop("with_terms", "all_terms"), run, "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, group_terms: int = GROUP_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    wanted = store(item_terms(items), "item-terms")
    groups = max(1, -(-wanted.count() // group_terms))
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in range(groups):
        rows = wanted.where(F.col("part") == part).select("item_id", "term", "q").collect()  # about ``group_terms`` rows
        ids = {key: i for i, key in enumerate(dict.fromkeys(r["item_id"] for r in rows))}
        if not ids:
            continue
        found = _search_group(docs, [(ids[r["item_id"]], r["term"], r["q"]) for r in rows], k)
        named = spark.createDataFrame([(key, i) for key, i in ids.items()], "item_id bigint, item bigint")
        # the group's item ids: no more rows than it has terms
        out = out.union(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


_SPLIT = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS t FROM documents),
size AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_SPLIT}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
score AS (
  SELECT q.item_id, size.r, size.doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (r), total GROUP BY ALL
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
