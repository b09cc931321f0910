"""Repeated passages by sparse suffix arrays (operator 9).

Method: of all suffixes of all texts (in words) only those at content-selected positions are kept: the minimisers, positions whose
``GRAM``-word hash is the least of some window of ``SPAN`` neighbours.  A passage of ``GRAM + SPAN - 1`` = 50 words or more always holds one,
and holds the same ones wherever it stands.  The suffixes are sorted; neighbours in that order are compared and their match is
extended to the left and to the right.  A chain of matching neighbours is one passage with several occurrences; all but the
first (by doc_id, then place) are repeats.

Scale: only positions (about one word in 18) are shuffled at first; those whose gram occurs once drop out by a count.  Texts without a place
that is left never enter a shuffle, so long as the others are few enough for their hashes to be sent (``SENT_IDS``).
The rest carry the hashed words around them, as far as the next selected position can be, so that the pieces of
longer matches join up.  They are range-partitioned by the whole suffix, then document, so a passage that a third of all documents share is
spread over many tasks; each task streams its sorted rows and keeps one row and a few dozen earlier occurrences (``_Chain``).  What lies
across the borders of two tasks is settled from two rows for each of them.

A match is the same words after lower-casing; only matches of ``MIN_WORDS`` or more count.  Repeats within one document count too.  Null
and short texts have none.  Rows with equal doc_id and text are one document; documents without an id sort first.  Other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import among, documents, few, map_rows, passing, shuffle_partitions, store
from .tokens import text_groups
from .words import hashes, windows, words

GRAM, SPAN, MIN_WORDS = 16, 35, 50
LEFT, RIGHT = SPAN - 1, GRAM + SPAN - 1
NO_ID = -(1 << 63)


def selected(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the minimisers and their grams' hashes."""
    grams = windows(h, GRAM)
    if len(grams) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.unique(np.lib.stride_tricks.sliding_window_view(grams, SPAN).argmin(axis=1) + np.arange(len(grams) - SPAN + 1))
    return at, grams[at]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("th"), text.alias("text"))


def positions(docs: DataFrame) -> DataFrame:
    """gram, d, th, pos of every selected position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            found = [selected(hashes(words(t))) for t in group.column("text").to_pylist()]
            count = [len(at) for at, _ in found]
            d, th = (np.repeat(group.column(c).to_numpy(), count) for c in ("d", "th"))
            pos, gram = (np.concatenate(x) for x in zip(*found))
            yield from pa.table({"gram": gram.view(np.int64), "d": d, "th": th, "pos": pos.astype(np.int64)}).to_batches()

    return map_rows(docs, run, "gram bigint, d bigint, th bigint, pos bigint")


def suffixes(docs: DataFrame) -> DataFrame:
    """Selected positions whose gram occurs more than once, with hashed words to the left (nearest last) and to the right."""
    keyed = _keyed(docs)
    drawn = store(positions(keyed), "positions")
    often = store(drawn.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
    kept = drawn.join(F.broadcast(often) if few(often) else often, "gram").groupBy("d", "th").agg(F.collect_set("pos").alias("places"))  # places of one document
    kept = store(kept, "places")
    both = among(keyed, kept.select("th"), "th").join(kept, ["d", "th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            for d, th, text, places in zip(*(group.column(c).to_pylist() for c in ("d", "th", "text", "places"))):
                h, pos = hashes(words(text)), np.sort(np.array(places, np.int64))
                small = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # 0 is the edge of the text
                padded = np.concatenate([np.zeros(LEFT, np.uint32), small, np.zeros(RIGHT, np.uint32)]).astype(">u4")
                around = np.lib.stride_tricks.sliding_window_view(padded, LEFT + RIGHT)
                for start in range(0, len(pos), 5000):
                    own = pos[start : start + 5000]
                    rows = around[own]
                    yield pa.RecordBatch.from_pydict(
                        {"ahead": [r.tobytes() for r in rows[:, LEFT:]], "d": pa.array([d] * len(own), pa.int64()), "th": pa.array([th] * len(own), pa.int64()),
                         "pos": own, "behind": [r.tobytes() for r in rows[:, :LEFT]]}
                    )

    # rows with equal id and text are one document
    return map_rows(both.dropDuplicates(["d", "th"]), run, "ahead binary, d bigint, th bigint, pos bigint, behind binary")


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matching words to the left and to the right, row by row."""
    same = (a == b) & (a != 0)
    left, right = same[:, LEFT - 1 :: -1] if LEFT else same[:, :0], same[:, LEFT:]
    reach = lambda x: np.where(x.all(1), x.shape[1], (~x).argmax(1))
    return reach(left), reach(right)


def _whole(left: int, right: int) -> bool:
    """Whether so many words to either side of a suffix are a passage."""
    return left + right >= MIN_WORDS and right >= GRAM


class _Chain:
    """Matching neighbours: the occurrences that a later suffix can still repeat, as (key, left, right) with the words in which all
    suffixes from there to the last one agree.  Keys and agreement grow towards the newest, and of equal agreement only the first
    occurrence is held, so there are at most LEFT + RIGHT - MIN_WORDS + 1 of them."""

    def __init__(self, held: list[tuple] = ()):
        self.held = list(held)

    def follow(self, left: int, right: int) -> None:
        """Goes on by a neighbour's match; what shares no whole passage with the next suffix is dropped."""
        old, self.held = self.held, []
        for key, x, y in old:
            x, y = min(x, left), min(y, right)
            if _whole(x, y) and not (self.held and self.held[-1][1:] == (x, y)):
                self.held.append((key, x, y))

    def add(self, key: tuple, left: int = LEFT, right: int = RIGHT) -> list[tuple]:
        """Takes a suffix, or what else agrees so far with the last one; the repeats it settles: of it by later keys, and its own."""
        out = []
        while self.held and self.held[-1][0] > key:
            later, x, y = self.held.pop()
            out.append((*later, later[2] - x, later[2] + y, key[0]))
        if self.held:
            _, x, y = self.held[-1]
            out.append((*key, key[2] - x, key[2] + y, self.held[0][0][0]))
        if not (self.held and self.held[-1][1:] == (left, right)):
            self.held.append((key, left, right))
        return out


_COLUMNS = ("d", "th", "pos", "start", "end", "source", "part", "side", "ahead", "behind", "chain")
_REPEAT = "d bigint, th bigint, pos bigint, start bigint, end bigint, source bigint"
#: chain: the words to the left and right in which all suffixes of the range agree, whether one chain is the whole range, and then
#: (d, th, pos, left, right) of occurrences in the chain at this edge, with their agreement up to the edge.  At the first suffix: those
#: before every earlier key of the range.  At the last: those that a later suffix can still repeat.
_EDGE = "part int, side int, ahead binary, behind binary, chain array<bigint>"


def _table(rows: list[tuple], edges: list[tuple] = ()) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()] * 2 + [pa.list_(pa.int64())]
    cols = list(zip(*[(*r, *[None] * 5) for r in rows], *[(*e[:3], *[None] * 3, *e[3:]) for e in edges])) or [()] * 11
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(_COLUMNS))


def _match(rows: list[tuple]) -> tuple[list[bool], list[int], list[int]]:
    """Of every two neighbours among (ahead, behind, ...): whether they share a passage, and its words to either side."""
    width = np.frombuffer(b"".join(r[1] + r[0] for r in rows), ">u4").reshape(len(rows), -1)
    left, right = _extend(width[:-1], width[1:])
    return ((left + right >= MIN_WORDS) & (right >= GRAM)).tolist(), left.tolist(), right.tolist()


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of one range.  Gives repeats, and a row for the first and for the last suffix of the range."""
    part = TaskContext.get().partitionId()
    first = held = None  # held: the last row, which still waits for its next neighbour
    before: tuple | None = None  # the match of the row before it, if they match
    chain, whole, chains = _Chain(), (LEFT, RIGHT), 0
    opening: list[tuple] = []

    def settle(row: tuple, before: tuple | None) -> list[tuple]:
        nonlocal whole, chains
        key = row[2:5]
        if before is None:
            chains += 1
            chain.held = []
        else:
            chain.follow(*before)
            whole = min(whole[0], before[0]), min(whole[1], before[1])
        if chains == 1 and _whole(*whole) and not (opening and opening[-1][0] < key):
            if opening and opening[-1][1:] == whole:
                opening.pop()  # repeats this one as far as the edge agrees
            opening.append((key, *whole))
        return chain.add(key)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("ahead", "behind", "d", "th", "pos"))))
        first = first or rows[0]
        rows = ([held] if held else []) + rows
        out: list[tuple] = []
        for row, hit, left, right in zip(rows, *_match(rows)):
            out += settle(row, before)
            before = (left, right) if hit else None
        held = rows[-1]
        yield _table(out)
    if held:
        out = settle(held, before)
        edges = ((0, first, opening), (1, held, chain.held))
        flat = [[*whole, int(chains == 1), *(x for key, left, right in own for x in (*key, left, right))] for _, _, own in edges]
        yield _table(out, [(*r[2:5], part, side, *r[:2], f) for (side, r, _), f in zip(edges, flat)])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats at the borders of ranges: the last suffix of each against the first of the next."""
    edges = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["part"], r["side"]))
    rows = [tuple(r[c] for c in ("ahead", "behind", "d", "th", "pos")) for r in edges]
    out: list[tuple] = []

    def entries(edge: dict) -> list[tuple]:
        flat = edge["chain"][3:]
        return [(tuple(flat[i : i + 3]), *flat[i + 3 : i + 5]) for i in range(0, len(flat), 5)]

    carried = _Chain()  # the occurrences before the border that a suffix behind it can repeat
    for k in range(0, len(edges), 2):
        left, right, one = edges[k]["chain"][:3]
        (hit,), (x,), (y,) = _match([rows[k - 1], rows[k]]) if k else ([False], [0], [0])
        carried.follow(x, y) if hit else carried.held.clear()
        for key, a, b in carried.held:
            for other, c, d in entries(edges[k]):
                if key != other and _whole(min(a, c), min(b, d)):
                    source, later = sorted((key, other))
                    out.append((*later, later[2] - min(a, c), later[2] + min(b, d), source[0]))
        if one:
            carried.follow(left, right)
        else:
            carried.held.clear()
        for entry in entries(edges[k + 1]):
            carried.add(*entry)  # repeats between ranges are settled by their opening
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*out)) or [()] * 6)], names=list(_COLUMNS[:6]))


def repeats(docs: DataFrame) -> DataFrame:
    """Repeated passages: d and th (the document), start and end (words), source (doc_id of an earlier occurrence); merged where
    they overlap or touch."""
    spark = docs.sparkSession
    order = ["ahead", "d", "th", "pos"]
    rows = store(suffixes(docs), "suffixes").repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    found = store(rows.mapInArrow(_compare_sorted, f"{_REPEAT}, {_EDGE}"), "repeats")
    borders = found.where("part is not null").repartition(1).mapInArrow(_across, _REPEAT)  # two rows for each range
    spans = found.where("part is null").select("d", "th", "pos", "start", "end", "source").union(borders)
    by = Window.partitionBy("d", "th").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = spans.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(by))
    return island.groupBy("d", "th", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("source").alias("source"))


def _id(column: str):
    return F.when(F.col(column) != NO_ID, F.col(column))


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words, source_doc_id of every repeated passage."""
    return repeats(docs).select(
        _id("d").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"), _id("source").alias("source_doc_id"),
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans (ascending, apart), and without the white space after each span."""
    starts, ends = zip(*(m.span() for m in _WORD.finditer(text)))
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = starts[b] if b < len(starts) else len(text)
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (and ``n_chars`` counted anew); documents with no word left go."""
    with passing(docs.sparkSession) as keep:
        spans = repeats(docs).groupBy("d", "th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))  # of one document
        spans = keep(spans, "spans")
    spans = spans.withColumnsRenamed({"d": " d", "th": " th", "spans": " spans"})
    names = [f"`{c}`" for c in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumn(" d", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))).withColumn(" th", F.xxhash64(text))
    hit = spans.select(" th")
    marked = among(named, hit, " th").join(spans, [" d", " th"], "left")
    untouched = marked.where("` spans` is null").select(*names)
    if few(hit):
        untouched = untouched.union(named.join(F.broadcast(hit.distinct()), " th", "left_anti").select(*names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [cut(t, [(s["start"], s["end"]) for s in spans]) for t, spans in zip(batch.column(at).to_pylist(), batch.column(" spans").to_pylist())]
            left = pa.array([bool(t.split()) for t in texts], pa.bool_())
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.drop_columns([" spans"]).filter(left)

    touched = marked.where("` spans` is not null").select(*names, "` spans`")
    touched = map_rows(touched, run, docs.schema)
    if "n_chars" in docs.columns:
        touched = touched.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return untouched.union(touched)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(documents(spark, sf_dir).select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages; their first occurrence stays."""
    return without_repeats(docs)
