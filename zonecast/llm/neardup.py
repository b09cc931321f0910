"""MinHash near-duplicates (operator 4).

Method: chosen-path set similarity join.  In each of ``TREES`` independent trees documents branch by their minwise shingle: those
that share it form a node.  A node of at most ``SMALL`` documents is compared exhaustively.  In a larger one, its most
typical document (the one that agrees most with the node's majority) is compared with all others, and all branch again by the
next minwise shingle, down to ``DEPTH``.  Links found so far are confirmed there.  The members of nodes that are still large and hold more than one
confirmed component branch on, to the depths of ``DEEPER``, each with as many new trees as leave a pair at the limit in different nodes of all of
them with probability ``MISS``.  Only documents of different components are compared: all such pairs of a node of which no more than ``OUTSIDE``
documents are outside the largest component.  The members of other nodes go on to the next depth.  So a crowd of documents that are like each other, yet not near enough, costs depth and trees, not all its pairs.
Nodes that are still large at the last depth are settled in full: each member is compared with one hub, links are confirmed and merged, and
then all pairs of a node that still lie in different components are compared, block by block.

Comparisons use one-byte minwise values (``TREES * DEPTH``, in deeper trees ``LONG``) and set sizes, with a margin of ``MARGIN`` standard deviations
(``LONG_MARGIN``); what remains is confirmed on the full sets, in two rounds: first each document's likeliest partner, then whatever
still lies in two components.  Pairs of the deeper trees get two such rounds of their own.

Scale and skew: equal sets are collapsed first, with map-side aggregation.  Node sizes come from counts; joins on node keys
have exchanges on both sides, so that skewed ones split; no group is collected beyond ``SMALL`` documents; typical documents are
found by aggregates.  Rows of the deeper trees are members times trees; nodes are counted before anything but keys is shuffled.  Only documents
with a candidate partner, or in a crowd, have their texts read again.  Links stay tables; components are joined, too.  Tables stored on the way
are deleted when the result is.

A document's set: distinct ``WORDS``-word shingles of its lower-cased words; with fewer words, the whole sequence as one.  Null, empty
and blank texts have no set and link with nothing.  Rows that share a doc_id are one document.  Rows without a doc_id link with nothing,
get a null component and are kept.  Ties go to the smallest doc_id.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import among, documents, few, map_rows, passing, shuffle_partitions, store
from .components import components, merged
from .tokens import text_groups
from .words import hashes, mixed, windows, words

WORDS, PERCENT = 3, 85
TREES, DEPTH, SMALL = 14, 4, 64
PLACES = TREES * DEPTH
#: The bytes of two sets at the limit agree in 85 of 100 of ``PLACES``, give or take 4.8 (one standard deviation).
MARGIN = 5
#: Depths of the further trees of crowds, and minwise values that their keys and comparisons are drawn from.
DEEPER, MISS, LONG, LONG_MARGIN = (8, 12, 16, 20, 24), 0.01, 512, 3
#: Outside members of a node that are compared with all of it; with more, the node branches on.
OUTSIDE = 256
#: Members of a node compared in one group, and members of either side of a group at the last depth.
CHUNK, BLOCK = 1024, 4096


def least_agreement(percent: int, places: int = PLACES, margin: float = MARGIN) -> int:
    p = percent / 100
    return max(0, int(np.floor(places * p - margin * (places * p * (1 - p)) ** 0.5)))


def trees_at(depth: int, percent: int) -> int:
    """Trees in which two sets at the limit share a node of this depth with probability 1 - ``MISS``."""
    return int(np.ceil(np.log(MISS) / np.log1p(-((percent / 100) ** depth))))


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the document's set."""
    h = hashes(words(text))
    if not len(h):
        return h
    return np.unique(windows(h, n)) if len(h) >= n else windows(h, len(h)) + np.uint64(len(h))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, n_words: int = WORDS, places: int = PLACES) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (128 bits that name the set), mins (minwise values, by tree and depth)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mixed(np.arange(1, places + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
        for group in text_groups(batches):
            sets = [shingles(t, n_words) for t in group.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            mins, s1, s2 = np.zeros((len(sets), places), np.int32), np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
            if len(full):
                flat, starts = np.concatenate([sets[i] for i in full]), np.cumsum(sizes[full]) - sizes[full]
                for k, seed in enumerate(seeds):
                    x = flat * seed
                    mins[full, k] = (np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                s1[full] = np.add.reduceat(flat, starts).view(np.int64)
                s2[full] = np.add.reduceat(mixed(flat + np.uint64(99)), starts).view(np.int64)
            flat_mins = pa.array(mins.ravel(), pa.int32())
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * places)
            yield from pa.table(
                {"doc_id": group.column("doc_id"), "n": pa.array(sizes, pa.int64()), "s1": pa.array(s1), "s2": pa.array(s2),
                 "mins": pa.ListArray.from_arrays(offsets, flat_mins)}
            ).to_batches()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, mins array<int>")


def _node(depth: int):
    """The key of a set's node at ``depth`` of its tree."""
    return F.xxhash64("tree", F.slice("mins", F.col("tree") * DEPTH + 1, depth + 1)).alias("key")


def _agreement(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _near_sizes(percent: int):
    return F.least("n", "m_n") * 100 >= F.greatest("n", "m_n") * percent


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col("agree").cast("int").alias("agree")]


def _whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows that are sorted by ``names``, in tables that cut no group, and the places where groups begin (and the last ends)."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([x for x in (held, pa.Table.from_batches([batch])) if x is not None])
        new = np.any([np.diff(table.column(c).to_numpy()) != 0 for c in names], axis=0)
        edges = (np.flatnonzero(new) + 1).tolist()
        if edges:
            yield table.slice(0, edges[-1]), [0, *edges]
        held = table.slice(edges[-1] if edges else 0)  # the last group may go on
    if held is not None:
        new = np.any([np.diff(held.column(c).to_numpy()) != 0 for c in names], axis=0)
        yield held, [0, *(np.flatnonzero(new) + 1).tolist(), held.num_rows]


def _small_nodes(rows: DataFrame, percent: int, least: int) -> DataFrame:
    """All likely pairs of nodes of bounded size; ``rows`` has key, rep, n, sketch."""

    def pairs(rep: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> tuple:
        i, j = np.triu_indices(len(rep), 1)
        agree = (sketch[i] == sketch[j]).sum(1)
        likely = (agree >= least) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent) & (rep[i] != rep[j])
        i, j = rep[i[likely]], rep[j[likely]]
        return np.minimum(i, j), np.maximum(i, j), agree[likely]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_groups(batches, ("key",)):
            rep, n = (table.column(c).to_numpy() for c in ("rep", "n"))
            sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, PLACES)
            found = [pairs(rep[x:y], n[x:y], sketch[x:y]) for x, y in zip(edges, edges[1:]) if y - x > 1]
            if found:
                a, b, agree = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_pydict({"a": a, "b": b, "agree": pa.array(agree, pa.int32())})

    return map_rows(rows.repartition("key").sortWithinPartitions("key"), run, "a bigint, b bigint, agree int")


def _typical(rows: DataFrame) -> DataFrame:
    """For each node: the document that agrees most with the majority of a place of every tree, as m_rep, m_n, m_sketch."""
    some = F.array(*[F.col("sketch")[p] for p in range(0, PLACES, DEPTH)])
    modes = F.array(*[F.mode(F.col("sketch")[p], True) for p in range(0, PLACES, DEPTH)])
    major = store(rows.groupBy("key").agg(modes.alias("major")), "majority")
    best = rows.withColumn("some", some).join(major, "key").withColumn("agree", _agreement("some", "major"))
    best = best.groupBy("key").agg(F.max(F.struct("agree", (-F.col("rep")).alias("back"), "n", "sketch")).alias("x"))
    return store(best.select("key", (-F.col("x.back")).alias("m_rep"), F.col("x.n").alias("m_n"), F.col("x.sketch").alias("m_sketch")), "typical")


def candidates(reps: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame | None]:
    """Likely pairs (a < b) of sets and the number of places in which they agree; and the members (key, rep) of the nodes
    that are large at the last depth, where only pairs with the typical document are among the likely ones."""
    least = least_agreement(percent)
    low_byte = F.transform("mins", lambda x: F.shiftright(F.shiftleft(x, 24), 24).cast("tinyint"))
    sketched = store(reps.select("rep", "n", low_byte.alias("sketch"), "mins"), "bytes")
    rows = reps.withColumn("tree", F.explode(F.array(*map(F.lit, range(TREES)))))
    found: list[DataFrame] = []
    crowds = None
    for depth in range(DEPTH):
        # Keys and ids alone meet the counts; the bytes join those that have company.
        level = rows.select("rep", "tree", _node(depth))
        sizes = store(level.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "nodes")
        level = store(level.join(sizes, "key"), "level")
        found.append(_small_nodes(level.where(F.col("size") <= SMALL).select("key", "rep").join(sketched.drop("mins"), "rep"), percent, least))
        large = level.where(F.col("size") > SMALL).select("key", "rep", "tree")
        if large.isEmpty():
            break
        sketched = store(sketched.join(large.select("rep").distinct(), "rep", "left_semi"), "bytes")
        wide = store(large.join(sketched.drop("mins"), "rep"), "large")
        star = store(wide.join(_typical(wide), "key").withColumn("agree", _agreement("sketch", "m_sketch")), "stars")
        likely = (F.col("agree") >= least) & _near_sizes(percent)
        found.append(star.where(likely & (F.col("rep") != F.col("m_rep"))).select(*_pair("rep", "m_rep")))
        if depth == DEPTH - 1:
            crowds = star.select("key", "rep")
        rows = large.select("rep", "tree").join(sketched.select("rep", "mins"), "rep")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree")), crowds


def _keys(members: DataFrame, depth: int, trees: int) -> DataFrame:
    """key, rep, name, component: each member's node in every tree of this depth; a tree's branches follow ``depth`` of the member's minwise values."""
    rng = np.random.default_rng(depth)
    chosen = [rng.choice(LONG, depth, replace=False) for _ in range(trees)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mins = batch.column("mins").flatten().to_numpy().reshape(-1, LONG).astype(np.uint32).astype(np.uint64)
            own = {c: batch.column(c) for c in ("rep", "name", "component")}
            for t, places in enumerate(chosen):
                key = np.full(len(mins), depth * 100_003 + t, np.uint64)
                for p in places:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + mins[:, p])
                yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), **own})

    return map_rows(members.select("rep", "name", "component", "mins"), run, "key bigint, rep bigint, name bigint, component bigint")


def _nodes(keyed: DataFrame) -> DataFrame:
    """key, hub (least member), size, main (the largest component), others (members outside it) of the nodes of several components."""
    nodes = keyed.groupBy("key", "component").agg(F.count("*").alias("c"), F.min("rep").alias("hub"))
    nodes = nodes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("x"), F.sum("c").alias("size"), F.min("hub").alias("hub"))
    nodes = nodes.select("key", "hub", "size", F.col("x.component").alias("main"), (F.col("size") - F.col("x.c")).alias("others"))
    return store(nodes.where("others > 0"), "nodes")


def _mixed_nodes(keyed: DataFrame, nodes: DataFrame, members: DataFrame, percent: int, least: int, block: int, chunk: int) -> DataFrame:
    """Likely pairs of different components, one side outside its node's largest: all of the nodes in ``nodes``.

    The outside members of a node are dealt into blocks, all its members into chunks; each block meets each chunk in a group of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_groups(batches, ("key", "place")):
            rep, n, part = (table.column(c).to_numpy() for c in ("rep", "n", "component"))
            outside, asks, asked = (table.column(c).to_numpy(zero_copy_only=False) for c in ("outside", "asks", "asked"))
            sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, LONG)
            found: list[tuple] = []
            for x, y in zip(edges, edges[1:]):
                for i in x + np.flatnonzero(asks[x:y]):
                    near = np.minimum(n[i], n[x:y]) * 100 >= np.maximum(n[i], n[x:y]) * percent
                    # two outside members meet twice, as each one's block meets the other's chunk
                    once = asked[x:y] & (~outside[x:y] | (rep[x:y] > rep[i]))
                    j = x + np.flatnonzero((part[x:y] != part[i]) & near & once)
                    agree = (sketch[j] == sketch[i]).sum(1)
                    j, agree = j[agree >= least], agree[agree >= least]
                    found.append((np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), agree))
            if found:
                a, b, agree = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_pydict({"a": a, "b": b, "agree": pa.array(agree, pa.int32())})

    low_byte = F.transform("mins", lambda x: F.shiftright(F.shiftleft(x, 24), 24).cast("tinyint"))
    rows = keyed.join(nodes, "key").withColumn("outside", F.col("component") != F.col("main"))
    rows = rows.withColumn("blocks", F.ceil(F.col("others") / block)).withColumn("chunks", F.ceil(F.col("size") / chunk))
    rows = rows.withColumn("own_block", F.pmod(F.xxhash64("rep", F.lit(1)), "blocks")).withColumn("own_chunk", F.pmod(F.xxhash64("rep"), "chunks"))
    asked_at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda b: b * F.col("chunks") + F.col("own_chunk"))
    asks_at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), lambda c: F.col("own_block") * F.col("chunks") + c)
    rows = rows.withColumn("place", F.explode(F.when(F.col("outside"), F.array_union(asks_at, asked_at)).otherwise(asked_at)))
    asks = F.col("outside") & (F.floor(F.col("place") / F.col("chunks")) == F.col("own_block"))
    rows = rows.withColumn("asks", asks).withColumn("asked", F.pmod("place", "chunks") == F.col("own_chunk"))
    rows = rows.select("key", "place", "outside", "asks", "asked", "rep", "name", "component")
    rows = rows.join(members.select("rep", "name", "n", low_byte.alias("sketch")), ["rep", "name"])
    by = ("key", "place")
    return store(map_rows(rows.repartition(*by).sortWithinPartitions(*by), run, "a bigint, b bigint, agree int").distinct(), "likely")


def _in_components(members: DataFrame, parts: DataFrame) -> DataFrame:
    return members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _last_pairs(large: DataFrame, members: DataFrame, parts: DataFrame, docs: DataFrame, percent: int, n_words: int) -> DataFrame:
    """Likely pairs of nodes that no further depth divides (``large``: key, rep, name, hub), whatever their size.  Their members are next to
    equal, so most of them are one component after one partner for each; all pairs that are not are compared."""
    hubs = large.where("rep <> hub").groupBy("rep").agg(F.min("hub").alias("hub"))
    least = least_agreement(percent, LONG, MARGIN)
    hubs = store(hubs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"), F.lit(least).alias("agree")).distinct(), "hubs")
    keyed = store(_in_components(large.select("key", "rep", "name"), _linked(hubs, docs, percent, n_words, parts)), "last")
    return hubs.unionByName(_mixed_nodes(keyed, _nodes(keyed), members, percent, least, BLOCK, BLOCK))


def crowd_pairs(crowds: DataFrame, parts: DataFrame, docs: DataFrame, percent: int = PERCENT, n_words: int = WORDS) -> DataFrame:
    """Likely pairs of different components among the members of ``crowds`` (key, rep), by deeper trees; ``parts`` names each linked set's component."""
    least = least_agreement(percent, LONG, LONG_MARGIN)
    named = store(_in_components(crowds, parts), "crowds")
    mixed_nodes = store(named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key"), "mixed")
    open_ = store(named.join(mixed_nodes, "key", "left_semi").select("rep", "component").distinct(), "open")
    long = sketches(_of_ids(docs, open_.select("rep")), n_words, LONG).where("n > 0").selectExpr("doc_id rep", "s1 name", "n", "mins")
    members = store(long.dropDuplicates(["rep", "name"]).join(open_, "rep"), "members")  # an id may have several texts
    found: list[DataFrame] = []
    for depth in DEEPER:
        keyed = store(_keys(members, depth, trees_at(depth, percent)), "keys")
        nodes = _nodes(keyed)
        ready = F.col("others") <= OUTSIDE  # so the work for each member is bounded
        found.append(_mixed_nodes(keyed, nodes.where(ready), members, percent, least, OUTSIDE, CHUNK))
        large = store(keyed.join(nodes.where(~ready).select("key", "hub"), "key").drop("component"), "large")
        if large.isEmpty():
            break
        if depth == DEEPER[-1]:
            found.append(_last_pairs(large, members, parts, docs, percent, n_words))
            break
        members = store(members.join(large.select("rep").distinct(), "rep", "left_semi"), "members")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents that the stored one-column table ``ids`` names.  So long as these are few they are sent to the texts;
    beyond, both sides are shuffled."""
    wanted = ids.toDF("doc_id").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    return rows.join(F.broadcast(wanted) if few(ids) else wanted, "doc_id", "left_semi")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, n_words: int = WORDS) -> DataFrame:
    """Of the stored ``pairs`` those (u, v) whose full sets are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c) for c in ("a", "b", "x", "y"))
            texts = [c.to_pylist() for c in (x, y)]
            sets = {t: shingles(t, n_words) for t in {*texts[0], *texts[1]}}  # a text of several pairs is read once
            keep = pa.array([similar(sets[t], sets[u], percent) for t, u in zip(*texts)], pa.bool_())
            yield pa.RecordBatch.from_pydict({"u": a.filter(keep), "v": b.filter(keep)})

    left = among(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), pairs.select("a"), "a")
    right = among(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), pairs.select("b"), "b")
    dealt = pairs.select("a", "b").repartition(shuffle_partitions(pairs.sparkSession))  # few bytes, much work
    both = dealt.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return map_rows(both, run, "u bigint, v bigint").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, percent: int, n_words: int, parts: DataFrame | None) -> DataFrame:
    """Components (node, component) after what ``pairs`` can link, beside those already in ``parts``."""
    wanted = store(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "wanted")
    texts = store(_of_ids(docs, wanted).withColumnRenamed("doc_id", "id"), "texts")

    # First each document's likeliest partner, ...
    first = pairs.groupBy("b").agg(F.max(F.struct("agree", (-F.col("a")).alias("back"))).alias("x"))
    first = store(first.select((-F.col("x.back")).alias("a"), "b"), "first")
    links = store(confirm(first, texts, percent, n_words), "links")
    parts = store(components(links), "parts") if parts is None else merged(parts, links)
    # ... then all pairs whose ends aren't connected yet.
    side = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    rest = pairs.join(first, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
    rest = rest.where(F.coalesce(F.col("a_part"), F.col("a")) != F.coalesce(F.col("b_part"), F.col("b")))
    return merged(parts, store(confirm(store(rest.select("a", "b"), "rest"), texts, percent, n_words), "links"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n_words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each row of ``docs``."""
    with passing(docs.sparkSession) as keep:
        drawn = store(sketches(docs, n_words), "sketches")
        known = drawn.where("n > 0 and doc_id is not null")
        # One representative for each distinct set: its least doc_id.
        sets = known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.first("mins").alias("mins"))
        sets = store(sets, "sets")
        members = known.select("doc_id", "s1", "s2", "n").join(sets.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"])
        members = store(members.select("doc_id", "rep").distinct(), "of-sets")
        pairs, crowds = candidates(sets.select("rep", "n", "mins"), percent)
        pairs = store(pairs, "pairs")
        parts = _linked(pairs, docs, percent, n_words, None)
        if crowds is not None:
            more = crowd_pairs(crowds, parts, docs, percent, n_words).join(pairs, ["a", "b"], "left_anti")
            parts = _linked(store(more, "crowd-pairs"), docs, percent, n_words, parts)
        # An id with several texts links their sets.
        several = store(members.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("x")).where("v < x").select("doc_id", "v"), "several")
        parts = merged(parts, members.join(several, "doc_id").select(F.col("rep").alias("u"), "v").where("u <> v"))

        whole = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
        whole = store(whole.groupBy("doc_id").agg(F.min("component").alias("component")), "components")
        out = drawn.select("doc_id", "n").join(whole, "doc_id", "left")
        out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
        return keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near-duplicates")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, with five-word shingles and a similarity of 0.8 or more."""
    gone = near_duplicates(docs.select("doc_id", "text"), 80, 5).where("not kept").select("doc_id").distinct()
    return docs.join(store(gone, "gone"), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
