"""Operators of the llm subpackage against libraries, brute force and odd inputs."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonecast.llm import bpe, classifier, common, idstore, lines, mixing, neardup, packing, passages, sharding, topk
from zonecast.llm.components import components
from zonecast.llm.samples import held_out
from zonecast.llm.tokens import default_path, fast_encoder

SF = "/root/testdata/sf0.001"
#: An extra column whose name clashes with those that operators add.
DOCS = "doc_id bigint, text string, score string, kept string, shard string"
ODD = [(1, None, "a", "b", "c"), (2, "", None, None, None), (3, " \t\n ", "x", "y", "z"), (None, "no id here", "", "", ""), (4, "one two", "", "", ""),
       (5, "one two", "", "", ""), (5, "one two", "", "", ""), (6, "word " * 30_000, "", "", ""), (7, "é　😀<|endoftext|>  a   b \n\n c", "", "", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bpe_is_the_librarys(spark):
    texts = [t or "" for (t,) in rows(spark.read.parquet(f"{SF}/documents.parquet").select("text"))]
    texts += [r[1] or "" for r in ODD] + [" ", "  ", "a \n b", "x\x1cy\x85z", "aaaa" * 3000, "<|endoftext|>", "don't 12 ½²"]
    own, fast, lib = bpe.codec(default_path()), fast_encoder(default_path()), library()
    for text in texts:
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want == fast(text).tolist()
        assert own.decode(want).decode() == lib.decode(want, skip_special_tokens=False)
    assert own.decode([255, 254]) == lib.decode([255, 254], skip_special_tokens=False).encode()


def test_bpe_on_odd_rows(odd, empty):
    got = rows(bpe.round_trip(odd))
    assert len(got) == len(ODD) and sum(n == 0 for _, n, _, _ in got) == 2
    assert bpe.round_trip(empty).count() == 0
    back = bpe.decode(bpe.encode(odd)).groupBy("doc_id").agg(F.max("text")).collect()
    assert {r[0]: r[1] for r in back}[7] == ODD[-1][1]


def test_token_store(spark, odd, empty, tmp_path):
    idstore.write(odd, str(tmp_path / "odd"), segment_ids=50)
    got = sorted(rows(idstore.digests(spark, str(tmp_path / "odd")).select("doc_id", "start", "n_tokens", "ids_crc32")), key=lambda r: r[1])
    assert len(got) == len(ODD) and [r[0] for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    lib = library()
    want = sorted(zlib.crc32(np.array([*lib.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in ODD)
    assert sorted(r[3] for r in got) == want
    found = idstore.lookup(spark, str(tmp_path / "odd"), spark.createDataFrame([(5,), (7,), (99,), (None,)], "doc_id bigint")).collect()
    starts = [(r[0], r[1]) for r in got if r[0] in (None, 5, 7)]
    assert sorted((r["doc_id"] or 0, r["start"]) for r in found) == sorted((k or 0, at) for k, at in starts)
    for r in found:
        text = next(t for i, t, *_ in ODD if i == r["doc_id"])
        assert r["ids"] == [*lib.encode(text, add_special_tokens=False).ids, 0]
    idstore.write(empty, str(tmp_path / "empty"))
    assert idstore.digests(spark, str(tmp_path / "empty")).count() == 0
    assert idstore.lookup(spark, str(tmp_path / "empty"), spark.createDataFrame([(5,), (None,)], "doc_id bigint")).count() == 0


def test_token_store_opens_only_addressed_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idstore, "BUCKET_KEYS", 64)
    folder = str(tmp_path / "many")
    docs = [(i, f"text number {i} " * (1 + i % 5)) for i in range(600)] + [(250, f"again {i}") for i in range(300)] + [(None, f"none {i}") for i in range(40)]
    idstore.write(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), folder, segment_ids=200)
    wanted = spark.createDataFrame([(3,), (599,), (77,), (-1,), (600,), (1 << 62,)], "doc_id bigint")
    opened = idstore._addressed(spark, folder, wanted).collect()
    assert sorted(r["doc_id"] for r in opened) == [3, 77, 599]
    found = idstore.lookup(spark, folder, wanted).collect()
    fast = fast_encoder(default_path())
    assert {r["doc_id"]: r["ids"] for r in found} == {i: [*fast(docs[i][1]).tolist(), 0] for i in (3, 77, 599)}
    # a key that spans several segments, and the null key
    hot = idstore.lookup(spark, folder, spark.createDataFrame([(250,), (None,)], "doc_id bigint")).collect()
    texts = sorted((i or -1, tuple([*fast(t).tolist(), 0])) for i, t in docs if i in (250, None))
    assert sorted((r["doc_id"] or -1, tuple(r["ids"])) for r in hot) == texts
    assert len({r["start"] for r in hot}) == len(hot)


def test_perfect_hash():
    hashes = [idstore.key_hash(k, 0) for k in range(5000)]
    index = idstore.PerfectHash.build(hashes)
    assert sorted(map(index.slot, hashes)) == list(range(5000))
    assert sum(index.slot(idstore.key_hash(k, 1)) is not None for k in range(5000)) < 10


def check_packed(got, n, capacity=packing.Capacity()):
    by = collections.defaultdict(list)
    for length, sequence, offset in got:
        by[sequence].append((offset, length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(own) <= capacity.documents and sum(x * x for _, x in own) <= capacity.attention
    assert len(got) == n
    return len(by)


def test_packing(spark, odd, empty):
    got = packing.sequences(odd)
    pieces = rows(got.select("doc_id", "piece", "start", "length"))
    long = sorted(p for p in pieces if p[0] == 6)
    assert [p[3] for p in long][1:] == [2048] * (len(long) - 1) and sum(p[3] for p in long) > 30_000
    check_packed(rows(got.select("length", "sequence_id", "offset")), len(pieces))
    assert packing.sequences(empty).count() == 0


def test_packing_shuffles_no_pieces(spark):
    """Nothing but counts is exchanged: no piece, and so no ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    got = packing.sequences(docs, with_ids=True)
    assert "length" in got.columns and not {"part", "number"} & set(got.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(exchanged) == 2 and sum("ids" in line.replace("ids_crc32", "") for line in scans) == 1 and "hashpartitioning(doc_id" not in plan
    for line in exchanged:  # per length and part, per length
        assert "hashpartitioning(length" in line
    pieces = got.collect()
    check_packed([(r["length"], r["sequence_id"], r["offset"]) for r in pieces], len(pieces))
    assert all(len(r["ids"]) == r["length"] for r in pieces)
    by = collections.defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        by[r["doc_id"]] += r["ids"]
    encode = fast_encoder(default_path())
    assert by == {r["doc_id"]: [*encode(r["text"] or "").tolist(), 0] for r in docs.collect()}


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    rng = random.Random(3)
    counts = dict(collections.Counter(min(2048, int(rng.expovariate(1 / 300)) + 1) for _ in range(4000)))
    for capacity in (packing.Capacity(score=score), packing.Capacity(2048, 4, 1_500_000 + 2048 * 2048, score=score), packing.Capacity(2048, 3, score=score)):
        placed, used = packing.best_fit(counts, capacity)
        got = [(length, s + i, offset) for length, _, n, s, offset in placed for i in range(n)]
        for length, n in counts.items():
            assert sorted(f + i for own, f, k, _, _ in placed if own == length for i in range(k)) == list(range(n))
        assert check_packed(got, 4000, capacity) == used
        if capacity.documents == 2048:
            assert used <= 1.01 * math.ceil(sum(k * v for k, v in counts.items()) / 2048) + 1


def test_topk_is_exact(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(300)]
    data += [(300, None), (301, [None] + [0.0] * 7), (302, [float("nan")] * 8), (None, [0.0] * 8), (7, data[7][1])]
    vectors = topk.integer_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), scale=2)
    got = rows(topk.search(vectors.where("vec_id % 50 = 0"), vectors, n_pivots=4, block=64).orderBy("query_id", "rank"))
    v = {i: np.floor(2 * np.array(x)) for i, x in data[:300]}
    want = []
    for q in range(0, 300, 50):
        best = sorted((-int(v[q] @ v[c]), c) for c in [*v, 7] if c != q)[:5]  # 7 is stored twice
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    assert got == want
    assert topk.search(vectors.where("false"), vectors.where("false")).count() == 0


def test_topk_ranks_every_row(spark):
    """Rows that stand several times among a query's best, of candidates and of queries, against the SQL over the same rows."""
    duckdb = pytest.importorskip("duckdb")
    rng = np.random.default_rng(6)
    data = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(1, 120)]
    data += [(500, [9.0] * 4)] * 3 + [(501, [8.0] * 4)] * 2 + [(50, data[49][1]), (50, [1.0] * 4), (100, [2.0] * 4)]
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", data)
    want = sorted(db.execute(topk.ORACLE_SQL).fetchall())
    for parts, block in ((1, 1000), (4, 16)):
        vectors = topk.integer_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>").repartition(parts))
        got = rows(topk.search(vectors.where("vec_id % 50 = 0"), vectors, n_pivots=4, block=block))
        assert sorted(got) == want
    assert [v for q, r, v, _ in want if q == 100] == [500, 500, 500, 501, 501]


def test_topk_refuses_what_it_cannot_compare(spark):
    for data in ([(0, [1.0] * 3), (1, [1.0] * 5)], [(0, [1e12] * 3), (1, [1.0] * 3)]):
        vectors = topk.integer_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>").coalesce(1))
        with pytest.raises(Exception, match="compare|too large"):
            topk.search(vectors, vectors).collect()


def test_sharding(odd, empty):
    table = sharding.fill(["a", "b", "c"], 101)
    counts = collections.Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(["a", "b"], 101)
    assert sum(x == y for x, y in zip(table, fewer) if x != 2) > 0.7 * sum(x != 2 for x in table)
    placed = sharding.place(odd, shard="own_shard")
    assert placed.columns == [*odd.columns, "slot", "own_shard"] and placed.count() == len(ODD)
    assert placed.where("doc_id = 5").select("own_shard").distinct().count() == 1
    with pytest.raises(ValueError):
        sharding.place(odd)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)
    assert sharding.place(empty, shard="s").count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)] + [(500, 500)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = dict(rows(components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert got == {x: find(x) for x in parent if x != 500 and any(x in e and e[0] != e[1] for e in edges)}


def brute_components(docs, percent, n):
    sets = {i: set(neardup.shingles(t or "", n).tolist()) for i, t in docs}
    out = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((out[a], out[b]))
                out = {k: x if v == y else v for k, v in out.items()}
    return out


@pytest.mark.parametrize("percent, n", [(85, 3), (80, 5)])
def test_near_duplicates_with_a_large_group(spark, percent, n):
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(1, 150):  # more near copies than a small node holds
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        docs.append((i, " ".join(own)))
    docs += [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(150, 170)]
    docs += [(170, docs[160][1]), (171, None), (172, ""), (173, "Two words"), (174, "two  WORDS")]
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), percent, n)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute_components(docs, percent, n)


def test_near_duplicates_of_a_crowd_without_links_to_its_typical_document(spark, monkeypatch):
    """Shortened copies, each 0.84 similar to the whole text and 0.7 to the others, but 0.9 to its twin."""
    monkeypatch.setattr(neardup, "SMALL", 4)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    docs = [(0, " ".join(base))]
    for _ in range(80):
        gone = rng.sample(range(200), 41)
        for mine in (gone[:33], gone[8:]):
            docs.append((len(docs), " ".join(w for k, w in enumerate(base) if k not in mine)))
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 85, 1)
    want = brute_components(docs, 85, 1)
    assert len(set(want.values())) > 70
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_near_duplicates_in_nodes_that_stay_large(spark, monkeypatch):
    """Shortened copies like those above; no depth divides them any more, so only a full comparison finds each twin."""
    for name, value in {"SMALL": 4, "DEEPER": (4,), "OUTSIDE": 4, "CHUNK": 16, "BLOCK": 8}.items():
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    docs = [(0, " ".join(base))]
    for _ in range(60):
        gone = rng.sample(range(200), 41)
        for mine in (gone[:33], gone[8:]):
            docs.append((len(docs), " ".join(w for k, w in enumerate(base) if k not in mine)))
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 85, 1)
    want = brute_components(docs, 85, 1)
    assert len(set(want.values())) > 50
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_pairs_of_a_crowd_grow_with_its_members(spark):
    """Edited copies about 0.56 similar to each other, far from a link: no all-pairs comparison, and links between twins are found."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    docs, twins = [], []
    for i in range(800):
        own = [f"x{i}.{k}" if rng.random() < 0.14 else w for k, w in enumerate(base)]
        docs.append((i, " ".join(own)))
        if i % 40 == 0:
            twins.append((i, 1000 + i))
            docs.append((1000 + i, " ".join([*own[:-5], *(f"y{k}" for k in range(5))])))
    counts = []
    for n in (400, 800):
        part = spark.createDataFrame([d for d in docs if d[0] % 1000 < n], "doc_id bigint, text string").cache()
        members = part.selectExpr("1L key", "doc_id rep")
        nobody = spark.createDataFrame([], "node bigint, component bigint")
        pairs = rows(neardup.crowd_pairs(members, nobody, part, 85, 1).select("a", "b"))
        assert {t for t in twins if t[0] < n} <= set(pairs)
        counts.append(len(pairs))
    assert counts[1] <= 3 * counts[0] and counts[1] < 4000


def test_near_duplicates_on_odd_rows(odd, empty):
    got = rows(neardup.near_duplicates(odd))
    assert len(got) == len(ODD) and {r[0]: r[2] for r in got}[5] == 4
    assert {(r[2], r[3]) for r in got if r[0] is None} == {(None, True)}
    assert neardup.near_duplicates(empty).count() == 0


def test_quality_rules_base(spark, odd, empty):
    got = {r["doc_id"]: r for r in lines.apply(odd, *([0.0] * len(lines.FEATURES), [0.0] * 4)).collect()}
    assert got[6]["n_words"] == got[6]["n_repeat_words"] == 30_000 and got[6]["base_failed"] and not got[6]["kept"]
    assert (got[1]["n_words"], got[1]["kept"], got[3]["word_chars"]) == (0, False, 0)
    words = [f"a{i}" for i in range(40)]
    text = " ".join(words + ["#|"] + words[:8]) + "\nsame line\nsame line\n\n"
    n, chars, symbols, dup, repeat, failed, share, kept = lines.judge(text, lines.ChainField())
    assert (n, symbols, dup, repeat, failed, share, kept) == (53, 2, 1, 16, True, 1.0, False)
    assert chars == sum(map(len, text.split()))
    assert lines.apply(empty, [0.0] * len(lines.FEATURES), [0.0] * 4).count() == 0


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        field = lines.ChainField(rng.normal(size=len(lines.FEATURES)), rng.normal(size=(2, 2)))
        marks = [sorted(rng.choice(len(lines.FEATURES), 3, replace=False).tolist()) for _ in range(6)]

        def score(y):
            return sum(field.weights[m].sum() for m, a in zip(marks, y) if a) + sum(field.moves[a, b] for a, b in zip(y, y[1:]))

        best = max(([int(b) for b in f"{k:06b}"] for k in range(64)), key=score)
        assert field.decode(marks) == best
    assert lines.ChainField().decode([]) == []


def labels_of(spark, folder):
    return dict(rows(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")))


def test_classifier_and_rules_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    known = labels_of(spark, folder)
    got = [r for r in classifier.query(spark, folder).collect() if r["held_out"] and r["doc_id"] in known]
    assert sum(r["predicted"] == known[r["doc_id"]] for r in got) >= 0.95 * len(got)
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in lines.query(spark, folder).collect()}
    judged = [(known[i], k) for i, (failed, k) in kept.items() if i in known and not failed]
    assert sum(k == bool(q) for q, k in judged) >= 0.95 * len(judged)


def test_rules_stage_learns_from_the_whole_table(spark):
    """Documents that reach the stage are judged as the query judges them, though the boilerplate to learn from is gone by then."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bad = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 0 and doc_id is not null").where(~held_out()).select("doc_id")
    reaching = docs.join(bad, "doc_id", "left_anti")
    judged = lines.query(spark, folder).select("doc_id", "kept", "base_failed").join(reaching.select("doc_id"), "doc_id")
    verdict = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert judged.where("not kept and not base_failed").count() > 0
    assert {r["doc_id"] for r in lines.stage(spark, reaching, folder).select("doc_id").collect()} == {i for i, kept in verdict.items() if kept}


def test_classifier_on_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    model = classifier.train(odd, none)
    got = classifier.score(odd, model)
    assert got.columns == ["doc_id", "text", "kept", "shard", "score", "predicted"]
    assert {r["score"] for r in got.collect()} == {0.5}
    assert classifier.score(empty, model).count() == 0


def test_passages(spark, odd, empty):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**9)}"
    shared = [word() for _ in range(60)]
    texts = [[word() for _ in range(rng.randrange(20, 200))] for _ in range(40)]
    for t in texts[:30]:
        at = rng.randrange(len(t))
        t[at:at] = shared
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    got = rows(passages.passages(docs))
    assert {r[0] for r in got} == set(range(1, 30)) and {r[4] for r in got} <= set(range(29))
    assert all(texts[d][a:b] == shared for d, a, b, *_ in got)
    left = {r["doc_id"]: r["text"].split() for r in passages.without_repeats(docs).collect()}
    assert left[0] == texts[0] and all(left[i] == [w for w in texts[i] if w not in shared] for i in range(1, 30))
    assert len(rows(passages.without_repeats(odd))) >= 5 and passages.passages(empty).count() == 0
    assert passages.cut("a b\nc d", [(0, 1), (2, 4)]) == "b\n"


@pytest.mark.parametrize("sent", [2_000_000, 0])
def test_texts_that_take_no_part_stay_out_of_the_shuffles(spark, monkeypatch, sent):
    """Ids alone lead to nodes and repeats; so long as those concerned are few, other texts meet no join.  Results are the same either way."""
    monkeypatch.setattr(common, "SENT_IDS", sent)
    stored: dict[str, list] = collections.defaultdict(list)
    for module in (neardup, passages):
        monkeypatch.setattr(module, "store", lambda df, name: stored[name].append(df) or common.store(df, name))
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(100)) for _ in range(30)]
    docs = [*enumerate(texts[:20]), *((20 + i, f"{t} more") for i, t in enumerate(texts[:5])), (25, None), (25, texts[5]), (None, texts[6])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame).collect() if r["doc_id"] is not None}
    assert got == {i: i - 20 if i >= 20 else i for i in range(25)} | {25: 5}
    assert stored["level"] and not any({"sketch", "mins", "keys"} & set(df.columns) for df in stored["level"])
    left = sorted(rows(passages.without_repeats(frame).select(F.coalesce("doc_id", F.lit(-1)), "text")), key=str)
    # a document without an id comes first, so the later copy loses its passage
    want = [*((i, t) for i, t in enumerate(texts[:20]) if i != 6), *((20 + i, "more") for i in range(5)), (25, None), (-1, texts[6])]
    assert left == sorted(want, key=str)
    plan = stored["suffixes"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == (sent > 0)


@pytest.mark.parametrize("ranges", [1, 4, 25])
def test_every_later_occurrence_of_a_run_is_reported(monkeypatch, ranges):
    """Sorted suffixes whose agreement falls and rises, whatever the order of their documents, against all pairs."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = 60
        around = np.ones((n, passages.LEFT + passages.RIGHT), ">u4")
        for row in around:  # the words to the left up to some place, and those to the right from some place on, are other ones
            row[: rng.choice([0, 0, 0, 4, 14, 34])] = rng.integers(2, 4)
            row[passages.LEFT + rng.choice([50, 50, 30, 20, 16]) :] = rng.integers(2, 4)
        ids = rng.permutation(n).tolist()
        data = sorted((r[passages.LEFT :].tobytes(), d, 0, 100, r[: passages.LEFT].tobytes()) for r, d in zip(around, ids))
        _, left, right = passages._match([(a, b, d, th, pos) for a, d, th, pos, b in data])
        want = {}
        for i in range(n):
            x, y = passages.LEFT, passages.RIGHT
            for j in range(i + 1, n):
                x, y = min(x, left[j - 1]), min(y, right[j - 1])
                if x + y >= passages.MIN_WORDS and y >= passages.GRAM:
                    old = want.get(later := max(data[i][1], data[j][1]), (100, 100))
                    want[later] = min(old[0], 100 - x), max(old[1], 100 + y)
        found, edges = [], []
        for part, own in enumerate(np.array_split(np.arange(n), ranges)):
            monkeypatch.setattr(passages.TaskContext, "get", lambda part=part: type("Context", (), {"partitionId": lambda self: part})())
            cols = [pa.array(c) for c in zip(*(data[i] for i in own))]
            for batch in passages._compare_sorted(iter([pa.RecordBatch.from_arrays(cols, names=["ahead", "d", "th", "pos", "behind"])])):
                found += [r for r in batch.to_pylist() if r["part"] is None]
                edges.append(batch.filter(batch.column("part").is_valid()))
        found += [r for b in passages._across(iter(edges)) for r in b.to_pylist()]
        got = {}
        for r in found:
            assert r["source"] < r["d"]
            old = got.get(r["d"], (100, 100))
            got[r["d"]] = min(old[0], r["start"]), max(old[1], r["end"])
        assert got == want


def test_mixing(spark, odd, empty):
    got = mixing.query(spark, SF).collect()
    texts = {i: (t or "").encode().lower().split() for i, t in rows(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))}
    learned = {i for i in texts if zlib.crc32(str(i).encode()) % 10}
    count = collections.Counter(w for i in learned for w in [*texts[i], None])
    n, v = sum(count.values()), len(count)
    for r in got:
        own = [*texts[r["doc_id"]], None]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (r["doc_id"] not in learned, len(own), n)
        assert r["n_known"] == sum(count[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
        assert r["score"] < 0
    assert 1 < np.mean([r["bits_per_byte"] for r in got if r["held_out"]]) < 4
    assert len(rows(mixing.scores(odd))) == len(ODD) and mixing.scores(empty).count() == 0


def test_mixing_is_a_probability():
    code = mixing.Code(np.arange(mixing.SYMBOLS))
    assert sum(2.0 ** -int(n) for n in code.length) == 1.0
    total = 0.0
    for s in range(mixing.SYMBOLS):  # of all first symbols
        _, _, step = code.steps(np.array([s]))
        total += math.exp(mixing.Mixer().learn(np.zeros((mixing.PREDICTORS, len(step)), np.int8), np.zeros(len(step), np.int64), code.bit[step]))
    assert total == pytest.approx(1, abs=1e-3)


def plain_contexts(symbols):
    """Of each symbol: the symbols before it (zero: none), the word so far, and the place in the word."""
    word = []
    for i, s in enumerate(symbols):
        before = [symbols[i - k] + 1 if i >= k else 0 for k in (1, 2, 3, 4, 5)]
        yield s, (tuple(before[:2]), tuple(before[:3]), tuple(before), tuple(word)), len(word)
        word = [] if s == 32 else [*word, s]


def test_mixing_contexts_of_parts(monkeypatch):
    rng = random.Random(2)
    texts = [mixing.symbols_of([bytes(rng.choices(b"abc", k=rng.choice([1, 2, 40]))) for _ in range(n)]) for n in (0, 1, 3, 200, 2, 0, 90, 1)]
    whole = [mixing.contexts(t, np.zeros(1, np.int64))[:2] for t in texts]
    seen, back = {}, {}
    for t, (pairs, place) in zip(texts, whole):
        for i, (s, contexts, at) in enumerate(plain_contexts(t.tolist())):
            assert place[i] == at
            for k, context in enumerate(contexts):
                assert seen.setdefault((k, context, s), pairs[k, i]) == pairs[k, i] and back.setdefault(pairs[k, i], (k, context, s)) == (k, context, s)
    for part in (7, 64, 10_000):
        monkeypatch.setattr(mixing, "PART", part)
        laid = list(mixing.laid_out(texts))
        assert [x for _, s, _, _ in laid for x in s.tolist()] == [x for t in texts for x in t.tolist()]
        assert np.array_equal(np.concatenate([p for _, _, p, _ in laid], axis=1), np.concatenate([p for p, _ in whole], axis=1))
        assert np.array_equal(np.concatenate([p for _, _, _, p in laid]), np.concatenate([p for _, p in whole]))
        assert sum(n > 0 for lengths, *_ in laid for n in lengths) == len(texts)


def test_mixing_against_plain_loops(spark):
    """Counts, start state and scores by dictionaries over a small corpus, in which some rows repeat."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(40)]
    data = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(60)] + [(7, "again"), (None, "None here"), (61, None)]
    got = {}
    for parts in (1, 8):
        frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(parts)
        got[parts] = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["score"]) for r in mixing.scores(frame).collect()))
    texts = [(i, mixing.symbols_of((t or "").encode().lower().split()).tolist(), zlib.crc32(str(i).encode()) % 10 if i is not None else 0) for i, t in data]
    code = mixing.Code(np.bincount([s for _, t, fold in texts if fold for s in t], minlength=256))
    path = {s: [(int(code.node[j]), int(code.bit[j])) for j in range(code.start[s], code.start[s] + code.length[s])] for s in range(256)}

    def counted(folds):
        seen = collections.Counter()
        for _, t, fold in texts:
            for s, contexts, _ in plain_contexts(t) if fold in folds else ():
                seen.update((k, c, *step) for k, c in enumerate(contexts) for step in path[s])
        return seen

    def learned(t, seen, mixer):
        rows = [([(k, c, node) for k, c in enumerate(contexts)], min(place, 7), bit) for s, contexts, place in plain_contexts(t) for node, bit in path[s]]
        logits = [[max(-127, min(127, round(16 * math.log((seen[(*key, 1)] + 0.4) / (seen[(*key, 0)] + 0.4))))) for key in keys] for keys, _, _ in rows]
        return mixer.blocks(np.array(logits, np.int8).T, np.array([p for _, p, _ in rows]), np.array([b for _, _, b in rows], np.uint8)), -(-len(rows) // mixing.BLOCK)

    early, total, n = counted(range(2, 10)), 0, 0
    for _, t, fold in texts:
        if fold == 1:
            mixer = mixing.Mixer()
            _, blocks = learned(t, early, mixer)
            total, n = total + blocks * np.concatenate([mixer.weights.ravel(), mixer.cells]).astype(float), n + blocks
    assert n > 1
    state = np.array(total / n, np.float32)
    cut, seen, want = mixing.PREDICTORS * mixing.GATES, counted(range(1, 10)), []
    for i, t, _ in texts:
        mixer = mixing.Mixer(state[:cut].reshape(mixing.PREDICTORS, mixing.GATES), state[cut:])
        want.append((i if i is not None else -1, t.count(32) + 2 - (t == [mixing.END]), learned(t, seen, mixer)[0] / math.log(10)))
    want.sort()
    assert [x[:2] for x in got[1]] == [x[:2] for x in want]
    assert [x[2] for x in got[1]] == pytest.approx([x[2] for x in want], rel=1e-4)
    assert [x[2] for x in got[8]] == pytest.approx([x[2] for x in got[1]], rel=1e-9)


def test_mixing_logits_travel_without_keys():
    """What a bucket sends back takes less room than the keys alone, and comes back as it was."""
    rng = np.random.default_rng(6)
    text = b" ".join(bytes(rng.choice(list(b"abcdefgh"), rng.integers(1, 8)).astype(np.uint8)) for _ in range(20_000))
    symbols = mixing.symbols_of([text, b"\xff\x01"])
    code = mixing.Code(np.bincount(symbols, minlength=mixing.SYMBOLS))
    pairs, counts = np.unique(mixing.contexts(symbols, np.zeros(1, np.int64))[0], return_counts=True)
    _, logits = mixing.path_logits(code, pairs, counts)
    raw = mixing.packed_logits(code, pairs, logits)
    back = mixing.unpacked_logits(code, pairs, raw)
    assert np.array_equal(back, logits) and back.dtype == np.int8
    assert len(raw) < len(mixing.packed_keys(pairs)) / 2
    bucket = mixing.bucket_of(pairs, 7)
    assert (np.diff(bucket) >= 0).all() and set(bucket.tolist()) == set(range(7))
    assert len(mixing.unpacked_logits(code, pairs[:0], mixing.packed_logits(code, pairs[:0], logits[:0]))) == 0
    with pytest.raises(ValueError):
        mixing.unpacked_logits(code, pairs[1:], raw)
    assert "keys" not in mixing.COUNTED


def test_mixing_texts_travel_in_compressed_blocks(spark):
    data = [(i, i % 10, None if i == 3 else f"line {i} of a text that is like the others é\n" * (i % 7 * 9), i // 40) for i in range(100)]
    frame = spark.createDataFrame([*data, (None, 0, "no id", 2)], "doc_id bigint, fold int, text string, chunk bigint").coalesce(1)
    blocks = mixing.text_blocks(frame)
    got = {r["chunk"]: mixing.texts_of(pa.table({"texts": [r["texts"]]})).to_pylist() for r in blocks.collect()}
    assert [(r["doc_id"], r["fold"], r["text"], c) for c, own in got.items() for r in own] == [(*r[:2], r[2] or "", r[3]) for r in [*data, (None, 0, "no id", 2)]]
    assert sum(len(r["texts"]) for r in blocks.collect()) < sum(len(r[2] or "") for r in data) / 4
    assert mixing.texts_of(pa.table({"texts": pa.array([], pa.binary())})).schema == mixing.TEXTS


def test_mixing_folded_texts():
    rng = random.Random(5)
    data = [None, "", " ", " a", "a ", "  A b\t\nC ", "\x1c x\x85y", "é　Ü Z", "\t", *("".join(rng.choices(" \t\nAbcÉ\x0b", k=rng.randint(0, 12))) for _ in range(500))]
    for column in (pa.chunked_array([pa.array(data)]), pa.chunked_array([pa.array(data).slice(3, 50), pa.array([], pa.string()), pa.array(data).slice(100)]), pa.chunked_array([], pa.string())):
        got = mixing.symbols_in(mixing.folded(column))
        assert [x.tolist() for x in got] == [mixing.symbols_of((t or "").encode().lower().split()).tolist() for t in column.to_pylist()]


def test_mixing_finds_equal_contexts_once(monkeypatch):
    """Work on contexts is done once for each kind of symbol, and there are fewer kinds than symbols."""
    rng = random.Random(6)
    vocabulary = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 7))) for _ in range(50)]
    texts = [mixing.symbols_of(rng.choices(vocabulary, k=n)) for n in (0, 1, 400, 3, 900, 0, 50)]
    whole = [mixing.contexts(t, np.zeros(1, np.int64)) for t in texts]
    for part, run in ((64, 500), (1 << 18, 1 << 20)):
        monkeypatch.setattr(mixing, "PART", part)
        monkeypatch.setattr(mixing, "RUN", run)
        runs = list(mixing.runs(texts))
        assert np.array_equal(np.concatenate([r.pairs()[:, r.kind] for r in runs], axis=1), np.concatenate([p for p, _, _ in whole], axis=1))
        assert np.array_equal(np.concatenate([r.place[r.kind] for r in runs]), np.concatenate([p for _, p, _ in whole]))
    assert len(runs) == 1 and len(runs[0].symbols) < len(runs[0].kind) / 2
    keys = np.array([5 << 60, 7, 5 << 60 | 1, 5 << 60, 3], np.uint64)  # their first bits are not enough
    first, place = mixing.grouped(keys)
    assert np.array_equal(keys[first][place], keys) and first.tolist() == [0, 1, 2, 4]


def test_mixing_texts_side_by_side():
    """Each text's probability and state are those that it has alone."""
    rng = np.random.default_rng(7)
    def rows(n):
        return mixing.rows_of(rng.integers(-127, 128, (mixing.PREDICTORS, n)).astype(np.int8) * (rng.random((mixing.PREDICTORS, n)) < 0.8), rng.integers(0, mixing.PLACES, n), rng.integers(0, 2, n).astype(np.uint8))

    parts = [rows(n) for n in (4096, 4096, 700, 3, 1)]
    alone = [mixing.Mixer() for _ in parts]
    want = [mixer.learn_rows(part) for mixer, part in zip(alone, parts)]
    weights = np.repeat(mixing.Mixer().weights[:, None], len(parts), axis=1)
    cells = np.tile(mixing.Mixer().cells.reshape(1, mixing.GATES, mixing.CELLS), (len(parts), 1, 1))
    assert mixing.learn_together(weights, cells, parts, 3).tolist() == pytest.approx(want, rel=1e-12)
    for j, mixer in enumerate(alone):
        assert np.array_equal(weights[:, j], mixer.weights if j < 3 else mixing.Mixer().weights)
        assert np.array_equal(cells[j].ravel(), mixer.cells if j < 3 else mixing.Mixer().cells)


def test_mixing_long_texts_go_on_in_the_next_run(monkeypatch):
    rng = random.Random(8)
    vocabulary = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 9))) for _ in range(60)]
    texts = [mixing.symbols_of(rng.choices(vocabulary, k=n)) for n in (3, 1500, 0, 100, 900, 2)]
    code = mixing.Code(np.bincount(np.concatenate(texts), minlength=mixing.SYMBOLS))
    pairs, counts = np.unique(np.concatenate([p.ravel() for _, _, p, _ in mixing.laid_out(texts)]), return_counts=True)
    known = mixing.Known(code, pairs, mixing.path_logits(code, pairs, counts)[1])
    monkeypatch.setattr(mixing, "PART", 1000)
    got = []
    for run in (1, 2500, 1 << 20):
        monkeypatch.setattr(mixing, "RUN", run)
        runs = list(mixing.runs(texts))
        words = mixing.distinct(np.concatenate([np.append(mixing.mixed(r.word[r.ends_word()]), mixing.END_WORD) for r in runs]))
        got.append(([t for t, _, _ in known.learned(runs)], [c.tolist() for c in mixing.word_counts(runs, words, np.arange(len(words)))]))
    assert len(runs) == 1 and got[0] == got[1] == got[2]
    assert [len(c) for c in got[0][1]] == [4, 1501, 1, 101, 901, 3]
    alone = [known.learned(mixing.runs([t])) for t in texts]
    assert got[0][0] == [next(x)[0] for x in alone]


def test_mixing_does_not_depend_on_the_layout(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: r["score"] for r in mixing.scores(docs.coalesce(1)).collect()}
    monkeypatch.setattr(mixing, "CHUNK_BYTES", 50_000)
    many = {r["doc_id"]: r["score"] for r in mixing.scores(docs.repartition(8)).collect()}
    assert many == pytest.approx(one, rel=1e-9)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        sizes.append(out.count())
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes and sizes[-1] <= sizes[-2]
            docs = out
    assert docs.select("doc_id").exceptAll(out.select("doc_id").distinct()).isEmpty()
    known = labels_of(spark, SF)
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert not [i for i in kept if known.get(i) == 0]
