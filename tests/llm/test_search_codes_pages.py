"""Lexical search, vector codes and page text against brute force, SQL and odd inputs."""

from __future__ import annotations

import hashlib
import html as references
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.oracle_check import compare
from zonecast.llm import codes, lexical, pages


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- lexical search

DOCS = "doc_id bigint, text string, score string, rank string, term string"


def plain_search(docs, items, k=10):
    """(item, rank, doc, score) from every document's score."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    have = [(d, split(t)) for d, t in docs]
    have = [(d, t) for d, t in have if t]
    n_docs, n_terms = len(have), sum(len(t) for _, t in have)
    wanted = {}
    for key, text in dict.fromkeys(items):
        wanted.setdefault(key, []).extend(split(text))
    out = []
    for key, own in wanted.items():
        df = {t: sum(t in set(x) for _, x in have) for t in set(own)}
        hits = []
        for d, x in have:
            m = 25 + 75 * len(x) * n_docs // n_terms
            score = 0
            for t in own:
                if tf := x.count(t):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                hits.append((-score, d is None, d or 0, d, score))
        out += [(key, r, d, s) for r, (*_, d, s) in enumerate(sorted(hits)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("group_terms", [100_000, 7])
def test_lexical_on_odd_rows(spark, group_terms):
    rng = random.Random(5)
    words = ["Über", "über", "a", "B2", "éé", "zz", "the", "the", "the", "x-y", "日本", "Q"]
    docs = [(i % 37, " ".join(rng.choices(words, k=rng.randrange(1, 30))), "s", "r", "t") for i in range(120)]
    docs += [(None, "the éé the", "", "", ""), (None, "the éé the", "", "", ""), (50, None, None, None, None), (51, "", "", "", ""), (52, " ., \x00\n", "", "", ""),
             (53, "zz " * 20_000, "", "", ""), *docs[:3]]
    items = [(1, "the Über zz"), (1, "the Über zz"), (2, "éé ÉÉ B2 b2"), (2, "x y"), (3, None), (4, ""), (5, "nowhere"), (None, "日本 Q q"), (6, "the the the a")]
    df, wanted = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    got = rows(lexical.search(df, wanted, group_terms=group_terms).select("item_id", "rank", "doc_id", "score"))
    assert sorted(got, key=str) == plain_search([r[:2] for r in docs], [i for i in items if i[1]])


def test_lexical_sql_on_odd_rows(spark):
    docs = [(1, "one two two"), (1, "one two two"), (2, "ONE\x00two"), (3, None), (4, "three é"), (5, "É é é")]
    items = [(1, "one Two"), (2, "é"), (2, "é"), (3, None)]
    con = duckdb.connect()
    for name, data in (("documents", docs), ("benchmark", items)):
        con.register(name, pa.table({("doc_id" if name == "documents" else "item_id"): [d for d, _ in data], "text": pa.array([t for _, t in data], pa.string())}))
    got = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert compare(got, con, lexical.ORACLE_SQL) is None


def test_lexical_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "a", "", "", "")], DOCS), items.where("false")).count() == 0


def test_best_positions_stop_early_and_are_exact():
    rng = np.random.default_rng(3)
    docs, wide = 4000, 12
    pairs = np.unique(rng.integers(0, docs * wide, 20_000))
    doc, term = pairs // wide, pairs % wide
    tf = rng.zipf(2.0, len(doc)).clip(max=50)
    n = rng.integers(20, 400, docs)
    block = lexical.Block(np.arange(docs), np.zeros(docs, bool), n, doc, term, tf, docs, int(n.sum()))
    slot = np.full(wide, -1, np.int64)
    looked_up = []
    for size in (1, 2, 4):
        names, weights = np.arange(size), rng.integers(1, 3000, size)
        best = lexical.Best(10)
        looked_up.append(lexical.best_positions(block, names, weights, slot, best))
        scores = np.zeros(docs, np.int64)
        for t, w in zip(names, weights):
            np.add.at(scores, doc[term == t], w * block.impact[term == t])
        top = np.lexsort((np.arange(docs), -scores))[:10]
        assert best.ids.tolist() == top.tolist() and best.scores.tolist() == scores[top].tolist()
        assert (slot == -1).all()
        # a second search of the same block finds nothing better and stops at the top of the lists or soon after
        assert lexical.best_positions(block, names, weights, slot, best) <= looked_up[-1]
    assert looked_up[0] < 200 and looked_up[1] < docs // 2


# ---- vector codes


def plain_codes(table, parts=4, entries=256, rounds=4):
    kept = [(k, [math.floor(1024 * x) for x in v], label) for k, v, label in table if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in own[:entries]] for own in cut]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((far(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for own, book in zip(cut, books):
            at = [near(x, book)[1] for x in own]
            for e in set(at):
                of = [x for x, i in zip(own, at) if i == e]
                book[e] = [sum(c) // len(of) for c in zip(*of)]
    last = [[near(x, book) for x in own] for own, book in zip(cut, books)]
    code = ["".join(f"{i:02x}" for _, i in own) for own in zip(*last)]
    error = [sum(d for d, _ in own) for own in zip(*last)]
    label_error = {}
    for (_, _, label), e in zip(kept, error):
        label_error[label] = label_error.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((k, c, e, label_error[label], sha) for (k, _, label), c, e in zip(kept, code, error)), key=str)


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
VECTORS = "vec_id bigint, embedding array<double>, label int, code string, error string, entry string"


@pytest.mark.parametrize("length, scale", [(12, 1.0), (8, 0.002), (4, 3.0), (8, 3e5)])
def test_codes_are_brute_force(spark, length, scale):
    rng = random.Random(length)
    table = [(i if i % 9 else None, [rng.gauss(0, scale) for _ in range(length)], rng.choice([None, 1, 2])) for i in range(330)]
    table += [(7, table[7][1], 1), (7, [0.0] * length, 1), (400, None, 1), (401, [float("nan")] * length, 2), (402, [None] * length, 2), (403, [float("inf")] * length, 2), (404, [], 2)]
    df = spark.createDataFrame([(*r, "c", "e", "x") for r in table], VECTORS).repartition(3)
    assert sorted(rows(codes.compress(df).select(*COLUMNS)), key=str) == plain_codes(table)


def test_codes_with_few_or_no_rows_and_lengths(spark):
    few = [(3, [0.5] * 4, None), (1, [0.25, 0.5, -0.1, 0.0], None), (2, [0.5] * 4, 4)]
    df = spark.createDataFrame([(*r, "", "", "") for r in few], VECTORS)
    assert sorted(rows(codes.compress(df).select(*COLUMNS)), key=str) == plain_codes(few)
    assert codes.compress(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="parts"):
        codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "", "", "")], VECTORS))
    with pytest.raises(Exception, match="one length|components"):
        codes.compress(spark.createDataFrame([(1, [1.0] * 4, 1, "", "", ""), (2, [1.0] * 8, 1, "", "", "")], VECTORS)).count()


def test_codes_sql_with_repeated_rows(spark):
    rng = random.Random(2)
    table = [(i // 2, [rng.gauss(0, 1) for _ in range(8)], rng.choice([None, 1])) for i in range(40)] + [(None, [0.1] * 8, 5), (None, [0.1] * 8, 5), (3, None, 1)]
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in table], "embedding": pa.array([r[1] for r in table], pa.list_(pa.float64())), "label": pa.array([r[2] for r in table], pa.int32())}))
    got = codes.compress(spark.createDataFrame([(*r, "", "", "") for r in table], VECTORS)).select(*COLUMNS)
    assert compare(got, con, codes.ORACLE_SQL) is None


def test_transform_scales_squared_distances():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 16, 20):
        a, b = rng.integers(-5000, 5000, (2, 7, size))
        x, y = codes.transformed(a), codes.transformed(b)
        assert (((x - y) ** 2).sum(1) == x.shape[1] * ((a - b) ** 2).sum(1)).all()
    order = codes.transformed(np.eye(16, dtype=np.int64)).T
    assert (np.diff(order, axis=1) != 0).sum(1).tolist() == list(range(16))


# ---- page text


def plain_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 8])
def test_alignment_is_longest(monkeypatch, bits):
    monkeypatch.setattr(pages, "ALIGN_BITS", bits)
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        found = pages.common_lines(a, b)
        assert len(found) == plain_common(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(x < y and u < v for (x, u), (y, v) in zip(found, found[1:]))


def text_of(html):
    return "\n".join(t for t, flags in pages.page_lines(html) if flags & pages.OPEN)


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ('<script>var t="</p><article>x</article>";</script><article><p>a<br>b <i>c</i><p>d &lt;x&gt; &amp;amp; &eacute;</article><footer>f', "a b c\nd <x> &amp; é"),
        ("<nav><ul><li><a href='/a>b'>menu</a></ul></nav><main><h1>T</h1><pre>x\n  y</pre><table><tr><td>1<td>2</table></main>", "T\nx y\n1\n2"),
        ('<body class="has-sidebar"><article>a<section id="comments"><article>b</article></section><p>c</article><div class="cookie-notice">n</div>', "a\nc"),
        ("<article><header><h1>H</h1></header><p>x</p><aside>s</aside><form>f<p>g</form><footer>by</footer></article><header>site</header>", "H\nx"),
        ('<div class="ad">buy</div><div role="navigation">n</div><div hidden>h</div><div style="display: none">i</div><div class="story">text</div>', "text"),
        ("<article><p><b>one<br>\n<p>two</b> three</article><!-- <article>no</article> --> after", "one\ntwo three"),
        ("<article>  a \t\n b&nbsp;c </article", "a b c"),
        ("<p title=\"broken>text</p><article>x</article>", "x"),
        ("<article><p>1 < 2 and 3 > 2</p><textarea><p>no</p></textarea><style>p{}", "1 < 2 and 3 > 2"),
        ("<title>t</title><!-- unclosed <article>x</article>", ""),
    ],
)
def test_lines_of_a_page(html, want):
    assert text_of(html) == want


PAGES = "page_id bigint, url string, html string, text string, lines string, host string"


def test_differencing_without_marked_articles(spark):
    """Pages of bare blocks: what the nearest pages share goes, also when it repeats; numbers order by value."""
    page = lambda i, host, body: f"<div>{host}</div><div>Home</div><div>Home</div><p>{body}</p><div>Printed by {host}</div>"
    data = [(i, f"http://{h}/n/{i}?q=1", page(i, h, f"Story {i} of {h}")) for h in ("a.org", "b.org") for i in range(30)]
    data += [(900, "http://alone.org/1", page(1, "alone.org", "Single")), (901, None, page(1, "x", "No address")), (902, "http://[bad", "<p>Bad</p>")]
    df = spark.createDataFrame([(*r, "", "", "") for r in data], PAGES).repartition(5)
    got = {(r["page_id"], r["url"]): r["text"] for r in pages.main_text(df).collect()}
    for i, url, _ in data[:60]:
        assert got[i, url] == f"Story {i} of {url[7:12]}"
    assert got[900, "http://alone.org/1"] == "alone.org\nHome\nHome\nSingle\nPrinted by alone.org"
    assert got[901, None].endswith("No address\nPrinted by x") and got[902, "http://[bad"] == "Bad"


def test_shared_text_that_is_no_template(spark):
    """Quoted passages in marked articles stay, a share bar there goes; an article at two addresses stays whole."""
    quote = "<p>A passage that many articles quote.</p>"
    data = [(i, f"https://www.c.org/{i}", f"<article><h1>T{i}</h1>{quote}<div>Share this</div><p>Own words {i}</p></article>") for i in range(6)]
    copy = "<div>Top</div><p>The same long article stands here at two addresses of one host.</p><p>And goes on.</p>"
    data += [(10, "https://d.org/1", copy), (11, "https://d.org/2", copy), (12, "https://d.org/2", copy), (13, "https://d.org/3", "<div>Top</div><p>Another one.</p>")]
    df = spark.createDataFrame([(*r, "", "", "") for r in data], PAGES)
    got = {r["page_id"]: r["text"] for r in pages.main_text(df).collect()}
    assert all(got[i] == f"T{i}\nA passage that many articles quote.\nOwn words {i}" for i in range(6))
    assert all(got[i] == "The same long article stands here at two addresses of one host.\nAnd goes on." for i in (10, 11, 12)) and got[13] == "Another one."


def test_page_text_on_odd_rows(spark):
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30_000)) + "</article>"
    data = [(1, "http://e.org/1", None), (2, "http://e.org/2", ""), (None, "http://e.org/3", "<p>x</p>"), (3, "http://e.org/4", long), (3, "http://e.org/4", long), (4, "http://e.org/5", long[:-100])]
    got = rows(pages.main_text(spark.createDataFrame([(*r, "", "", "") for r in data], PAGES)))
    assert len(got) == 6 and all(n == len(t) for _, _, t, n in got)
    assert sorted(n for *_, n in got)[:3] == [0, 0, 1] and [t for i, _, t, _ in got if i == 3][0].count("\n") == 29_999
    assert pages.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_page_text_is_brute_force(spark, monkeypatch):
    """The job, in runs of 8 pages, against differencing of each whole host in one loop; and against the articles as they stand."""
    monkeypatch.setattr(pages, "RUN", 8)
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    data = df.collect()
    gone = {tuple(r)[:2]: r["gone"] for r in pages.deleted_lines(pages._keyed(df)).collect()}
    keys = {r["id"]: (r["k1"], r["k2"]) for r in pages._keyed(df).collect()}
    hosts: dict = {}
    for r in data:
        host, path = pages.place(r["url"])
        read = pages.page_lines(r["html"])
        arrays = [hash(t) for t, _ in read], [f for _, f in read], [len(t) for t, _ in read]
        hosts.setdefault(host, []).append((path, keys[r["page_id"]], pages._Page(keys[r["page_id"]], host, *map(np.array, arrays))))
    for own in hosts.values():
        own.sort(key=lambda x: x[:2])
        line = [p for *_, p in own]
        for i, p in enumerate(line):
            want = pages.template_lines(p, line[max(0, i - pages.REACH) : i][::-1], line[i + 1 : i + 1 + pages.REACH])
            assert gone.get(p.key, []) == want
    assert sum(map(bool, gone.values())) > 20
    got = {r["page_id"]: r["text"] for r in pages.main_text(df).collect()}
    for r in data:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(references.unescape(re.sub("</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
