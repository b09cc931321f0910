"""Main text of web pages (operator 13).

Method: nearest-URL page differencing.  Each page becomes lines (one for each block of text).  Within a host, pages are ordered by URL path, numbers by
value, and paired with the nearest ones in that order.  The lines of a pair are aligned by their longest common subsequence, and the lines
they share are deleted: a template repeats, an article doesn't.  What stays and isn't menu, header, footer, sidebar, notice, advert,
form or comment by its markup is the text.

Two kinds of shared lines are no template and stay.  Running text (paragraph, heading, list item, quote, code, cell that isn't just a link)
inside a marked article: passages are quoted and republished.  And lines of a pair that shares far more than the page shares with its other
neighbours: one article at two addresses, which says nothing of the template; the next page in the order stands in.

Scale: only hashes of lines are shuffled to be compared, about a tenth of the pages' size.  They are range-partitioned by (host, path), so one
host's pages spread over many tasks, and numbered; runs of ``RUN`` pages with ``REACH`` neighbours to either side are a unit of work.
Pages meet the list of their deleted lines by a join on the hash of their content, whose hot keys Spark can split, and are
read into lines again.  The alignment keeps one bit a pair of lines and splits itself beyond ``ALIGN_BITS``.

A null or empty html gives an empty text.  A page without a usable URL, or alone on its host, has no partner: its markup alone decides.  Rows with equal
url and html are one page in the comparison and get the same text.  Null ids stay null.  Other columns are left alone.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, shuffle_partitions, store
from .tokens import text_groups

#: Pages compared with a page: the nearest ``PAIRS`` usable ones to either side, among ``REACH``.
PAIRS, REACH, RUN = 2, 4, 256
#: A page of which a neighbour lacks less than this share says nothing of the template.
SAME = 0.1
#: Bits that one alignment may hold before it is split.
ALIGN_BITS = 1 << 28

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header"
    " hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup (the end tag alone ends them) and never text of the page.
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math object canvas audio video".split())
_NEVER = frozenset("nav footer aside form button select datalist dialog menu head search".split())
_RUNNING = frozenset("article blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li main p pre td th caption".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Words of class and id attributes that name what is no article.
_NAMES = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|newsletter|subscri\w+|social|shar(?:e|ing)|sidebar|menu|nav|navbar"
    r"|navigation|breadcrumbs?|footer|masthead|header|topbar|comments?|commentlist|disqus|repl(?:y|ies)|respond|related|recommend\w*|teasers?|popup|modal|overlay|widgets?"
    r"|pagination|pager|login|signup|toolbar|skiplink)"
)
_OF_ARTICLE = re.compile(r"(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|related|recommend\w*|teasers?|widgets?)")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?/][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: What is known of a line: it can be text of the page; it lies in a marked article; it is running text there.
OPEN, MARKED, RUNNING = 1, 2, 4


def _is_no_article(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _NEVER or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    found = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role", "").lower() in _ROLES:
        return True
    names, known = f"{found.get('class', '')} {found.get('id', '')}".lower(), _OF_ARTICLE if tag == "article" else _NAMES
    return any(known.fullmatch(w) for w in re.split(r"[^a-z]+", names) if w)


def page_lines(html: str) -> list[tuple[str, int]]:
    """The page's lines in order: the text of each block, white space collapsed, and what is known of it."""
    out: list[tuple[str, int, int]] = []  # text, flags, 2 in an article, 1 in a main element
    stack: list[tuple[str, bool, int]] = []  # tag, whether it is out, region so far
    block: list[str] = []
    linked = plain = 0  # characters of the block within links and beside them
    links = 0
    at, n = 0, len(html)

    def end_block() -> None:
        nonlocal linked, plain
        if not block:
            return
        text = " ".join("".join(block).split())
        if text:
            outside, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
            inner = next((t for t, _, _ in reversed(stack) if t in _BLOCKS), "")
            runs = inner in _RUNNING and (plain > 0 or inner in ("h1", "h2"))
            out.append((text, OPEN * (not outside) + RUNNING * runs, region))
        block.clear()
        linked = plain = 0

    def add(text: str) -> None:
        nonlocal linked, plain
        if text:
            block.append(references.unescape(text) if "&" in text else text)
            size = len(text) - text.count(" ")
            linked, plain = (linked + size, plain) if links else (linked, plain + size)

    def close(k: int) -> None:
        nonlocal links
        if any(t in _BLOCKS for t, _, _ in stack[k:]):
            end_block()
        links -= sum(t == "a" for t, _, _ in stack[k:])
        del stack[k:]

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            # an inline element's end doesn't reach out of the block in which it stands
            if k is not None and (tag in _BLOCKS or not any(t in _BLOCKS for t, _, _ in stack[k + 1 :])):
                close(k)
            elif tag in _BLOCKS:
                end_block()
            continue
        if tag in _RAW:
            if tag in ("svg", "math") and m[3].endswith("/"):
                continue
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag == "br" or tag == "wbr":
            block.append(" " if tag == "br" else "")
            continue
        if tag in _BLOCKS:
            end_block()
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an item the one before it
                t = stack[i][0]
                if t == "p" or (t == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    close(i)
                    break
                if t in _BLOCKS:
                    break
        if tag in _VOID or (tag not in _BLOCKS and tag != "a" and not m[3]):
            continue  # a plain inline element says nothing
        outside, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        outside = outside or _is_no_article(tag, m[3], region == 2)
        role = 2 if tag == "article" else 1 if tag == "main" or re.search(r"role\s*=\s*[\"']?main\b", m[3]) else 0
        links += tag == "a"
        stack.append((tag, outside, region if outside else max(region, role)))
    end_block()
    best = max((region for _, flags, region in out if flags & OPEN), default=0)
    lines = []
    for text, flags, region in out:
        inside = region == best
        lines.append((text, (flags & OPEN) * inside + MARKED * (inside and best > 0) + (flags & RUNNING) * (inside and best > 0)))
    return lines


def place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, the path in a form that orders numbers by value; two empty strings if there is no host."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return "", ""
    path = re.sub(r"(?:/index)?(?:\.\w{1,5})?/*\Z", "", parts.path)
    return host, re.sub(r"\d+", lambda x: x[0].lstrip("0").zfill(20), path) if host else ""


def _table(b: Sequence[int]) -> dict[int, int]:
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    return where


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``."""
    where, every = _table(b), (1 << len(b)) - 1
    v = every
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & every
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _align(a: list[int], b: list[int], base_a: int, base_b: int, out: list[tuple[int, int]]) -> None:
    if not a or not b:
        return
    if len(a) * len(b) > ALIGN_BITS and len(a) > 1:
        half = len(a) // 2
        cut = int((_lengths(a[:half], b) + _lengths(a[: half - 1 : -1], b[::-1])[::-1]).argmax())
        _align(a[:half], b[:cut], base_a, base_b, out)
        _align(a[half:], b[cut:], base_a + half, base_b + cut, out)
        return
    where, every, size = _table(b), (1 << len(b)) - 1, len(b) // 8 + 1
    v, rows = every, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & every
        rows.append(v.to_bytes(size, "little"))
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[i - 1][(j - 1) >> 3] >> ((j - 1) & 7) & 1:
            j -= 1
        else:
            i -= 1
            if i == 0 or rows[i - 1][(j - 1) >> 3] >> ((j - 1) & 7) & 1:
                j -= 1
                found.append((base_a + i, base_b + j))
    out.extend(reversed(found))


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Places of one longest common subsequence of ``a`` and ``b``, in order.  Lines that one side lacks are left out before the alignment."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    both = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    ia = [i for i in range(start, len(a) - end) if a[i] in both]
    ib = [j for j in range(start, len(b) - end) if b[j] in both]
    middle: list[tuple[int, int]] = []
    _align([a[i] for i in ia], [b[j] for j in ib], 0, 0, middle)
    out = [(k, k) for k in range(start)] + [(ia[i], ib[j]) for i, j in middle]
    return out + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


class _Page:
    def __init__(self, key: tuple, host: str, lines: np.ndarray, flags: np.ndarray, sizes: np.ndarray):
        self.key, self.host, self.lines, self.flags, self.sizes = key, host, lines.tolist(), flags, sizes
        self.open = int(sizes[(flags & OPEN) > 0].sum())

    def shared(self, other: _Page) -> tuple[list[int], float]:
        """Own lines that the other page has, too, and their share of the own open text."""
        own = [i for i, _ in common_lines(self.lines, other.lines)]
        return own, int(self.sizes[own][(self.flags[own] & OPEN) > 0].sum()) / max(1, self.open)


def template_lines(page: _Page, before: list[_Page], after: list[_Page]) -> list[int]:
    """Lines of ``page`` to delete; neighbours are in order, nearest first.  What it shares with the least similar neighbour is taken as the
    size of the template; a neighbour that shares most of the rest, too, or nearly everything, holds the same article."""
    if not page.open:
        return []
    sides = [[page.shared(other) for other in side if other.host == page.host] for side in (before, after)]
    template = min((share for side in sides for _, share in side), default=0.0)
    gone: set[int] = set()
    for side in sides:
        usable = [own for own, share in side if 1 - share >= max(SAME, (1 - template) / 2)]
        gone.update(*usable[:PAIRS])
    return sorted(i for i in gone if not page.flags[i] & RUNNING)


def _keyed(pages: DataFrame) -> DataFrame:
    url, html = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").alias("id"), url.alias("url"), html.alias("text"))
    # length and two hashes name the content
    return rows.withColumns({"k1": F.xxhash64("url", "text"), "k2": F.xxhash64(F.lit(7), "text", F.length("text"), "url")})


def deleted_lines(pages: DataFrame) -> DataFrame:
    """k1, k2 and gone (numbers of lines) of the pages that share lines with their neighbours; ``pages`` as ``_keyed`` gives them."""
    spark = pages.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            out: dict[str, list] = {k: [] for k in ("host", "path", "lines", "flags", "sizes")}
            for url, text in zip(group.column("url").to_pylist(), group.column("text").to_pylist()):
                lines, (host, path) = page_lines(text), place(url)
                values = (host, path, [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for t, _ in lines], [f for _, f in lines], [len(t) for t, _ in lines])
                for k, v in zip(out, values):
                    out[k].append(v)
            kinds = {"lines": pa.list_(pa.int64()), "flags": pa.list_(pa.int8()), "sizes": pa.list_(pa.int32())}
            cols = {"k1": group.column("k1"), "k2": group.column("k2")} | {k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()}
            yield from pa.table(cols).to_batches()

    schema = "k1 bigint, k2 bigint, host string, path string, lines array<bigint>, flags array<tinyint>, sizes array<int>"
    drawn = store(map_rows(pages.select("k1", "k2", "url", "text"), read, schema).where("host <> '' and size(lines) > 0"), "lines")
    drawn = drawn.dropDuplicates(["k1", "k2"])
    order = ["host", "path", "k1", "k2"]
    ordered = drawn.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    first = F.lit((1 << 33) - 1).cast("bigint")
    n = F.monotonically_increasing_id()
    ordered = store(ordered.withColumns({"part": F.shiftright(n, 33), "pos": n.bitwiseAND(first)}), "ordered")
    counts = ordered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row for each task
    starts = np.cumsum([0, *(r["n"] for r in counts)]).tolist()
    offsets = spark.createDataFrame([(r["part"], s) for r, s in zip(counts, starts)], "part bigint, start bigint")
    numbered = ordered.join(F.broadcast(offsets), "part").withColumn("rank", F.col("start") + F.col("pos")).drop("part", "pos", "start", "path")
    own, at = F.floor(F.col("rank") / RUN), F.col("rank") % RUN
    to = F.array_distinct(F.array(own, F.when(at < REACH, own - 1).otherwise(own), F.when(at >= RUN - REACH, own + 1).otherwise(own)))
    runs = numbered.withColumn("run", F.explode(to)).where("run >= 0").repartition(shuffle_partitions(spark), "run").sortWithinPartitions("run", "rank")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, _Page]] = []
        now = None

        def settle() -> Iterator[pa.RecordBatch]:
            found = []
            for i, (rank, page) in enumerate(held):
                if rank // RUN == now:
                    near = [p for _, p in held[max(0, i - REACH) : i]][::-1], [p for _, p in held[i + 1 : i + 1 + REACH]]
                    if gone := template_lines(page, *near):
                        found.append((*page.key, gone))
            if found:
                k1, k2, gone = zip(*found)
                yield pa.RecordBatch.from_pydict({"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "gone": pa.array(gone, pa.list_(pa.int32()))})

        for batch in batches:
            k1, k2, run, rank, host = (batch.column(c).to_pylist() for c in ("k1", "k2", "run", "rank", "host"))
            for i in range(batch.num_rows):
                if run[i] != now:
                    yield from settle()
                    held, now = [], run[i]
                arrays = (batch.column(c)[i].values.to_numpy() for c in ("lines", "flags", "sizes"))
                held.append((rank[i], _Page((k1[i], k2[i]), host[i], *arrays)))
        yield from settle()

    return map_rows(runs, compare, "k1 bigint, k2 bigint, gone array<int>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: a row for each row of ``pages`` (page_id, url, html)."""
    keyed = _keyed(pages)
    gone = store(deleted_lines(keyed), "deleted")
    kind = keyed.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            texts = []
            for html, own in zip(group.column("text").to_pylist(), group.column("gone").to_pylist()):
                out = set(own or ())
                texts.append("\n".join(t for i, (t, flags) in enumerate(page_lines(html)) if flags & OPEN and i not in out))
            cols = {"page_id": group.column("id"), "url": group.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield from pa.table(cols).to_batches()

    both = keyed.join(gone, ["k1", "k2"], "left").select("id", "url", "text", "gone")
    return map_rows(both, run, f"page_id {kind.simpleString()}, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
