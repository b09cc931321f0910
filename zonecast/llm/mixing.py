"""Language-model scoring by online logistic context mixing (operator 2).

Method: a text is a series of binary decisions.  Several predictors each look up how the bit went before in their hashed context
(the last two, three and five symbols, and the word so far); their logits are combined by weights that a gate (the place in the
word, and which contexts are new) selects; an adaptive probability map refines the result.  Weights and map go on learning inside each text, block by
block, from the trained state, so a text's score depends on nothing but the model and itself.  The sum of the logarithms is the
text's log probability, and in base 2 over its bytes the bits per byte.

The decisions of a symbol are the steps down a Huffman tree of the training symbols: lower-cased bytes of the words, one space after
each word, and an end.  About four steps stand for a symbol instead of eight, and any byte can be coded.

What is learned from the corpus, all of it by Spark and all of it growing with it: (1) symbol counts; (2) how often each symbol followed each
context, hence how often each bit was 0 and 1 there; (3) the start of weights and map: the mean, over the training texts with
remainder 1, of what each of them learns from contexts counted without these texts (scores use the counts of all training texts); (4) counts of
all words, for the base score.  A context is known by 56 bits of its hash, so there is no table of a fixed size that could fill.  Texts
are dealt into chunks of about ``CHUNK_BYTES``.  Each chunk sends its distinct words and its distinct pairs of context and symbol to
buckets, which add up and send back word counts and, for each pair, the logits on the symbol's way down the tree; the chunk is scored together
with them.  Keys travel one way only: buckets are ranges of keys, so what comes back, in the order of the buckets, belongs to the chunk's distinct
keys in ascending order, which its texts give again.  Buckets are as many as chunks, so no group grows beyond a chunk or a bucket; nothing but
symbol counts, weights and map is broadcast.

All counts and the mean are sums of integers and contexts never reach over a text's start, so scores don't depend on how the table is
partitioned.  Long texts are laid out in parts that carry the last symbols and the word so far.

Texts are stored folded (words in lower case, one space between them).  Where a chunk is scored, symbols that follow the same five symbols and
the same word so far are one kind: logits are looked up for kinds, not for symbols.  Texts of about the same length go through their blocks side
by side, which changes none of their results.

Null text is the empty text: one token, the end.  Rows without a doc_id count as held out.  Repeated rows are counted and scored one by one.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, passing
from .tokens import text_groups
from .words import mixed

FOLDS, WEIGHT_FOLD = 10, 1
CHUNK_BYTES = 12_000_000
#: The end of a text: a byte that no word holds.
END, SYMBOLS = 9, 256
END_WORD = np.uint64(0x9D8C7B6A59483726)
#: Two, three and five symbols, and the word so far.
PREDICTORS = 4
PLACES, CELLS = 8, 24
#: The gate: place in the word, and whether the two longest contexts have been seen.
GATES = 4 * PLACES
BLOCK, PART = 4096, 1 << 18
#: Texts side by side at most, and decisions of them at once.
TOGETHER, SIDE_BY_SIDE = 128, 16 * BLOCK
#: Symbols of equal contexts are found together among so many.
RUN = 1 << 21
#: A symbol plus one, zero where there is none, is a digit of the last symbols.
DIGIT = 259
WEIGHT_RATE, MAP_RATE = 0.05, 0.5
#: States are averaged as integers of this fraction.
FRACTION = 1 << 20
#: What a row of counts is about: words, contexts as they stand for scores, contexts without the weight fold.
WORDS, ALL, EARLY = 0, 1, 2


class Code:
    """Prefix code of the symbols: for each, its steps (inner node, bit), laid out one after the other."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        tree: dict[int, tuple[int, int]] = {}
        node = SYMBOLS
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            tree[node] = (x, y)
            heapq.heappush(heap, (a + b, node, node))
            node += 1
        steps: dict[int, list[tuple[int, int]]] = {}
        todo = [(node - 1, [])]
        while todo:
            at, path = todo.pop()
            if at < SYMBOLS:
                steps[at] = path
            else:
                todo += [(child, [*path, (at - SYMBOLS, bit)]) for bit, child in enumerate(tree[at])]
        self.length = np.array([len(steps[s]) for s in range(SYMBOLS)])
        self.start = np.cumsum(self.length) - self.length
        self.node = np.array([n for s in range(SYMBOLS) for n, _ in steps[s]], np.int64)
        self.bit = np.array([b for s in range(SYMBOLS) for _, b in steps[s]], np.uint8)
        # Place of each symbol among the leaves, and how many nodes two symbols' ways have in common.
        self.leaf = np.argsort(np.array(sorted(range(SYMBOLS), key=lambda s: [b for _, b in steps[s]])))
        nodes = np.full((SYMBOLS, int(self.length.max())), -1)
        for s, path in steps.items():
            nodes[s, : len(path)] = [n for n, _ in path]
        self.common = np.stack([((nodes == own) & (own >= 0)).sum(1) for own in nodes])

    def steps(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of steps of each symbol; of every step its number within the symbol, and its place in ``node`` and ``bit``."""
        count = self.length[symbols]
        ends = np.cumsum(count)
        within = np.arange(int(count.sum())) - np.repeat(ends - count, count)
        return count, within, within + np.repeat(self.start[symbols], count)


@lru_cache(maxsize=2)
def code_of(counts: tuple[int, ...]) -> Code:
    return Code(np.array(counts))


def symbols_of(own: list[bytes]) -> np.ndarray:
    """The symbols of one text, from its words in lower case; ``folded`` and ``symbols_in`` give those of a column."""
    raw = np.frombuffer(b" ".join(own), np.uint8)
    return np.append(raw, np.uint8(END))


#: A-Z in lower case, and every byte between words as a space.
_FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b" " * 5)


def bytes_of(part: pa.Array) -> tuple[np.ndarray, bytes]:
    """Where each string of an array starts and, last, where all end; and all their bytes.  Null strings are empty."""
    part = pc.fill_null(part.cast(pa.large_string()), "")
    if not len(part):
        return np.zeros(1, np.int64), b""
    edges = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
    return edges - edges[0], part.buffers()[2].slice(edges[0], edges[-1] - edges[0]).to_pybytes() if edges[-1] > edges[0] else b""


def folded(texts: pa.ChunkedArray) -> pa.ChunkedArray:
    """A-Z in lower case, one space between words, none before the first or behind the last; null texts are empty."""
    out = []
    for part in texts.chunks:
        edges, raw = bytes_of(part)
        raw = np.frombuffer(raw.translate(_FOLDED), np.uint8)
        kept = raw != 32
        begins, first = kept.copy(), edges[:-1][edges[:-1] < len(raw)]
        begins[1:] &= ~kept[:-1]
        begins[first] = kept[first]
        begin = np.flatnonzero(begins)
        later = np.ones(len(begin) + 1, bool)
        later[np.searchsorted(begin, edges[:-1])] = False
        kept[begin[later[:-1]] - 1] = True
        at = np.flatnonzero(kept)
        buffers = [None, pa.py_buffer(np.searchsorted(at, edges).astype(np.int64)), pa.py_buffer(raw[at])]
        out.append(pa.Array.from_buffers(pa.large_string(), len(part), buffers).cast(pa.string()))
    return pa.chunked_array(out, pa.string())


def symbols_in(texts: pa.ChunkedArray) -> list[np.ndarray]:
    """The symbols of each text of a folded column."""
    out: list[np.ndarray] = []
    for part in texts.chunks:
        edges, raw = bytes_of(part)
        all_symbols, edges = np.frombuffer(raw, np.uint8), edges.tolist()
        out += [np.append(all_symbols[a:b], np.uint8(END)) for a, b in zip(edges, edges[1:])]
    return out


@dataclass
class Lead:
    """What a part of a long text carries over: the last five symbols (each plus one), and place and hash of the word so far."""

    last: np.ndarray
    place: int
    word: np.uint64


_SMALL = mixed(np.arange(263 * 64, dtype=np.uint64))


def _word_symbols(x: np.ndarray) -> np.ndarray:
    """``mixed``, from a table where all values are small."""
    return _SMALL.take(x) if x.max(initial=0) < len(_SMALL) else mixed(x.astype(np.uint64))


def raw_contexts(symbols: np.ndarray, begins: np.ndarray, lead: Lead | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, Lead]:
    """For each symbol the last five as one number, the nearest first; hash of the word so far; place in the word; what the next part needs.

    ``begins`` are the positions where texts start, ascending; with ``lead`` the first symbols go on from an earlier part.
    """
    n, lead = len(symbols), lead or Lead(np.zeros(5, np.int64), 0, np.uint64(0))
    s = symbols.astype(np.int64) + 1
    padded = np.concatenate([lead.last, s])
    five = padded[4 : 4 + n].copy()
    for k in (3, 2, 1, 0):
        five *= DIGIT
        five += padded[k : k + n]
    for age in (4, 3, 2, 1, 0):  # nothing stands before a text: the symbol at this age has as many before it
        young = begins + age
        young, unit = young[young < n], DIGIT ** (5 - age)
        five[young] = five[young] // unit * unit
    gap = padded[4 : 4 + n] == 33
    gap[begins] = True
    first = np.flatnonzero(gap)
    # The word so far: the sum of its symbols, mixed with their places.  The word that the lead began stands before the first gap.
    spread = np.diff(np.concatenate([[0], first, [n]]))
    place = np.arange(n) - np.repeat(np.concatenate([[-lead.place], first]), spread)
    own = _word_symbols(s + 263 * place)
    total = np.cumsum(own) - own
    word = total - np.repeat(np.concatenate([np.zeros(1, np.uint64) - np.array([lead.word]), total[first]]), spread)
    return five, word, place, Lead(padded[-5:].copy(), int(place[-1]) + 1, (word[-1:] + own[-1:])[0])


def pair_of(k: int, context: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """56 bits of predictor ``k``'s context and the symbol as one number."""
    return mixed(context.astype(np.uint64) * np.uint64(PREDICTORS) + np.uint64(k)) << np.uint64(8) | symbols.astype(np.uint64)


def pairs_of(five: np.ndarray, word: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return np.stack([pair_of(k, context, symbols) for k, context in enumerate((five // DIGIT**3, five // DIGIT**2, five, word))])


def contexts(symbols: np.ndarray, begins: np.ndarray, lead: Lead | None = None) -> tuple[np.ndarray, np.ndarray, Lead]:
    """For each predictor and symbol its pair; place in the word; what the next part needs."""
    five, word, place, lead = raw_contexts(symbols, begins, lead)
    return pairs_of(five, word, symbols), place, lead


def raw_parts(texts: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of at most about ``PART`` symbols: the lengths of the texts in it, symbols, their last five, words so far, places.

    A text longer than a part stands alone, in parts; all but its last have a negative length.
    """
    held: list[np.ndarray] = []
    size = 0

    def together():
        lengths = [len(x) for x in held]
        symbols = np.concatenate(held)
        return lengths, symbols, *raw_contexts(symbols, np.cumsum([0, *lengths[:-1]]))[:3]

    for text in texts:
        if held and size + len(text) > PART:
            yield together()
            held, size = [], 0
        if len(text) <= PART:
            held.append(text)
            size += len(text)
            continue
        lead = None
        for at in range(0, len(text), PART):
            own = text[at : at + PART]
            *found, lead = raw_contexts(own, np.zeros(0 if at else 1, np.int64), lead)
            yield [len(own) if at + PART >= len(text) else -len(own)], own, *found
    if held:
        yield together()


def laid_out(texts: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """The parts with the pairs of every symbol: lengths, symbols, pairs, places."""
    for lengths, symbols, five, word, place in raw_parts(texts):
        yield lengths, symbols, pairs_of(five, word, symbols), place


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key stands first, ascending, and for every key its place among these.  ``keys`` are hashes."""
    # One sort of the keys' first bits with the position behind them; then the few whose first bits don't tell them apart.
    bits = np.uint64(len(keys).bit_length())
    first = np.sort(keys >> bits << bits | np.arange(len(keys), dtype=np.uint64))
    order = (first & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first >>= bits
    ordered = keys[order]
    same = np.append(False, first[1:] == first[:-1])[: len(keys)]
    mixed_up = np.flatnonzero(same[1:] & (ordered[1:] != ordered[:-1])) + 1
    if len(mixed_up):
        of = np.flatnonzero(np.isin(first, first[mixed_up]))
        order[of] = order[of][np.argsort(ordered[of], kind="stable")]
        ordered = keys[order]
    at = changes(ordered)
    leads = np.zeros(len(keys), bool)
    leads[order[at]] = True
    number = np.cumsum(leads, dtype=np.int32) - np.int32(1)
    place = np.empty(len(keys), np.int32)
    place[order] = number[order[at]].repeat(np.diff(at, append=len(keys)))
    return np.flatnonzero(leads), place


@dataclass
class Run:
    """Neighbouring parts.  Symbols that follow the same five symbols and the same word so far are alike in everything but their position;
    ``kind`` is the number of each symbol's kind, by first occurrence, so that what stands together is found together; ``words`` are the positions
    that end a word, and the rest describes the kinds (``place`` up to 255)."""

    lengths: list[int]
    kind: np.ndarray
    words: np.ndarray
    symbols: np.ndarray
    five: np.ndarray
    word: np.ndarray
    place: np.ndarray

    def pairs(self) -> np.ndarray:
        return pairs_of(self.five, self.word, self.symbols)

    def ends_word(self) -> np.ndarray:
        return ends_word(self.symbols, self.place)


def ends_word(symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (symbols == 32) | (symbols == END) & (place > 0)


def runs(texts: list[np.ndarray]) -> Iterator[Run]:
    held: list[tuple] = []

    def together() -> Run:
        lengths, keys, *rest = zip(*held)
        held.clear()
        at, kind = grouped(np.concatenate(keys))
        ends = np.concatenate([ends_word(own, place) for own, place in zip(rest[0], rest[-1])])
        return Run([n for own in lengths for n in own], kind, np.flatnonzero(ends).astype(np.int32), *(np.concatenate(x)[at] for x in rest))

    for lengths, symbols, five, word, place in raw_parts(texts):
        keys = (five * SYMBOLS + symbols).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word
        held.append((lengths, keys, symbols, five, word, np.minimum(place, 255).astype(np.uint8)))
        if sum(len(own) for _, own, *_ in held) >= RUN:
            yield together()
    if held:
        yield together()


def rows_of(sixteenths: np.ndarray, place: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """One number for each decision: in its bytes the predictors' logits in sixteenths, then twice the gate plus the bit."""
    out = np.zeros((len(bit), 8), np.int8)
    out[:, :PREDICTORS] = sixteenths.T
    out[:, PREDICTORS] = place.astype(np.int8) * 8 + (sixteenths[-1] == 0) * 4 + (sixteenths[-2] == 0) * 2 + bit
    return out.view(np.uint64).ravel()


#: Of gate and bit: the bit's sign.
_SIGN = np.tile(np.array([-1, 1], np.float32), GATES)


def learn_together(weights: np.ndarray, cells: np.ndarray, parts: list[np.ndarray], learning: int) -> np.ndarray:
    """Natural log probability of each part's rows; then the weights (predictor, part, gate) and maps (part, gate, cell) of the first
    ``learning`` parts learn from them.  A part's result doesn't depend on the others."""
    texts, sizes = len(parts), np.array([len(p) for p in parts])
    sides, rows = texts * 2 * GATES, np.concatenate(parts)
    # In the order of part, gate and bit, whatever goes by these is repeated and added up along the rows instead of looked up for each.
    side = rows.view(np.int8)[PREDICTORS::8].astype(np.uint16)
    if texts > 1:
        side += (np.arange(texts, dtype=np.uint16) * np.uint16(2 * GATES)).repeat(sizes)
    number = np.bincount(side, minlength=sides)
    x = np.empty((PREDICTORS, len(rows)), np.float32)
    x[:] = rows.take(side.argsort(kind="stable")).view(np.int8).reshape(-1, 8)[:, :PREDICTORS].T
    sign = np.tile(_SIGN, texts).repeat(number)
    scaled = (weights * np.float32(1 / 16)).repeat(2, axis=2).reshape(PREDICTORS, sides)
    z = x[0] * scaled[0].repeat(number)
    for k in range(1, PREDICTORS):
        z += x[k] * scaled[k].repeat(number)
    place = z * np.float32(1.5)
    place += np.float32(CELLS / 2)
    cell = np.clip(place, 0, CELLS - 1, out=place).astype(np.int64)
    cell += (np.arange(sides) * CELLS).repeat(number)
    miss = cells.repeat(2, axis=1).take(cell)
    miss += z
    miss *= sign
    miss *= np.float32(-0.5)
    odds = np.exp(np.minimum(miss, 30, out=miss), out=miss)
    odds += 1
    total = -np.add.reduceat(np.log(odds, out=odds).astype(np.float64), np.cumsum(sizes) - sizes)
    if not learning:
        return total
    sides, cut = learning * 2 * GATES, int(sizes[:learning].sum())
    number, sign, z, x, cell = number[:sides], sign[:cut], z[:cut], x[:, :cut], cell[:cut]
    z *= sign
    with np.errstate(over="ignore"):  # of what is infinite, nothing is left
        wrong = np.exp(z, out=z)
    wrong += 1
    np.divide(sign, wrong, out=wrong)
    has = np.flatnonzero(number)
    at = (np.cumsum(number) - number)[has]
    sums = np.zeros((PREDICTORS, sides), np.float32)
    for k in range(PREDICTORS):
        x[k] *= wrong
        sums[k, has] = np.add.reduceat(x[k], at)
    seen = number.reshape(learning, GATES, 2).sum(2) + 50.0
    weights[:, :learning] += (WEIGHT_RATE / 16 * sums.reshape(PREDICTORS, learning, GATES, 2).sum(3) / seen).astype(np.float32)
    counts = np.bincount(cell, minlength=sides * CELLS).reshape(learning, GATES, 2, CELLS)
    ones, own = counts[:, :, 1], cells[:learning]
    seen = counts[:, :, 0] + ones
    own += (MAP_RATE * (ones - seen / (1 + np.exp(-np.clip(own, -30, 30)))) / (seen + 50.0)).astype(np.float32)
    return total


class Mixer:
    """Weights by gate and refining map; they learn after every block."""

    def __init__(self, weights: np.ndarray | None = None, cells: np.ndarray | None = None):
        self.weights = np.full((PREDICTORS, GATES), 0.3, np.float32) if weights is None else weights.copy()
        line = (np.arange(CELLS) - CELLS / 2 + 0.5) / 1.5
        self.cells = np.tile(line, GATES).astype(np.float32) if cells is None else cells.copy()

    def learn(self, sixteenths: np.ndarray, place: np.ndarray, bit: np.ndarray) -> float:
        """Natural log probability of the bits, from the predictors' logits in sixteenths; then learns from them."""
        return self.learn_rows(rows_of(sixteenths, place, bit))

    def learn_rows(self, rows: np.ndarray) -> float:
        return float(learn_together(self.weights[:, None], self.cells.reshape(1, GATES, CELLS), [rows], 1)[0])

    def blocks(self, sixteenths: np.ndarray, place: np.ndarray, bit: np.ndarray) -> float:
        return self.block_rows(rows_of(sixteenths, place, bit))

    def block_rows(self, rows: np.ndarray) -> float:
        return sum(self.learn_rows(rows[b : b + BLOCK]) for b in range(0, len(rows), BLOCK))


class Known:
    """A chunk's distinct pairs, ascending, each with the logits on its symbol's way down the tree."""

    def __init__(self, code: Code, pairs: np.ndarray, logits: np.ndarray):
        length = code.length[(pairs & np.uint64(255)).astype(np.int64)]
        start = np.cumsum(length) - length
        self.code, self.pairs, self.start, self.logits = code, pairs, start, logits
        # Most pairs have a place of their own in one of two tables; the rest is searched for.
        bits = max(4, min(24, len(pairs).bit_length() + 1))
        self.places = [(np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)), (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(66 - bits))]
        self.tables, left, begin = [], self.pairs, self.start
        for factor, shift in self.places:
            table = np.zeros((1 << 64 - int(shift), 2), np.uint64)
            place = (left * factor >> shift).astype(np.int64)
            table[place, 0], table[place, 1] = left, begin
            other = table[place, 0] != left
            left, begin = left[other], begin[other]
            self.tables.append(table)

    def at(self, pairs: np.ndarray) -> np.ndarray:
        """Where the logits of each pair start."""
        (factor, shift), (factor_2, shift_2) = self.places
        found = self.tables[0].take((pairs * factor >> shift).astype(np.int64), axis=0)
        other = np.flatnonzero(found[:, 0] != pairs)
        if len(other):
            rest = pairs[other]
            again = self.tables[1].take((rest * factor_2 >> shift_2).astype(np.int64), axis=0)
            last = np.flatnonzero(again[:, 0] != rest)
            again[last, 1] = self.start[np.searchsorted(self.pairs, rest[last])]
            found[other, 1] = again[:, 1]
        return found[:, 1].astype(np.int64)

    def decisions(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each kind of symbol the number of decisions and where they start; the decisions."""
        count, within, step = self.code.steps(run.symbols)
        sixteenths = np.empty((PREDICTORS, len(step)), np.int8)
        for own, row in zip(run.pairs(), sixteenths):
            np.take(self.logits, np.repeat(self.at(own), count) + within, out=row)
        return count, np.cumsum(count) - count, rows_of(sixteenths, np.repeat(np.minimum(run.place, PLACES - 1), count), self.code.bit[step])

    def learned(self, of: Iterable[Run], start: tuple[np.ndarray, np.ndarray] | tuple[()] = (), states: bool = True) -> Iterator[tuple[float, int, Mixer]]:
        """Of each text: natural log probability, number of blocks, and the state it ends in (without ``states``, the one before its last block).

        Texts of about the same length go through their blocks side by side.  One that comes in parts goes alone.
        """
        held: tuple[float, int, Mixer] | None = None
        for run in of:
            counts, starts, rows = self.decisions(run)
            ends = np.cumsum([0, *map(abs, run.lengths)]).tolist()
            sizes = np.add.reduceat(counts.take(run.kind), ends[:-1]).tolist()

            def own(i: int) -> np.ndarray:
                kind = run.kind[ends[i] : ends[i + 1]].astype(np.int64)
                count = counts.take(kind)
                return rows.take(np.arange(sizes[i]) + (starts.take(kind) - np.cumsum(count) + count).repeat(count))

            out: list[tuple[float, int, Mixer] | None] = [None] * len(sizes)
            whole: list[int] = []
            for i, length in enumerate(run.lengths):
                if held is None and length > 0:
                    whole.append(i)
                    continue
                total, blocks, mixer = held or (0.0, 0, Mixer(*start))
                held = total + mixer.block_rows(own(i)), blocks - (-sizes[i] // BLOCK), mixer
                if length > 0:
                    out[i], held = held, None
            whole.sort(key=lambda i: -sizes[i])
            while whole:
                room = np.cumsum([min(sizes[i], BLOCK) for i in whole[:TOGETHER]])
                n = max(1, int(np.searchsorted(room, SIDE_BY_SIDE, "right")))
                some, whole = whole[:n], whole[n:]
                texts, first = [own(i) for i in some], Mixer(*start)
                weights, cells = np.repeat(first.weights[:, None], n, axis=1), np.tile(first.cells.reshape(1, GATES, CELLS), (n, 1, 1))
                totals = np.zeros(n)
                for b in range(0, sizes[some[0]], BLOCK):
                    parts = [text[b : b + BLOCK] for text in texts if len(text) > b]
                    totals[: len(parts)] += learn_together(weights[:, : len(parts)], cells[: len(parts)], parts, len(parts) if states else sum(len(text) > b + BLOCK for text in texts))
                for j, i in enumerate(some):
                    out[i] = float(totals[j]), -(-sizes[i] // BLOCK), Mixer(weights[:, j], cells[j].ravel())
            yield from (x for x in out if x is not None)


def chunked(docs: DataFrame) -> DataFrame:
    """chunk, doc_id, fold, text (folded): neighbouring rows in chunks of a bounded size of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for group in text_groups(batches):
            held += group.nbytes
            group = group.set_column(2, "text", folded(group.column("text")))
            yield from group.append_column("chunk", pa.array([number] * group.num_rows, pa.int64())).to_batches()
            if held >= CHUNK_BYTES:
                number, held = number + 1, 0

    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), fold.alias("fold"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fold int, text string, chunk bigint")


class Tally:
    """Distinct keys with two counts each, added up in parts."""

    def __init__(self):
        self.keys, self.counts = [], []

    def add(self, keys: np.ndarray, which: int | None) -> None:
        """Counts ``keys`` as ``which``; None: they are wanted, but not counted."""
        keys = np.sort(keys)
        at = changes(keys)
        counts = np.zeros((2, len(at)), np.int64)
        if which is not None:
            counts[which] = np.diff(at, append=len(keys))
        self.keys.append(keys[at])
        self.counts.append(counts)
        if len(self.keys) > 32:
            own, counts = self.total()
            self.keys, self.counts = [own], [counts]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return added(np.concatenate(self.keys), np.concatenate(self.counts, axis=1))[:2]


def changes(ascending: np.ndarray) -> np.ndarray:
    """Where each distinct key stands first."""
    return np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1])[: len(ascending)])


def symbol_pairs(ascending: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs with their counts of the predictors that know the last symbols, from the distinct numbers ``symbol * DIGIT**5 + five``: shorter
    contexts are what longer ones begin with, so those of a pair stand together."""
    for k, unit in ((2, 1), (1, DIGIT**2), (0, DIGIT**3)):
        own = ascending // unit
        at = changes(own)
        symbols, context = np.divmod(own[at], DIGIT**5 // unit)
        yield pair_of(k, context, symbols), np.add.reduceat(counts, at, axis=1) if len(at) else counts


def distinct(keys: np.ndarray) -> np.ndarray:
    """Ascending distinct keys.  (``np.unique`` without counts goes through a hash table, which is slower here than sorting.)"""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


class Distinct:
    """Distinct keys, found in parts."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(distinct(keys))
        if len(self.parts) > 32:
            self.parts = [self.keys()]

    def keys(self) -> np.ndarray:
        return distinct(np.concatenate([np.zeros(0, np.uint64), *self.parts]))


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their counts (2 rows), and the place of each key among the distinct ones."""
    order = np.argsort(keys, kind="stable")  # merges what is in order already
    keys = keys[order]
    at = changes(keys)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.arange(len(at)).repeat(np.diff(at, append=len(keys)))
    return keys[at], np.add.reduceat(counts[:, order], at, axis=1, dtype=np.int64) if len(at) else counts, inverse


def packed(x: np.ndarray) -> bytes:
    """Compressed, all first bytes before all second ones and so on."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(ascending: np.ndarray) -> bytes:
    return packed(np.diff(ascending, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys, in their order; a context's pairs stand together."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed_logits(code: Code, pairs: np.ndarray, logits: np.ndarray) -> bytes:
    """Without ``pairs``.  Each logit as its support for the bit that follows, less that of the step before: where a context has had one
    symbol all are the same.  All first steps stand before all second ones and so on."""
    length, _, step = code.steps((pairs & np.uint64(255)).astype(np.int64))
    start = np.cumsum(length) - length
    support = np.where(code.bit[step] == 1, logits, -logits)
    change = np.diff(support, prepend=np.int8(0))
    change[start] = support[start]
    planes = [change[start[length > k] + k] for k in range(int(length.max(initial=0)))]
    return zstandard.ZstdCompressor(level=3).compress(np.concatenate([np.zeros(0, np.int8), *planes]).tobytes())


def unpacked_logits(code: Code, pairs: np.ndarray, raw: bytes) -> np.ndarray:
    length, _, step = code.steps((pairs & np.uint64(255)).astype(np.int64))
    start, planes, at = np.cumsum(length) - length, np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.int8), 0
    if len(planes) != len(step):
        raise ValueError("logits of other pairs")
    support = np.zeros(len(step), np.int8)
    for k in range(int(length.max(initial=0))):
        place = start[length > k] + k
        support[place] = planes[at : at + len(place)] + (support[place - 1] if k else np.int8(0))
        at += len(place)
    return np.where(code.bit[step] == 1, support, -support)


TEXTS = pa.schema([("doc_id", pa.int64()), ("fold", pa.int32()), ("text", pa.string())])


def text_blocks(chunks: DataFrame) -> DataFrame:
    """chunk, texts: neighbouring rows of a chunk as one compressed block, for the shuffle that brings a chunk's texts and counts together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches):
            chunk = group.column("chunk").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(edges, edges[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, TEXTS) as stream:
                    stream.write_table(group.select(TEXTS.names).slice(a, b - a).cast(TEXTS))
                raw = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_pydict({"chunk": pa.array(chunk[a : a + 1]), "texts": pa.array([raw], pa.binary())})

    return chunks.mapInArrow(run, "chunk bigint, texts binary")


def texts_of(blocks: pa.Table) -> pa.Table:
    raw = (zstandard.ZstdDecompressor().decompress(x.as_py()) for x in blocks.column("texts"))
    return pa.concat_tables([TEXTS.empty_table(), *(pa.ipc.open_stream(x).read_all() for x in raw)])


def symbol_counts_of(chunks: DataFrame) -> tuple[int, ...]:
    """How often each symbol stands in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS, np.int64)
        for group in text_groups(batches):
            for part in group.column("text").chunks:
                total += np.bincount(np.frombuffer(bytes_of(part)[1], np.uint8), minlength=SYMBOLS)
                total[END] += len(part)
        yield pa.RecordBatch.from_pydict({"symbols": pa.array([total.tolist()], pa.list_(pa.int64()))})

    rows = chunks.where("fold <> 0").select("text").mapInArrow(run, "symbols array<bigint>")
    symbols = dict(rows.select(F.posexplode("symbols").alias("s", "n")).groupBy("s").agg(F.sum("n")).collect())  # 256 rows
    return tuple(symbols.get(s, 0) for s in range(SYMBOLS))


SENT = "chunk bigint, bucket bigint, kind int, keys binary, counts binary, early binary"


def sent_rows(chunks: DataFrame, buckets: int) -> DataFrame:
    """Of each chunk and bucket the distinct words and pairs with their counts in its training texts: outside the weight fold, and
    in it (``early``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"chunk": None}

        def begin(chunk: int) -> None:
            state.update(chunk=chunk, tallies=(Tally(), Tally(), Tally()), held={}, size={})

        def add(which: int | None, found: tuple[list, list, list]) -> None:
            for tally, keys in zip(state["tallies"], found):
                if keys:
                    tally.add(np.concatenate(keys), which)
                keys.clear()

        def spend(which: int | None) -> None:
            own = state["held"].pop(which)
            state["size"].pop(which)
            state["tallies"][0].add(np.full(len(own), END_WORD), which)
            found: tuple[list, list, list] = ([], [], [])
            for _, symbols, five, word, place in raw_parts(own):
                found[0].append(mixed(word[ends_word(symbols, place)]))
                found[1].append(symbols.astype(np.int64) * DIGIT**5 + five)
                found[2].append(pair_of(3, word, symbols))
                if sum(map(len, found[1])) >= RUN:
                    add(which, found)
            add(which, found)

        def flush() -> Iterator[pa.RecordBatch]:
            if state["chunk"] is None:
                return
            for which in list(state["held"]):
                spend(which)
            rows: list[tuple] = []
            seen, last, so_far = (tally.total() for tally in state["tallies"])
            pairs = [np.concatenate(x, axis=-1) for x in zip(*symbol_pairs(*last), so_far)]
            order = np.argsort(pairs[0])
            for kind, (keys, counts) in enumerate((seen, (pairs[0][order], pairs[1][:, order]))):
                counts, bucket = counts.astype(np.uint32), bucket_of(keys, buckets)
                edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
                rows += [(int(bucket[a]), kind, packed_keys(keys[a:b]), packed(counts[0, a:b]), packed(counts[1, a:b])) for a, b in zip(edges, edges[1:])]
            cols = [[state["chunk"]] * len(rows), *zip(*rows)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in SENT.split(", ")])

        for group in text_groups(batches):
            for chunk, fold, text in zip(group.column("chunk").to_pylist(), group.column("fold").to_pylist(), symbols_in(group.column("text"))):
                if chunk != state["chunk"]:
                    yield from flush()
                    begin(chunk)
                which = None if fold == 0 else int(fold == WEIGHT_FOLD)
                state["held"].setdefault(which, []).append(text)
                state["size"][which] = state["size"].get(which, 0) + len(text)
                if state["size"][which] > RUN:
                    spend(which)
        yield from flush()

    return chunks.mapInArrow(run, SENT)


def path_logits(code: Code, pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending pairs, how many steps each symbol has, and of every step the logit in sixteenths that the counts give in its context."""
    symbols = (pairs & np.uint64(255)).astype(np.int64)
    length = code.length[symbols]
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.int8)
    # Within a context, symbols in the order of the tree's leaves: those below a node stand together.
    context = np.cumsum(np.append(False, np.diff(pairs >> np.uint64(8)) != 0)[: len(pairs)])
    order = np.argsort(context * SYMBOLS + code.leaf[symbols], kind="stable")
    context, symbols, counts = context[order], symbols[order], counts[order]
    begin, step, length_in_order = start[order], code.start[symbols], length[order]
    common = np.where(context[1:] == context[:-1], code.common[symbols[1:], symbols[:-1]], 0)
    own = np.arange(len(pairs))
    for depth in range(int(length.max(initial=0))):
        own = own[length_in_order[own] > depth]
        at = np.flatnonzero(np.append(True, common[own[1:] - 1] <= depth))
        n = counts[own]
        total, ones = np.add.reduceat(n, at), np.add.reduceat(n * code.bit[step[own] + depth], at)
        logit = np.log((ones + 0.4) / (total - ones + 0.4))
        out[begin[own] + depth] = np.clip(np.round(logit * 16), -127, 127).astype(np.int8).repeat(np.diff(at, append=len(own)))
    return length, out


COUNTED = "chunk bigint, kind int, bucket bigint, counts binary, tokens bigint, distinct_words bigint"


def corpus_counts(rows: DataFrame, symbol_counts: tuple[int, ...]) -> DataFrame:
    """What the buckets send back to each chunk, in the order of its keys: counts of its words, logits of its pairs, and of those in its weight fold
    once more the logits without that fold; and once for each bucket its training tokens and distinct training words."""

    def run(table: pa.Table) -> pa.Table:
        kind, bucket, chunk = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py(), table.column("chunk").to_pylist()
        keys = [unpacked_keys(x.as_py()) for x in table.column("keys")]
        plain, early = (np.concatenate([unpacked(x.as_py(), np.uint32) for x in table.column(c)]) for c in ("counts", "early"))
        own, counts, inverse = added(np.concatenate(keys), np.stack([plain, early]))
        ends, out = np.cumsum([0, *map(len, keys)]), []
        if kind == WORDS:
            total = counts.sum(0)
            out = [(c, WORDS, bucket, packed(total[inverse[a:b]]), 0, 0) for c, a, b in zip(chunk, ends, ends[1:])]
            out[0] = (*out[0][:4], int(total.sum()), int((total > 0).sum()))
        else:
            code = code_of(symbol_counts)
            for which, n in ((ALL, counts.sum(0)), (EARLY, counts[0])):
                length, logits = path_logits(code, own, n)
                start = np.cumsum(length) - length
                for c, k, a, b in zip(chunk, keys, ends, ends[1:]):
                    place = inverse[a:b]
                    if which == EARLY:
                        k, place = k[early[a:b] > 0], place[early[a:b] > 0]
                    if len(k):
                        count = length[place]
                        steps = np.arange(int(count.sum())) + np.repeat(start[place] - np.cumsum(count) + count, count)
                        out.append((c, which, bucket, packed_logits(code, k, logits[steps]), 0, 0))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in COUNTED.split(", ")])

    return rows.groupBy("bucket", "kind").applyInArrow(run, COUNTED)


def in_order(rows: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """What came back of a kind, with its bucket."""
    return sorted((b.as_py(), c.as_py()) for b, c, x in zip(*(rows.column(x) for x in ("bucket", "counts", "kind"))) if x.as_py() == kind)


def known(code: Code, rows: pa.Table, kind: int, pairs: np.ndarray, buckets: int) -> Known:
    """``pairs``: the chunk's distinct ones, ascending."""
    own = in_order(rows, kind)
    ends = np.searchsorted(bucket_of(pairs, buckets), np.arange(buckets + 1))
    if {b for b, _ in own} != set(np.flatnonzero(np.diff(ends)).tolist()):
        raise ValueError("logits of other pairs")
    return Known(code, pairs, np.concatenate([np.zeros(0, np.int8), *(unpacked_logits(code, pairs[ends[b] : ends[b + 1]], raw) for b, raw in own)]))


def start_state(chunks: DataFrame, counted: DataFrame, symbol_counts: tuple[int, ...], buckets: int) -> tuple[list[float], list[float]]:
    """Weights and map to start from: what each text of the weight fold learns from the plain ones, averaged by the texts' blocks."""

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        own = symbols_in(texts.column("text"))
        total, n = np.zeros(PREDICTORS * GATES + GATES * CELLS, np.int64), 0
        if own:
            parts, pairs = list(runs(own)), Distinct()
            for part in parts:
                pairs.add(part.pairs().ravel())
            for _, blocks, mixer in known(code_of(symbol_counts), rows, EARLY, pairs.keys(), buckets).learned(parts):
                total += blocks * np.rint(np.concatenate([mixer.weights.ravel(), mixer.cells]) * FRACTION).astype(np.int64)
                n += blocks
        return pa.table({"n": pa.array([n], pa.int64()), "state": pa.array([total.tolist()], pa.list_(pa.int64()))})

    texts = chunks.where(F.col("fold") == WEIGHT_FOLD).select("chunk", "text").groupBy("chunk")
    wanted = counted.where(F.col("kind") == EARLY).select("chunk", "kind", "bucket", "counts").groupBy("chunk")
    rows = texts.cogroup(wanted).applyInArrow(run, "n bigint, state array<bigint>")
    sums = rows.select("n", F.posexplode("state").alias("place", "value")).groupBy("place").agg(F.sum("value"), F.sum("n")).collect()  # 896 rows
    means = {place: value / n / FRACTION for place, value, n in sums if n}
    plain = np.concatenate([Mixer().weights.ravel(), Mixer().cells]).tolist()
    state = [means.get(i, x) for i, x in enumerate(plain)]
    return state[: PREDICTORS * GATES], state[PREDICTORS * GATES :]


def word_counts(of: Iterable[Run], h: np.ndarray, c: np.ndarray) -> Iterator[np.ndarray]:
    """Of each text the counts of its words and of its end; ``h`` are all words, ascending, ``c`` their counts."""
    held, end_count = [], c[np.searchsorted(h, [END_WORD])]
    for run in of:
        ends = run.ends_word()
        count = np.zeros(len(ends), np.int64)
        count[ends] = c[np.searchsorted(h, mixed(run.word[ends]))]
        count = count.take(run.kind.take(run.words))
        edges = np.searchsorted(run.words, np.cumsum([0, *map(abs, run.lengths)])).tolist()
        for length, a, b in zip(run.lengths, edges, edges[1:]):
            held.append(count[a:b])
            if length > 0:
                yield np.concatenate([*held, end_count])
                held = []


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"


def scores(docs: DataFrame) -> DataFrame:
    """Base score and model score of every document."""
    spark = docs.sparkSession
    with passing(spark) as keep:
        chunks = keep(chunked(docs), "chunks")
        buckets = max(8, chunks.select("chunk").distinct().count())
        symbol_counts = symbol_counts_of(chunks)
        counted = keep(corpus_counts(sent_rows(chunks, buckets), symbol_counts), "counts")
        n, v = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct_words"), F.lit(0))).first()
    weights, cells = start_state(chunks, counted, symbol_counts, buckets)
    start = (np.array(weights, np.float32).reshape(PREDICTORS, GATES), np.array(cells, np.float32))
    below = math.log10(n + 0.1 * (v + 1))

    def run(blocks: pa.Table, rows: pa.Table) -> pa.Table:
        texts, seen, pairs = texts_of(blocks), Distinct(), Distinct()
        own = symbols_in(texts.column("text"))
        parts = list(runs(own))
        for part in parts:
            seen.add(np.append(mixed(part.word[part.ends_word()]), END_WORD))
            pairs.add(part.pairs().ravel())
        h, c = seen.keys(), np.concatenate([np.zeros(0, np.int64), *(unpacked(raw, np.int64) for _, raw in in_order(rows, WORDS))])
        if texts.num_rows and len(h) != len(c):
            raise ValueError("counts of other words")
        out, learned = [], known(code_of(symbol_counts), rows, ALL, pairs.keys(), buckets).learned(parts, start, states=False)
        for doc_id, fold, text, count, (total, _, _) in zip(texts.column("doc_id").to_pylist(), texts.column("fold").to_pylist(), own, word_counts(parts, h, c), learned):
            score, size = total / math.log(10), len(text) + (len(count) > 1)
            out.append((doc_id, fold == 0, len(count), int((count > 0).sum()), n, float(np.log10(count + 0.1).sum()) - len(count) * below, score, -score / math.log10(2) / size))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        names = [f.split()[0] for f in RESULT.split(", ")]
        return pa.table([pa.array(col, kind) for col, kind in zip(list(zip(*out)) or [()] * 8, kinds)], names=names)

    back = counted.where(F.col("kind") != EARLY).select("chunk", "kind", "bucket", "counts")
    return text_blocks(chunks).groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir).select("doc_id", "text"))
