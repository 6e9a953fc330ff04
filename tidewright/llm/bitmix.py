"""Online logistic mixing of hashed-context bit predictors: the arithmetic, without Spark.

A series of symbols (the words of a text, or the letters of a word) is coded bit by bit by a Huffman code. Every bit
is predicted from several contexts, what came before its symbol. A context and the place in the code hash to a slot
that counts zeros and ones; the slots' log odds are combined by weights that a gate chooses, the weights move after
every block of a series, and a table of observed rates refines the mix.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PREDICTORS = 3
# The commonest words tell what the text around is about (its language, above all).
MARKERS = 32
# Symbols of a block: a series' weights move after each.
BLOCK = 128
# Symbols a mixer learns from at once: it takes a step after each so many.
GROUP = 16384
# Symbols counted or scored at once, whole blocks: enough for the tables to stay in the cache from one to the next.
STRETCH = 32768
# How many blocks the trained weights count for when a series refines them.
INERTIA = 20.0
BUCKETS = 128
LIMIT = 12.0
LEVELS = 3
# The constant that stands beside the predictors.
EVEN = np.float32(0.3)
GATES = LEVELS * LEVELS

_MIX = [np.uint32(2654435761 + 2 * 362437 * i) for i in range(PREDICTORS)]
_STEP = np.uint32(0x9E3779B1)


def huffman(counts: Sequence[int]) -> list[list[tuple[int, int]]]:
    """For every symbol its path from the root: (node, bit)."""
    heap = [(c, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    above: dict[int, tuple[int, int]] = {}
    n = len(counts)
    node = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        above[a[1]], above[b[1]] = (node, 0), (node, 1)
        heapq.heappush(heap, (a[0] + b[0], node))
        node += 1
    paths = []
    for i in range(n):
        path, at = [], i
        while at in above:
            path.append((above[at][0] - n, above[at][1]))
            at = above[at][0]
        paths.append(path[::-1])
    return paths


class Code:
    """A Huffman code: per symbol its bits and the nodes they are taken at."""

    def __init__(self, counts: Sequence[int]):
        paths = huffman(counts)
        self.sizes = np.array([len(p) for p in paths], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        # A node and its bit, in one number.
        self.steps = np.array([2 * node + bit for p in paths for node, bit in p], dtype=np.uint32)


class Vocabulary:
    """The symbols of a text: its frequent words, an end, and one for all other words."""

    def __init__(self, words: Sequence[bytes], counts: Sequence[int], others: int, texts: int):
        self.words = pa.array(words, pa.binary())
        self.end, self.other = len(words), len(words) + 1
        self.marker = np.zeros(len(words) + 2, dtype=bool)
        self.marker[np.argsort(-np.asarray(counts, dtype=np.int64), kind="stable")[:MARKERS]] = True
        self.code = Code([*counts, texts + 1, others + 1])

    def symbols(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=self.words)
        return pc.fill_null(found, self.other).to_numpy(zero_copy_only=False)


def last_bytes(words: pa.Array) -> np.ndarray:
    """The last three bytes of every word as a number, zeros before a shorter one."""
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32, count=len(words) + 1 + words.offset)[words.offset :].astype(np.int64)
    out = np.zeros(len(words), dtype=np.uint32)
    for back in (1, 2, 3):
        there = np.flatnonzero(np.diff(ends) >= back)
        out[there] |= data[ends[1:][there] - back].astype(np.uint32) << np.uint32(8 * (back - 1))
    return out


@dataclass
class Series:
    """Symbols of several series, one after the other, with the hashes of each symbol's contexts."""

    symbols: np.ndarray
    sizes: np.ndarray
    contexts: list[np.ndarray]


def text_series(tokens: np.ndarray, sizes: np.ndarray, words: pa.Array, vocabulary: Vocabulary) -> Series:
    """Texts as series of words and an end; ``tokens`` are places in ``words``. Contexts: the last marker word; the
    word before (a rare one by its last three bytes); the two words before in brief (by their last two bytes, but for
    marker words)."""
    symbols, tail = vocabulary.symbols(words), last_bytes(words)
    named = (symbols.astype(np.uint32) + np.uint32(1)) * _STEP
    whole = np.where(symbols == vocabulary.other, tail * np.uint32(0xC2B2AE35) + np.uint32(7), named)
    brief = np.where(vocabulary.marker[symbols], named, (tail & np.uint32(0xFFFF)) * np.uint32(0x85EBCA6B) + np.uint32(3))
    lengths = sizes + 1
    begins, n = np.cumsum(lengths) - lengths, int(lengths.sum())
    is_end = np.zeros(n, dtype=bool)
    is_end[begins + sizes] = True
    symbol = np.full(n, vocabulary.end, dtype=np.int32)
    symbol[~is_end] = symbols[tokens]
    # The end of a text hashes to zero, which is what its follower has before it.
    own, short = (np.zeros(n, dtype=np.uint32) for _ in range(2))
    own[~is_end], short[~is_end] = whole[tokens], brief[tokens]
    last, first, second, marker = (np.zeros(n, dtype=np.uint32) for _ in range(4))
    last[1:], first[1:], second[2:] = own[:-1], short[:-1], short[:-2]
    second[begins] = 0
    latest = np.maximum.accumulate(np.where(vocabulary.marker[symbol] | is_end, np.arange(n), 0))
    marker[1:] = own[latest[:-1]] * (vocabulary.marker[symbol[latest[:-1]]])
    return Series(symbol, lengths, [
        marker * np.uint32(0x165667B1), last * np.uint32(0x9E3779B9),
        first * np.uint32(0x85EBCA77) + second * np.uint32(0xC2B2AE3D) + np.uint32(1),
    ])


def letter_series(words: Sequence[bytes]) -> Series:
    """Words as series of letters and a space, which none has inside. Contexts: the three letters before and the
    place; four; six."""
    letters = np.frombuffer(b" ".join([*words, b""]), dtype=np.uint8).astype(np.uint32)
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    within = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = []
    for back in range(1, 7):
        shifted = np.zeros_like(letters)
        shifted[back:] = letters[:-back] + 1
        shifted[within < back] = 0
        before.append(shifted)
    two = before[0] * np.uint32(0x85EBCA6B) + before[1] * np.uint32(0xC2B2AE35)
    three = two + before[2] * np.uint32(0x27D4EB2F)
    four = three + before[3] * np.uint32(0x165667B1)
    six = four + before[4] * np.uint32(0x9E3779B9) + before[5] * np.uint32(0x7FEB352D)
    place = np.minimum(within, 15).astype(np.uint32) * np.uint32(0x846CA68B)
    return Series(letters.astype(np.int32), sizes, [three + place, four, six])


def odds_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A slot's log odds in tenths, 128 for even ones, in one byte."""
    return (np.clip(np.rint(np.log((ones + 0.4) / (zeros + 0.4)) * 10), -120, 120) + 128).astype(np.uint8)


@dataclass
class Mixer:
    """Weights per gate, the curvature they rest on, and the refining table: odds per gate and bucket of the mix."""

    weights: np.ndarray
    curvature: np.ndarray
    hits: np.ndarray
    ones: np.ndarray

    @classmethod
    def plain(cls) -> Mixer:
        w = np.full((GATES, PREDICTORS + 1), 1 / PREDICTORS)
        w[:, -1] = 0.0
        none = np.zeros((GATES, BUCKETS))
        return cls(w, np.tile(np.eye(PREDICTORS + 1) * 20.0, (GATES, 1, 1)), none, none.copy())

    def refined(self) -> np.ndarray:
        """Log odds per gate and bucket: what was observed, resting on the mix itself where little was."""
        middle = (np.arange(BUCKETS) + 0.5) * (2 * LIMIT / BUCKETS) - LIMIT
        p = 1 / (1 + np.exp(-middle))
        seen = (self.ones + 30 * p) / (self.hits + 30)
        return np.clip(np.log(seen / (1 - seen)), -LIMIT, LIMIT)


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places begin, begin + 1, ... of every stretch, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values`` at places below their number, given in 32 bits, which numpy would widen first."""
    return pc.take(pa.array(values), pa.array(at), boundscheck=False).to_numpy()


def coded_bits(symbols: np.ndarray, contexts: Sequence[np.ndarray], code: Code, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits per symbol, bit, slots per predictor) for the bits of a stretch of symbols."""
    widths = code.sizes.take(symbols)
    # What the bits of a symbol share is side by side, to be repeated at once: its contexts, and where its path begins,
    # less the place of its first bit here.
    shared = np.empty((len(symbols), PREDICTORS + 1), dtype=np.uint32)
    for i, context in enumerate(contexts):
        shared[:, i] = (context ^ (context >> np.uint32(15))) * _MIX[i]
    shared[:, -1] = (code.begins.take(symbols) - np.cumsum(widths) + widths).astype(np.uint32)
    shared = np.repeat(shared, widths, axis=0)
    # Where a bit stands in the code: its place in the symbol's path.
    step = _take(code.steps, np.arange(len(shared), dtype=np.uint32) + shared[:, -1])
    bit = (step & np.uint32(1)).astype(np.uint8)
    node = step >> np.uint32(1)
    node *= _STEP
    slots = np.empty((PREDICTORS, len(node)), dtype=np.uint32)
    room = np.empty_like(node)
    for i, mixed in enumerate(slots):
        np.bitwise_xor(shared[:, i], node, out=mixed)
        mixed *= _STEP
        mixed ^= np.right_shift(mixed, np.uint32(15), out=room)
        mixed *= _MIX[i]
        mixed >>= np.uint32(shift)
    return widths, bit, slots


def count_bits(tables: np.ndarray, series: Series, code: Code, shift: int, times: np.ndarray | None = None) -> None:
    """Add the bits of series, each so many times, to ``tables``: per predictor, zeros and ones of every slot."""
    each = None if times is None else np.repeat(times, series.sizes).astype(tables.dtype)
    for a in range(0, len(series.symbols), STRETCH):
        widths, bit, slots = coded_bits(series.symbols[a : a + STRETCH], [c[a : a + STRETCH] for c in series.contexts], code, shift)
        add = tables.dtype.type(1) if each is None else np.repeat(each[a : a + STRETCH], widths)
        slots <<= np.uint32(1)
        slots |= bit
        for table, own in zip(tables, slots):
            np.add.at(table, own.astype(np.intp), add)


class Model:
    """Tables as `odds_of` gives them, and the mixer."""

    def __init__(self, code: Code, odds: np.ndarray, mixer: Mixer, shift: int):
        self.code, self.shift, self.mixer, self.odds = code, shift, mixer, odds
        self.refined = mixer.refined().astype(np.float32).ravel()
        # A series moves its weights along the trained curvature, the same for all gates.
        curvature = mixer.curvature.sum(axis=0) / max(mixer.hits.sum(), 1.0)
        self.way = np.linalg.inv(curvature + np.eye(PREDICTORS + 1) * 1e-3)

    def inputs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds per predictor (and a constant), and the gate, of every bit."""
        x = np.empty((PREDICTORS + 1, slots.shape[1]), dtype=np.float32)
        # A byte less 128, in tenths.
        tenths = [(_take(odds, own) ^ np.uint8(128)).view(np.int8) for odds, own in zip(self.odds, slots)]
        for row, own in zip(x, tenths):
            np.multiply(own, np.float32(0.1), out=row)
        x[-1] = EVEN
        return x, (_level(tenths[2]) * np.uint8(LEVELS) + _level(tenths[1])).astype(np.intp)

    def mix(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The weighted log odds; ``gate`` says by whose weights."""
        weights = self.mixer.weights.T.astype(np.float32)
        weights[-1] *= EVEN
        z = weights[0].take(gate, mode="wrap")
        z *= x[0]
        for row, weight in zip(x[1:-1], weights[1:-1]):
            own = weight.take(gate, mode="wrap")
            own *= row
            z += own
        z += weights[-1].take(gate, mode="wrap")
        return z

    def refine(self, z: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Half way, in log odds, from the mix to what was observed."""
        place = z + np.float32(LIMIT)
        place *= np.float32(BUCKETS / (2 * LIMIT))
        bucket = place.astype(np.intp)
        bucket += gate * BUCKETS
        out = self.refined.take(bucket, mode="wrap")
        out += z
        out *= np.float32(0.5)
        return out

    def learn(self, series: Series) -> None:
        """Move the mixer along series it has not been counted from, each stretch of bits after it was predicted:
        online Newton steps over all that was read."""
        for a in range(0, len(series.symbols), GROUP):
            _, bit, slots = coded_bits(series.symbols[a : a + GROUP], [c[a : a + GROUP] for c in series.contexts], self.code, self.shift)
            x, gate = self.inputs(slots)
            z = _clip(self.mix(x, gate))
            bucket = gate * BUCKETS + ((z + LIMIT) * (BUCKETS / (2 * LIMIT))).astype(np.int64)
            self.mixer.hits += np.bincount(bucket, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)
            self.mixer.ones += np.bincount(bucket, bit, GATES * BUCKETS).reshape(GATES, BUCKETS)
            p = 1 / (1 + np.exp(-z))
            error, bend = bit - p, p * (1 - p)
            for g in np.flatnonzero(np.bincount(gate, minlength=GATES)):
                mine = np.flatnonzero(gate == g)
                own = x[:, mine].astype(np.float64)
                self.mixer.curvature[g] += (own * bend[mine]) @ own.T
                self.mixer.weights[g] += np.linalg.solve(self.mixer.curvature[g], own @ error[mine])

    def score(self, series: Series) -> np.ndarray:
        """Natural log probability of every series. One starts with the trained weights and moves them after each
        block, so only what was read before speaks for a bit."""
        sizes = series.sizes
        total, begins = np.zeros(len(sizes)), np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        begin = 0
        while begin < len(order):
            # Series of about the same length side by side; a long one alone, in turns.
            longest = int(sizes[order[begin]])
            chosen = order[begin : begin + max(1, STRETCH // longest)]
            begin += len(chosen)
            moved = np.zeros((PREDICTORS + 1, len(chosen)), dtype=np.float32)
            evidence = np.zeros(len(chosen))
            for turn in range(0, longest, STRETCH):
                total[chosen] += self._turn(series, begins[chosen], sizes[chosen], turn, moved, evidence)
        return total

    def _turn(self, series, begins, sizes, turn, moved, evidence) -> np.ndarray:
        """Log probability of at most ``STRETCH`` symbols of every series, block by block."""
        n, longest = len(begins), int(sizes.max())
        starts = np.arange(turn, min(longest, turn + STRETCH), BLOCK)
        left = np.clip(sizes[None] - starts[:, None], 0, BLOCK)
        at = _spread((begins[None] + starts[:, None]).ravel(), left.ravel())
        symbols_bits, bit, slots = coded_bits(series.symbols.take(at), [c.take(at) for c in series.contexts], self.code, self.shift)
        x, gate = self.inputs(slots)
        z = self.mix(x, gate)
        came = bit.astype(np.float32)
        sign = 1 - 2 * came
        # The bits of a block and series are neighbours.
        cells = np.concatenate([[0], np.cumsum(symbols_bits)]).take(np.concatenate([[0], np.cumsum(left.ravel())]))
        out = np.zeros(n)
        for b, start in enumerate(starts):
            lo, hi = cells[b * n], cells[(b + 1) * n]
            edges = cells[b * n : (b + 1) * n + 1] - lo
            widths = np.diff(edges)
            full = np.flatnonzero(widths)
            here = z[lo:hi]
            if start:
                for row, own in zip(x[:-1, lo:hi], moved):
                    gain = np.repeat(own, widths)
                    gain *= row
                    here += gain
                here += np.repeat(moved[-1] * EVEN, widths)
            here = _clip(here)
            # Log of the probability of the bit that came.
            said = self.refine(here, gate[lo:hi])
            said *= sign[lo:hi]
            np.exp(said, out=said)
            said += 1
            np.log(said, out=said)
            out[full] -= np.add.reduceat(said, edges[full], dtype=np.float64)
            if start + BLOCK < longest:
                error = np.exp(np.negative(here, out=here), out=here)
                error += 1
                np.divide(1, error, out=error)
                np.subtract(came[lo:hi], error, out=error)
                slope = np.add.reduceat(x[:, lo:hi] * error, edges[full], axis=1)
                evidence[full] += widths[full]
                moved[:, full] += (self.way @ slope / (INERTIA * 8 * BLOCK + evidence[full])).astype(np.float32)
        return out


def _level(tenths: np.ndarray) -> np.ndarray:
    """How decided a predictor is, by its log odds in tenths: 0, 1 or 2."""
    size = np.abs(tenths)
    return (size >= 5).astype(np.uint8) + (size >= 20)


def _clip(z: np.ndarray) -> np.ndarray:
    return np.clip(z, np.float32(-LIMIT + 1e-3), np.float32(LIMIT - 1e-3))
