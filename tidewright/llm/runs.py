"""Periodic runs of words by an online sparse diagonal dynamic programme.

A diagonal is a lag q; its match length at word i is how many words in a row, up to i, equal the word q
earlier. Words are read in order; an earlier occurrence at lag q increments the length of diagonal q, and a
diagonal that ends long enough emits its run. Taking every earlier occurrence of a word would cost the square
of its frequency, so the diagonals are kept sparse by powers of two: lags from k/2 + 1 to k are looked for among
the occurrences of the k words that start at a place, where only the nearest earlier one counts. Inside a run of
smallest period q that one lies exactly q back: a nearer one would give the stretch a smaller period. A place has
at most one lag a level, and only places whose k words occur again in the text go on to the next level.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from tidewright.llm.common import byte_values, per_batch, text_bytes

LEAST_WORDS = 6
LEAST_EXPONENT = 4

RUN = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in key order (stable), dense ranks in that order, and whether a place repeats the one before it."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), dtype=bool)
    again[1:] = keys[order[1:]] == keys[order[:-1]]
    return order, np.cumsum(~again) - 1, again


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run in texts that lie one after the other, by start, then period.

    ``words`` numbers the words, equal ones alike; ``sizes`` has the words of each text.
    """
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none)]
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    keys = text * (int(words.max(initial=0)) + 1) + words
    name = np.full(len(words), -1, dtype=np.int64)
    longest, k = int(sizes.max(initial=0)), 1
    while len(at) and LEAST_EXPONENT * (k // 2 + 1) <= longest:
        order, ranks, again = _ranks(keys)
        lag = np.zeros(len(at), dtype=np.int64)
        repeats = np.flatnonzero(again)
        lag[order[repeats]] = at[order[repeats]] - at[order[repeats - 1]]
        active = (2 * lag > k) & (lag <= k)
        # A diagonal goes on while the next place has the same lag.
        goes_on = np.zeros(len(at) + 1, dtype=bool)
        goes_on[1:-1] = active[1:] & (lag[1:] == lag[:-1]) & (at[1:] == at[:-1] + 1)
        first = np.flatnonzero(active & ~goes_on[:-1])
        last = np.flatnonzero(active & ~goes_on[1:])
        period = lag[first]
        start, length = at[first] - period, at[last] + k - at[first] + period
        enough = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
        found.append((start[enough], length[enough], period[enough]))
        # Twice as many words repeat only where both halves do.
        shared = again.copy()
        shared[:-1] |= again[1:]
        name.fill(-1)
        name[at[order[shared]]] = ranks[shared]
        at = np.sort(at[order[shared]])
        at = at[at + k < len(words)]
        at = at[(name[at + k] >= 0) & (text[at] == text[at + k])]
        keys = name[at] * (len(words) + 1) + name[at + k]
        k *= 2
    start, length, period = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def strongest(runs: list[dict]) -> dict | None:
    """The run with the greatest length per period; of equal ones that with the least start, then period."""
    return max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)


def batch_runs(texts: list) -> tuple[list[list[dict]], list[bytes]]:
    """The runs of every text, and its words without those that only repeat a period."""
    split = [bytes(t).split() for t in texts]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    known: dict[bytes, int] = {}
    words = np.fromiter((known.setdefault(w, len(known)) for s in split for w in s), np.int64, int(sizes.sum()))
    start, length, period = find_runs(words, sizes)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    dropped = np.cumsum(cover)[:-1] > 0
    begins = np.concatenate([[0], np.cumsum(sizes)])
    of_text = np.searchsorted(start, begins)
    runs, kept = [], []
    for i, own in enumerate(split):
        a, b = of_text[i], of_text[i + 1]
        spans = zip((start[a:b] - begins[i]).tolist(), length[a:b].tolist(), period[a:b].tolist())
        runs.append([{"start": s, "length": n, "period": p} for s, n, p in spans])
        if b > a:
            gone = dropped[begins[i] : begins[i + 1]].tolist()
            own = [w for w, g in zip(own, gone) if not g]
        kept.append(b" ".join(own))
    return runs, kept


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``runs`` (start, length and period in words, by start, then period), ``best``
    and ``collapsed``, the words joined by one space without those a run contains after its first period.

    A run is a stretch of consecutive words with smallest period q, at least max(6, 4 q) words long, that cannot be
    extended; ``best`` has the greatest length per period (ties: smallest start, then period) or is null. Words are
    what white space separates. Null and empty texts have no words, no runs and an empty ``collapsed``; null and
    repeated keys keep their rows; an empty table gives an empty result; other columns are not read. Nothing is
    shuffled: a task holds one batch of whole texts and a few numbers per word, whatever repeats in them.
    """
    rows = docs.select(F.col(key).alias("key"), text_bytes(text).alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs, kept = batch_runs(byte_values(batch.column(1)))
        columns = [batch.column(0), pa.array(runs, pa.list_(_RUN)), pa.array([strongest(r) for r in runs], _RUN), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "runs", "best", "collapsed"])

    schema = rows.select("key").schema.add("runs", ArrayType(RUN)).add("best", RUN).add("collapsed", BinaryType())
    found = rows.mapInArrow(per_batch(work), schema)
    return found.select(F.col("key").alias(key), "runs", "best", F.col("collapsed").cast("string").alias("collapsed"))
