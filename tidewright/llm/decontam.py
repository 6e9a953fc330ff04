"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders. Windows of five template words are hash-joined with
those of the benchmark items; a document that holds enough of an item's windows is a candidate, and the
values its placeholders take must map consistently from the item's values. So a question that was
re-parameterised with other numbers or names is still caught.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tidewright.llm.common import fresh, mix64, per_batch
from tidewright.session import cut_lineage

WINDOW = 5
SIMILARITY = 0.8
CONSISTENCY = 0.8
# Bits of the filter that keeps most document windows out of the join: a fixed size, whatever the
# benchmark's. A crowded filter lets more windows through; the join decides either way.
FILTER_BITS = 24
# Words with capitals, digits or signs whose codes a task keeps between batches.
KEPT = 200_000

# Unit names a number can carry.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ton tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars cent cents euro euros pound pounds mph kmh kw kwh w v a hz khz mhz ghz kb mb gb tb".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th|[A-Za-zµ°]{0,3})")
_END = re.compile(r"[.!?:;][\"')\]]*$")
_EDGE = re.compile(r"^\W+|\W+$")

NUM, NAME, UNIT = "<num>", "<name>", "<unit>"


def _code(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def describe(word: str) -> tuple[int, int, int, int, int, int]:
    """Codes of a word as the first of a window, inside a sentence, after a sentence end and after a
    number; whether it ends a sentence (1) or is a number (2); and the code of its value."""
    core = _EDGE.sub("", word)
    plain = _code(core.lower() or word)
    if _NUMBER.fullmatch(core):
        number = _code(NUM)
        return number, number, number, number, 2 | bool(_END.search(word)), _code(core)
    name = _code(NAME) if core[:1].isupper() else plain
    unit = _code(UNIT) if core.lower() in UNITS else name
    return name, name, plain, unit, int(bool(_END.search(word))), plain


class Codes:
    """Descriptions of words, one row each. Most words are plain lower-case letters and stand for
    themselves; those of the others are kept in a table of bounded size."""

    def __init__(self):
        self.known: dict[str, tuple] = {}

    def of(self, words: list[str]) -> np.ndarray:
        table = np.zeros((len(words), 6), dtype=np.uint64)
        table[:, [0, 1, 2, 3, 5]] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[:, None]
        odd = [i for i, w in enumerate(words) if w in UNITS or not (w.islower() and w.isalpha())]
        if odd:
            if len(self.known) > KEPT:
                self.known.clear()
            known, rows = self.known, []
            for i in odd:
                w = words[i]
                row = known.get(w)
                if row is None:
                    row = known[w] = describe(w)
                rows.append(row)
            table[odd] = np.array(rows, dtype=np.uint64)
        return table


def window_codes(table: np.ndarray, size: int, exact: bool = False) -> np.ndarray:
    """Hash of every window of ``size`` words, given their descriptions. A window stands for itself:
    the type of a word depends on no word before the window. With ``exact`` the values of the
    placeholders count too."""
    n = len(table) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    before = table[:-1, 4]
    ended, number = (before & np.uint64(1)) > 0, (before & np.uint64(2)) > 0
    inside = np.where(ended, table[1:, 2], np.where(number, table[1:, 3], table[1:, 1]))
    total = table[:n, 0].copy()
    for j in range(1, size):
        total = total * np.uint64(0x100000001B3) + inside[j - 1 : j - 1 + n]
    if exact:
        for j in range(size):
            total = total * np.uint64(0x100000001B3) + table[j : j + n, 5]
        total = mix64(total) + np.uint64(WINDOW)
    return mix64(total + np.uint64(size))


def slots(window: list[str], at: int | None = None) -> list[str]:
    """Values of the placeholders of one window, in order, each with its type (and, given the place of
    the window, with ``@`` and its own place)."""
    out = []
    for i, word in enumerate(window):
        place = "" if at is None else f"@{at + i}"
        core = _EDGE.sub("", word)
        before = window[i - 1] if i else ""
        after_end = bool(before) and bool(_END.search(before))
        if _NUMBER.fullmatch(core):
            out.append(f"num:{core}{place}")
        elif before and not after_end and _NUMBER.fullmatch(_EDGE.sub("", before)) and core.lower() in UNITS:
            out.append(f"unit:{core.lower()}{place}")
        elif core[:1].isupper() and not after_end:
            out.append(f"name:{core.lower()}{place}")
    return out


def _tells_nothing(words: list[str]) -> bool:
    """Whether the template of an item says too little without its values: it is shorter than a window, or
    no window holds a word that stands for itself."""
    return len(words) < WINDOW or all(len(slots(words[p : p + WINDOW])) == WINDOW for p in range(len(words) - WINDOW + 1))


def _windows(rows: DataFrame, kinds: list[tuple[int, bool]], whole: bool, bits: Broadcast | None) -> DataFrame:
    """(id columns, size, exact, code, slots): the windows of ``rows``, whose last column is the text.

    ``whole`` is for the benchmark: an item shorter than a window is one window of its own length, and the
    windows of an item whose template tells nothing are exact, so that they meet only their own values.
    ``kinds`` are the sizes, and whether exact, that documents are asked for.
    ``bits`` keeps only windows that may be in the benchmark. A window repeated in a text counts once;
    ``slots`` has the values of each of its places that differ (of a benchmark item, those of its first).
    """
    ids = rows.columns[:-1]
    schema = rows.select(*ids).schema.add("size", "integer").add("exact", "boolean").add("code", "long")
    schema = schema.add("slots", ArrayType(ArrayType(StringType())))

    def run(batches):
        filter_ = None if bits is None else np.frombuffer(bits.value, dtype=np.uint8)
        codes_of = Codes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, width, strict, codes, values = [], [], [], [], []
            for i, text in enumerate(batch.column(len(ids)).to_pylist()):
                words = (text or "").split()
                table = codes_of.of(words)
                own_kind = [(min(len(words), WINDOW), _tells_nothing(words))] if whole and words else []
                for size, exact in own_kind if whole else kinds:
                    found = window_codes(table, size, exact)
                    hits = np.arange(len(found)) if filter_ is None else np.flatnonzero(_in_filter(found, filter_))
                    if not len(hits):
                        continue
                    if whole:
                        hits = hits[np.unique(found[hits], return_index=True)[1]]
                    taken: dict[int, dict[tuple, None]] = {}
                    for p in hits.tolist():
                        taken.setdefault(int(found[p]), {})[tuple(slots(words[p : p + size], p if whole else None))] = None
                    for code, given in taken.items():
                        at.append(i)
                        width.append(size)
                        strict.append(exact)
                        codes.append(code)
                        values.append(list(given))
            own = batch.select(list(range(len(ids)))).take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(width, pa.int32()), pa.array(strict, pa.bool_()), pa.array(np.array(codes, dtype=np.uint64).view(np.int64)), pa.array(values, pa.list_(pa.list_(pa.string())))],
                names=[*ids, "size", "exact", "code", "slots"],
            )

        yield from per_batch(work)(batches)

    return rows.mapInArrow(run, schema)


def _in_filter(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    out = np.ones(len(codes), dtype=bool)
    for shift in (0, 32):
        place = (codes >> np.uint64(shift)) & mask
        out &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _filter(items: DataFrame) -> bytes:
    """Two bits per benchmark window in a filter of 2^FILTER_BITS bits, set by Spark; one long per
    eight bytes reaches the driver, so never more than the filter's size."""
    mask = (1 << FILTER_BITS) - 1
    place = F.explode(F.array(*[F.shiftrightunsigned("code", s).bitwiseAND(F.lit(mask).cast("long")) for s in (0, 32)]))
    words = (
        items.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("set"))
        .toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return bits.tobytes()


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "text",
    similarity: float = SIMILARITY, consistency: float = CONSISTENCY,
) -> DataFrame:
    """(key, text hash, item, containment): the items whose passages a document holds.

    A document holds an item if at least ``similarity`` of the item's distinct template windows (five
    words; a shorter item is one window) occur in it and the values it gives to slots that share a value in
    the item agree in at least ``consistency`` of these windows; a window that the document holds several
    times agrees if it does at any of its places. Of an item shorter than five words, or without any window
    that holds a plain word, the values themselves must be the item's. Items without words match nothing.
    """
    given = benchmark.select(F.col(item).alias("item"), F.col(passage).alias("passage"))
    items = cut_lineage(_windows(given.select("item", F.xxhash64("passage").alias("nth"), "passage"), [], True, None))
    # Window lengths: five, or less for items shorter than that; at most six kinds with the exact ones.
    kinds = sorted((r[0], r[1]) for r in items.select("size", "exact").distinct().collect())
    wanted = items.groupBy("item", "nth").agg(F.count(F.lit(1)).alias("wanted"))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    found = _windows(rows, kinds, False, docs.sparkSession.sparkContext.broadcast(_filter(items)))
    theirs = items.select("item", "nth", "size", "exact", "code", F.col("slots")[0].alias("theirs"))
    pairs = cut_lineage(found.join(theirs, ["size", "exact", "code"]))
    by = ["key", "version", "item", "nth"]
    counts = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("found"))
    held = cut_lineage(
        counts.join(wanted.select(F.col("item").alias("_i"), F.col("nth").alias("_n"), "wanted"), F.col("item").eqNullSafe(F.col("_i")) & (F.col("nth") == F.col("_n")))
        .where(F.col("found") >= F.lit(similarity) * F.col("wanted"))
        .select(*by, (F.col("found") / F.col("wanted")).alias("containment"))
    )
    # Each slot of a window with the different values it takes in the document; the slot is seen once.
    slot = F.transform(
        "theirs", lambda v, i: F.struct(v.alias("theirs"), F.array_distinct(F.transform("slots", lambda given: F.get(given, i))).alias("taken"))
    )
    values = (
        pairs.select(*by, F.explode(slot).alias("slot"))
        .select(*by, "slot.theirs", F.posexplode("slot.taken").alias("nth_taken", "taken"))
        .groupBy(*by, F.regexp_replace("theirs", r"@\d+$", "").alias("value"), "taken")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("nth_taken") == 0).alias("seen"), F.collect_set("theirs").alias("places"))
        .groupBy(*by, "value")
        .agg(F.max("n").alias("agreed"), F.sum("seen").alias("seen"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_places"))
        .where("n_places > 1")
        .groupBy(*by)
        .agg((F.sum("agreed") / F.sum("seen")).alias("agreement"))
    )
    agreement = values.select(*[F.col(c).alias(f"_{c}") for c in by], "agreement")
    on = [held[c].eqNullSafe(agreement[f"_{c}"]) for c in by]
    return (
        held.join(agreement, on, "left")
        .where(F.coalesce("agreement", F.lit(1.0)) >= consistency)
        .select("key", "version", "item", "containment")
    )


def mark_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", **named) -> DataFrame:
    """The columns ``keep`` of every document plus ``contaminated``, ``items`` (sorted ids of the
    benchmark items it holds) and ``containment`` (the largest share of an item's windows found).

    Null and empty texts hold nothing; null keys and repeated rows keep their rows and are judged by
    their own text; repeated benchmark rows count once; an empty benchmark marks nothing; an empty table
    gives an empty result; other columns pass untouched if kept.
    """
    leaks = find_leaks(docs, benchmark, key, text, **named).groupBy("key", "version").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("containment").alias("containment")
    )
    leaks = leaks.select(*[F.col(c).alias(f"_leak_{c}") for c in leaks.columns])
    rows = docs.select(*keep, F.col(key).alias(fresh(docs, "_leak_at")), F.xxhash64(text).alias(fresh(docs, "_leak_of")))
    at, of = rows.columns[-2:]
    joined = rows.join(leaks, rows[at].eqNullSafe(leaks["_leak_key"]) & (rows[of] == leaks["_leak_version"]), "left")
    return joined.select(
        *[rows[c] for c in keep],
        F.col("_leak_version").isNotNull().alias("contaminated"),
        F.coalesce("_leak_items", F.array().cast(leaks.schema["_leak_items"].dataType)).alias("items"),
        F.coalesce("_leak_containment", F.lit(0.0)).alias("containment"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **named) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    leaks = find_leaks(docs, benchmark, key, text, **named).select(
        F.col("key").alias(fresh(docs, "_leak_key")), F.col("version").alias(fresh(docs, "_leak_version"))
    )
    at, of = leaks.columns
    return docs.join(leaks, F.col(key).eqNullSafe(F.col(at)) & (F.xxhash64(text) == F.col(of)), "left_anti")
