"""Scores of texts under a language model by online logistic context mixing, beside a smoothed unigram score.

The texts are coded once into chunks: numbers for their words, and the distinct words. Words are counted by Spark.
Those with a set share of all words, a bounded number, and one symbol for all others make up the texts' series; a word
behind that symbol is a series of letters, of one probability wherever it stands, which is worked out once. Every task
counts the bits of its training series in hashed tables, which are added up segment by segment on the executors. The
mixers learn from series that are not in these tables yet, one in sixteen, and the steps of all tasks are added up as
Newton steps are; then these series enter the tables too. The counts and probabilities of rare words, whose number
has no bound, are joined to the texts that hold them. See `bitmix` for the model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tidewright.llm.bitmix import (
    BUCKETS,
    GATES,
    PREDICTORS,
    Code,
    Mixer,
    Model,
    Series,
    Vocabulary,
    count_bits,
    letter_series,
    odds_of,
    text_series,
)
from tidewright.llm.common import byte_values, text_bytes
from tidewright.session import cut_lineage

FOLDS, HELD = 5, 1
# What a text is for: to be counted, to teach the mixer before it is counted, or to be judged only.
COUNTED, TEACHING, JUDGED = 0, 1, 2
# One training text, or rare word, in so many teaches its mixer before it is counted.
TEACHERS = 16
# A word with one in so many of all words, and so many occurrences at least, is a symbol of its own: the first
# number bounds how many there can be.
SHARE, LEAST = 2**18, 4
# Slots of a predictor: two per training word, up to a bound that every worker can hold (3 tables of 1 MB); beyond
# it contexts share slots.
LEAST_BITS, MOST_BITS = 12, 20
# Bytes of text in a chunk, and of chunks in an Arrow batch.
CHUNK, BATCH = 4 << 20, "8m"
SEGMENT = 1 << 13
# A chunk's cells have megabytes: Parquet is to look at a page's and a row group's size after each, not after a hundred.
LARGE_CELLS = {f"parquet.{part}.size.row.check.{end}": 1 for part in ("page", "block") for end in ("min", "max")}

SEGMENTS = "segment int, cells binary"
_LOG10 = math.log(10)


def held_out(key: str) -> Column:
    """Whether a text is kept from training; one with a null key never is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def code_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Chunks of whole texts, all for the same use, stored: every later step reads them, and the numbers of their texts
    are fixed. A chunk's texts have consecutive ones, from ``first``."""
    hashed = F.crc32(F.col(key).cast("string").cast("binary"))
    teaches = F.coalesce(F.floor(hashed / FOLDS) % TEACHERS == 0, F.lit(False))
    use = F.when(held_out(key), JUDGED).when(teaches, TEACHING).otherwise(COUNTED)
    rows = docs.select(F.col(key).alias("key"), use.alias("use"), text_bytes(text).alias("text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        open_chunks = {}
        for batch in batches:
            kind = batch.schema.field(0).type
            for name, use, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_values(batch.column(2))):
                chunk = open_chunks.setdefault(use, _Open(use, kind))
                chunk.add(name, bytes(value))
                if chunk.weight >= CHUNK:
                    yield open_chunks.pop(use).closed(first)
                    first += len(chunk.keys)
        for chunk in open_chunks.values():
            yield chunk.closed(first)
            first += len(chunk.keys)

    schema = (
        StructType().add("first", "long").add("use", "integer").add("keys", ArrayType(rows.schema["key"].dataType))
        .add("n_bytes", ArrayType(LongType())).add("sizes", ArrayType(LongType())).add("tokens", "binary")
        .add("lengths", "binary").add("letters", "binary")
    )
    return cut_lineage(rows.mapInArrow(code, schema), **LARGE_CELLS)


class _Open:
    """A chunk that takes texts."""

    def __init__(self, use: int, kind: pa.DataType):
        self.use, self.kind, self.weight = use, kind, 0
        self.keys, self.texts = [], []

    def add(self, key, text: bytes) -> None:
        self.keys.append(key)
        self.texts.append(text)
        self.weight += len(text)

    def closed(self, first: int) -> pa.RecordBatch:
        words, sizes = split_words(self.texts)
        coded = words.dictionary_encode()
        lengths, letters = _packed(coded.dictionary)
        columns = {
            "first": pa.array([first], pa.int64()), "use": pa.array([self.use], pa.int32()), "keys": pa.array([self.keys], pa.list_(self.kind)),
            "n_bytes": pa.array([[len(t) for t in self.texts]], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "tokens": pa.array([coded.indices.to_numpy().tobytes()], pa.binary()), "lengths": pa.array([lengths], pa.binary()),
            "letters": pa.array([letters], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z in lower case, one after the other, and how many each text has."""
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), dtype=np.uint8)
    gap = (data == 32) | (data - np.uint8(9) < 5)
    # Every gap, one after each text among them, ends a word, which may be empty.
    at = np.flatnonzero(gap)
    lengths = np.diff(at, prepend=-1) - 1
    there = np.flatnonzero(lengths)
    ends = np.zeros(len(there) + 1, dtype=np.int32)
    np.cumsum(lengths[there], out=ends[1:])
    words = pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(ends), pa.py_buffer(data[~gap])])
    after = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return words, np.diff(np.searchsorted(at[there], after), prepend=0)


def _packed(words: pa.Array) -> tuple[bytes, bytes]:
    """The lengths of words and their bytes, one word after the other."""
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32, count=len(words) + 1 + words.offset)[words.offset :]
    letters = memoryview(words.buffers()[2] or b"")[ends[0] : ends[-1]]
    return np.diff(ends).tobytes(), bytes(letters)


class Chunk:
    """One stored chunk, read back."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name: batch.column(batch.schema.get_field_index(name))[row]
        self.first, self.keys, self.n_bytes = get("first").as_py(), get("keys").values, get("n_bytes").values
        self.held = get("use").as_py() == JUDGED
        self.sizes = np.array(get("sizes").as_py(), dtype=np.int64)
        self.tokens = np.frombuffer(get("tokens").as_py(), dtype=np.int32)
        lengths = np.frombuffer(get("lengths").as_py(), dtype=np.int32)
        ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
        self.words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), get("letters").as_buffer()])

    def series(self, vocabulary: Vocabulary) -> Series:
        return text_series(self.tokens, self.sizes, self.words, vocabulary)


# Turns the batches a task gets into series, with how often each counts.
Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[Series, np.ndarray | None]]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for row in range(len(batch)):
            yield Chunk(batch, row)


def _texts(vocabulary) -> Reader:
    def read(batches):
        for chunk in _chunks(batches):
            yield chunk.series(vocabulary.value), None

    return read


def _rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Series, np.ndarray | None]]:
    for batch in batches:
        if len(batch):
            yield letter_series(batch.column(0).to_pylist()), batch.column(1).to_numpy()


def word_counts(chunks: DataFrame) -> DataFrame:
    """(word, c) for every word: how often it occurs in the training texts."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            n = np.bincount(chunk.tokens if not chunk.held else chunk.tokens[:0], minlength=len(chunk.words))
            for a in range(0, len(n), 1 << 16):
                part = n[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([chunk.words.slice(a, len(part)), pa.array(part, pa.int64())], names=["word", "n"])

    return cut_lineage(chunks.mapInArrow(own, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")))


def _pack(counts: np.ndarray) -> bytes:
    """Counts as one byte each; the larger ones follow with their places."""
    large = np.flatnonzero(counts > 254)
    small = counts.astype(np.uint8)
    small[large] = 255
    return small.tobytes() + counts[large].astype("<i8").tobytes()


def _unpack(cells: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(cells, dtype=np.uint8, count=size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(cells[size:], dtype="<i8")
    return counts


def _segments(rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, bytes]] = []
    for row in rows:
        held.append(row)
        if len(held) == 128:
            yield _segment_batch(held)
            held = []
    yield _segment_batch(held)


def _segment_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())], names=["segment", "cells"])


def count_tables(rows: DataFrame, read: Reader, code, bits: int) -> DataFrame:
    """The hashed tables of the series that ``read`` makes of ``rows``, in segments: one row per task and segment
    that holds anything."""
    size = min(SEGMENT, 2 << bits)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for series, times in read(batches):
            tables = np.zeros((PREDICTORS, 2 << bits), dtype=np.int32) if tables is None else tables
            count_bits(tables, series, code.value, 32 - bits, times)
        if tables is not None:
            yield from _segments((i, _pack(part)) for i, part in enumerate(tables.reshape(-1, size)) if part.any())

    return rows.mapInArrow(tally, SEGMENTS)


def add_tables(tables: DataFrame, bits: int) -> DataFrame:
    """One row per segment. A task holds the sums of its segments, however many tasks counted."""
    size = min(SEGMENT, 2 << bits)
    segments = PREDICTORS * (2 << bits) // size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = _unpack(cells, size)
                sums[i] = sums[i] + counts if i in sums else counts
        yield from _segments((i, _pack(c)) for i, c in sums.items())

    return cut_lineage(tables.repartition(min(64, segments), "segment").mapInArrow(add, SEGMENTS))


def slot_odds(tables: DataFrame, bits: int) -> np.ndarray:
    """Log odds of all slots, one byte each: a table of set size."""
    size = min(SEGMENT, 2 << bits)

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [_unpack(cells, size) for cells in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([odds_of(c[0::2], c[1::2]).tobytes() for c in counts], pa.binary())], names=["segment", "cells"]
            )

    out = np.full((PREDICTORS << bits) // (size // 2) * (size // 2), 128, dtype=np.uint8).reshape(-1, size // 2)
    found = tables.mapInArrow(odds, SEGMENTS).toArrow()
    for i, cells in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        out[i] = np.frombuffer(cells, dtype=np.uint8)
    return out.reshape(PREDICTORS, 1 << bits)


def teach_mixer(rows: DataFrame, read: Reader, code, odds, bits: int) -> Mixer:
    """The mixer after the series that ``read`` makes of ``rows``. Every task takes Newton steps through its own;
    added up, with the curvature they rest on, they give the step of all."""
    start = Mixer.plain()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for series, _ in read(batches):
            model = Model(code.value, odds.value, Mixer.plain(), 32 - bits) if model is None else model
            model.learn(series)
        if model is not None:
            m = model.mixer
            gained = m.curvature - start.curvature
            pulled = np.einsum("gij,gj->gi", m.curvature, m.weights) - np.einsum("gij,gj->gi", start.curvature, start.weights)
            yield _sums(np.concatenate([v.ravel() for v in (gained, pulled, m.hits, m.ones)]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cells in batch.column(0).to_pylist():
                own = np.frombuffer(cells)
                total = own if total is None else total + own
        if total is not None:
            yield _sums(total)

    # Two levels of sums, so that no task meets all others.
    sums = rows.mapInArrow(learn, "sums binary")
    for parts in (64, 1):
        sums = sums.repartition(parts).mapInArrow(add, "sums binary")
    row = sums.first()
    if row is None:
        return start
    n = PREDICTORS + 1
    gained, pulled, hits, ones = np.split(np.frombuffer(row["sums"]), np.cumsum([GATES * n * n, GATES * n, GATES * BUCKETS]))
    curvature = start.curvature + gained.reshape(GATES, n, n)
    pulled = np.einsum("gij,gj->gi", start.curvature, start.weights) + pulled.reshape(GATES, n)
    weights = np.linalg.solve(curvature, pulled[..., None])[..., 0]
    return Mixer(weights, curvature, hits.reshape(GATES, BUCKETS), ones.reshape(GATES, BUCKETS))


def _sums(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["sums"])


def learn_model(rows: DataFrame, teachers: DataFrame, read: Reader, code, bits: int):
    """(broadcast odds, mixer) from two sets of rows: those counted first, and those that teach the mixer before they
    are counted as well."""
    context = rows.sparkSession.sparkContext
    before = add_tables(count_tables(rows, read, code, bits), bits)
    mixer = teach_mixer(teachers, read, code, context.broadcast(slot_odds(before, bits)), bits)
    after = add_tables(before.unionByName(count_tables(teachers, read, code, bits)), bits)
    return context.broadcast(slot_odds(after, bits)), mixer


def spelled(words: DataFrame, own: list[bytes], counts: list[int], bits: int) -> DataFrame:
    """``words`` (word, c) with ``spell``, the log10 probability of the letters; learned from the words with c > 0,
    each as often as it occurs. ``own`` words, so often, set the lengths of the letters' codes."""
    letters = np.ones(256, dtype=np.int64)
    for w, c in zip(own, counts):
        np.add.at(letters, np.frombuffer(w + b" ", dtype=np.uint8), c)
    code = words.sparkSession.sparkContext.broadcast(Code(letters.tolist()))
    teaches = F.crc32("word") % TEACHERS == 0
    trained = words.where("c > 0")
    odds, mixer = learn_model(trained.where(~teaches), trained.where(teaches), _rare_words, code, bits)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(code.value, odds.value, mixer, 32 - bits)
        for batch in batches:
            said = model.score(letter_series(batch.column(0).to_pylist())) / _LOG10 if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said)], names=["word", "c", "spell"])

    return cut_lineage(words.mapInArrow(score, "word binary, c long, spell double"))


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
    and ``bits_per_byte``.

    Tokens are the words, A-Z in lower case, and one end. ``score`` is the log10 probability of the tokens under the
    model, ``base_score`` that under smoothed word counts; both learn from the texts that are not held out.
    ``n_known`` tokens occur in training. ``bits_per_byte`` is the model's code length by the UTF-8 bytes of the text
    (null without any). Null and empty texts are one end; null keys (never held out) and repeated rows keep their
    rows; without training texts the base score is 0 per token and the model knows nothing but even odds; an empty
    table gives an empty result; other columns are not read. A task holds a chunk of texts, or one longer text, at
    some 60 bytes a word.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    chunks = code_texts(docs, key, text)
    counts = word_counts(chunks)
    texts = chunks.where(F.col("use") != JUDGED).agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    told = counts.agg(F.count_if(F.col("c") > 0).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n_tokens, n_kinds = told["n"] + texts, told["v"] + (texts > 0)
    # At most SHARE words.
    frequent = (F.col("c") >= LEAST) & (F.col("c") * F.lit(SHARE) >= F.lit(n_tokens))
    own = counts.where(frequent).orderBy(F.desc("c"), "word").toArrow()
    words, c = own.column(0).to_pylist(), own.column(1).to_pylist()
    made = Vocabulary(words, c, told["n"] - sum(c), texts)
    vocabulary, code = spark.sparkContext.broadcast(made), spark.sparkContext.broadcast(made.code)
    seen = np.array([*c, texts], dtype=np.float64)
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(2 * n_tokens + 1))))
    rare = spelled(counts.where(~frequent), words, c, bits)
    odds, mixer = learn_model(chunks.where(F.col("use") == COUNTED), chunks.where(F.col("use") == TEACHING), _texts(vocabulary), code, bits)
    least = math.log10(n_tokens + 0.5 * (n_kinds + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(code.value, odds.value, mixer, 32 - bits)
        # What a symbol adds to the base score and to the known tokens; other words get theirs by a join.
        gain, known = np.append(np.log10(seen + 0.5), 0.0), np.append(seen > 0, False)
        for chunk in _chunks(batches):
            n = len(chunk.sizes)
            series = chunk.series(vocabulary.value)
            of = np.repeat(np.arange(n), series.sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk.first + np.arange(n)), chunk.keys, pa.array(np.full(n, chunk.held)), chunk.n_bytes,
                    pa.array(series.sizes), pa.array(np.bincount(of, known[series.symbols], n).astype(np.int64)),
                    pa.array(np.bincount(of, gain[series.symbols], n)), pa.array(model.score(series) / _LOG10),
                ],
                names=scored.names,
            )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            other = vocabulary.value.symbols(chunk.words) == vocabulary.value.other
            mine = other[chunk.tokens]
            of = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)[mine]
            pairs, n = np.unique(of * len(other) + chunk.tokens[mine], return_counts=True)
            of, token = np.divmod(pairs, max(len(other), 1))
            for a in range(0, len(pairs), 1 << 16):
                b = a + (1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk.first + of[a:b]), chunk.words.take(pa.array(token[a:b])), pa.array(n[a:b])],
                    names=["at", "word", "n"],
                )

    scored = (
        StructType().add("at", "long").add("key", docs.schema[key].dataType).add("held_out", "boolean")
        .add("n_bytes", "long").add("n_tokens", "long").add("n_known", "long").add("base", "double").add("said", "double")
    )
    # One row per text, by its number, and distinct rare word; the words with a large share of all are not among them.
    pairs = chunks.mapInArrow(others, "at long, word binary, n long")
    # What an occurrence adds, worked out once per word. A word that was seen adds more than log10(1) to the base score.
    each = rare.select("word", F.log10(F.col("c") + 0.5).alias("gain"), "spell")
    sums = pairs.join(each.hint("shuffle_hash"), "word").groupBy("at").agg(
        F.sum(F.when(F.col("gain") > 0, F.col("n")).otherwise(F.lit(0))).alias("n_rare"),
        F.sum(F.col("n") * F.col("gain")).alias("base_rare"),
        F.sum(F.col("n") * F.col("spell")).alias("said_rare"),
    )
    whole = chunks.mapInArrow(score, scored).join(sums, "at", "left").withColumns(
        {"score": F.col("said") + F.coalesce("said_rare", F.lit(0.0))}
    )
    return whole.select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", F.lit(0.0)) - F.col("n_tokens") * F.lit(least)).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
