"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. A category's model sees the words of the text and the
probabilities of the categories before it; in training those are out-of-fold predictions, so a later
model never sees a probability that was fitted on its own row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidewright.llm.common import fresh, per_batch
from tidewright.session import cut_lineage

# Labelled documents the models are fitted on: the first so many in the order of a hash of the key.
TRAIN_ROWS = 20_000
# No cap on the vocabulary: every word that tells a category counts; the training sample bounds them.
VOCABULARY = float("inf")
LEAST_DOCUMENTS = 5
# A word tells a category if its share of marked documents is so many standard errors off the mean.
LEAST_SURPRISE = 4.0
# Inflected words share their first letters.
STEMS = (4, 5)
FOLDS = 5
# Largest slope of the loss, in documents, at which a fit has ended; with more rows than these it grows as they do.
SLOPE, SLOPE_ROWS = 0.01, 400
THRESHOLD = 0.5
# Label columns in the order of the chain, with the value that marks the category.
CHAIN = (("junk", "quality", 0), ("toxic", "toxic", 1))

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The words of a text, and the stems of the longer ones, marked by a leading ^."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"^{w[:n]}" for n in STEMS for w in words if len(w) > n}


@dataclass(frozen=True)
class Chain:
    """One weight row per category: bias, the earlier categories' probabilities, then the vocabulary."""

    names: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: tuple[np.ndarray, ...]

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        rows, cols = _incidence([words_of(t) for t in texts], self.vocabulary)
        earlier = np.zeros((len(texts), 0))
        for w in self.weights:
            earlier = np.column_stack([earlier, _probability(w, rows, cols, earlier)])
        return earlier


def _incidence(found: list[set[str]], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    rows, cols = [], []
    for i, words in enumerate(found):
        hits = [vocabulary[w] for w in words if w in vocabulary]
        rows += [i] * len(hits)
        cols += hits
    return np.array(rows, dtype=np.int64), np.array(cols, dtype=np.int64)


def _logits(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    k = earlier.shape[1]
    z = w[0] + earlier @ w[1 : 1 + k] + np.bincount(rows, w[1 + k + cols], len(earlier))
    return np.clip(z, -15, 15)


def _probability(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-_logits(w, rows, cols, earlier)))


def _places(keys: np.ndarray) -> tuple[np.ndarray | slice, np.ndarray, np.ndarray]:
    """Order by key, the keys that occur, and where each one's stretch begins."""
    counts = np.bincount(keys)
    present = np.flatnonzero(counts)
    order = slice(None) if (keys[:-1] <= keys[1:]).all() else np.argsort(keys, kind="stable")
    return order, present, np.cumsum(counts[present]) - counts[present]


class Hits:
    """Which document has which word, laid out by document and by word, so that sums run along memory (in single
    precision, which halves what is read and is finer than the slope a fit ends at)."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, n: int, n_words: int):
        self.n, self.n_words = n, n_words
        order, self.rows, self.row_begins = _places(rows)
        self.by_row = cols[order].astype(np.int32, copy=False)
        order, self.cols, self.col_begins = _places(cols)
        self.by_col = rows[order].astype(np.int32, copy=False)

    def of_rows(self, w: np.ndarray) -> np.ndarray:
        """Per document the sum over its words."""
        out = np.zeros(self.n)
        if len(self.rows):
            out[self.rows] = np.add.reduceat(w.astype(np.float32)[self.by_row], self.row_begins)
        return out

    def of_words(self, r: np.ndarray) -> np.ndarray:
        """Per word the sum over its documents."""
        out = np.zeros(self.n_words)
        if len(self.cols):
            out[self.cols] = np.add.reduceat(r.astype(np.float32)[self.by_col], self.col_begins)
        return out

    def probability(self, w: np.ndarray, earlier: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Of the documents ``which``, in the precision of the scores."""
        lengths, told = np.diff(self.row_begins, append=len(self.by_row)), which[self.rows]
        rows = np.repeat(self.rows[told], lengths[told])
        return _probability(w, rows, self.by_row[np.repeat(told, lengths)], earlier)[which]


@dataclass(frozen=True)
class Sample:
    """The training documents as a fit sees them: their words, and a column of marks per category."""

    hits: Hits
    y: np.ndarray


def fit_linear(
    rows: np.ndarray, cols: np.ndarray, n_words: int, earlier: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 50
) -> np.ndarray:
    """`fit_hits` on documents and words given as pairs."""
    return fit_hits(Hits(rows, cols, len(y), n_words), earlier, y, np.ones(len(y)), None, ridge, steps)


def fit_hits(
    hits: Hits, earlier: np.ndarray, y: np.ndarray, inside: np.ndarray, start: np.ndarray | None = None, ridge: float = 0.3, steps: int = 50
) -> np.ndarray:
    """Logistic regression on the documents ``inside`` (1, else 0) with a ridge on all but the bias, by Newton steps:
    each is solved by conjugate gradients scaled per weight, to a tenth of its slope, and halved while
    the loss does not fall. The fit ends where no slope is above ``SLOPE``, long before ``steps``. It may start from
    the weights of another fit; words that no document inside has start from none."""
    k = earlier.shape[1]
    penalty = np.concatenate([[1e-9], np.full(k + hits.n_words, ridge)])
    enough_slope = SLOPE * max(1.0, inside.sum() / SLOPE_ROWS)

    def backward(r: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([[r.sum()], x.T @ r, hits.of_words(r)])

    def forward(w: np.ndarray) -> np.ndarray:
        return w[0] + earlier @ w[1 : 1 + k] + hits.of_rows(w[1 + k :])

    def loss(z: np.ndarray, w: np.ndarray) -> float:
        return float((inside * (np.logaddexp(0, z) - y * z)).sum() + (penalty * w * w).sum() / 2)

    w = np.zeros(1 + k + hits.n_words)
    if start is not None:
        w = start.copy()
        w[1 + k :][hits.of_words(inside) == 0] = 0
    z = forward(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        gradient = backward(inside * (p - y), earlier) + penalty * w
        slope = np.abs(gradient).max()
        if slope <= enough_slope:
            break
        bend = inside * p * (1 - p)
        scale = 1 / (backward(bend, earlier * earlier) + penalty)
        way, left = np.zeros_like(w), -gradient
        ahead = scale * left
        size = left @ ahead
        enough = 0.1 * np.sqrt(size)
        for _ in range(len(w)):
            bent = backward(bend * forward(ahead), earlier) + penalty * ahead
            far = size / (ahead @ bent)
            way, left = way + far * ahead, left - far * bent
            before, size = size, left @ (scale * left)
            if np.sqrt(size) <= enough:
                break
            ahead = scale * left + size / before * ahead
        share, now, moved = 1.0, loss(z, w), forward(way)
        while loss(z + share * moved, w + share * way) > now and share > 1e-6:
            share /= 2
        w, z = w + share * way, z + share * moved
    return w


# Runs every job on the sample, wherever it likes, and gives what they return in order.
Runner = Callable[[Sequence[Callable[[Sample], np.ndarray]]], list[np.ndarray]]


def fit_chain(
    rows: np.ndarray, cols: np.ndarray, y: np.ndarray, names: Sequence[str], vocabulary: dict[str, int], fold: np.ndarray
) -> Chain:
    """``rows`` and ``cols`` say which document has which word of the vocabulary."""
    sample = Sample(Hits(rows, cols, len(y), len(vocabulary)), y)
    return _fit_chain(names, vocabulary, fold, lambda jobs: [job(sample) for job in jobs])


def _fit_chain(names: Sequence[str], vocabulary: dict[str, int], fold: np.ndarray, run: Runner) -> Chain:
    """``run`` makes the fits, those of the folds side by side. Only weights and, per document, its fold and probabilities
    are held here; the sample stays where the jobs run."""
    earlier, weights = np.zeros((len(fold), 0)), []
    for c in range(len(names)):

        def full(sample: Sample, c=c, before=earlier) -> np.ndarray:
            return fit_hits(sample.hits, before, sample.y[:, c], np.ones(len(before)))

        weights += run([full])
        if c + 1 == len(names):
            break

        def without(sample: Sample, f: int, c=c, before=earlier, start=weights[-1]) -> np.ndarray:
            w = fit_hits(sample.hits, before, sample.y[:, c], (fold != f).astype(float), start)
            return sample.hits.probability(w, before, fold == f)

        unseen = np.zeros(len(fold))
        for f, p in enumerate(run([partial(without, f=f) for f in range(FOLDS)])):
            unseen[fold == f] = p
        earlier = np.column_stack([earlier, unseen])
    return Chain(tuple(names), vocabulary, tuple(weights))


def _sample(batches: Iterable[pa.RecordBatch], names: Sequence[str], n_words: int) -> Sample:
    """The stored sample in the order of its numbers; one batch is held at a time beside what is kept of it."""
    read = []
    for batch in batches:
        lists = batch.column("_hits")
        lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        marks = np.column_stack([batch.column(c).to_numpy().astype(float) for c in names])
        read.append((batch.column("_n").to_numpy().copy(), marks, lengths.copy(), lists.flatten().to_numpy().copy()))
    n, marks, lengths, cols = (np.concatenate(parts) for parts in zip(*read))
    del read
    place = np.empty(len(n), dtype=np.int32)
    order = np.argsort(n)
    place[order] = np.arange(len(n))
    rows = np.repeat(place, lengths)
    if (rows[:-1] > rows[1:]).any():
        at = np.argsort(rows, kind="stable")
        rows, cols = rows[at], cols[at]
    return Sample(Hits(rows, cols, len(n), n_words), marks[order])


def _on_executors(stored: DataFrame, names: Sequence[str], n_words: int) -> Runner:
    """Every job is a task of its own, which reads the stored sample; the driver gets what the jobs return."""

    def task(i: int, job: Callable[[Sample], np.ndarray]) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = job(_sample(batches, names, n_words))
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([found.tobytes()], pa.binary())], names=["id", "found"])

        return stored.coalesce(1).mapInArrow(work, "id long, found binary")

    def run(jobs: Sequence[Callable[[Sample], np.ndarray]]) -> list[np.ndarray]:
        # A union of frames with one partition each would be one task.
        tasks = stored.sparkSession.sparkContext.union([task(i, job).rdd for i, job in enumerate(jobs)])
        of = {r.id: r.found for r in tasks.collect()}
        return [np.frombuffer(of[i]) for i in range(len(jobs))]

    return run


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", chain=CHAIN, rows: int = TRAIN_ROWS
) -> Chain:
    """The chain fitted on at most ``rows`` labelled documents.

    The vocabulary has all words and stems that tell any of the categories, counted over the sample by Spark.
    The sample is stored with each document's hits, and the fits run on the executors, which read it. What reaches the
    driver is the vocabulary, and per document of the sample a probability.
    """
    names = [name for name, _, _ in chain]
    marks = [(F.col(column) == value).cast("int").alias(name) for name, column, value in chain]
    # Keys are drawn first; so few rows can meet the documents where these lie.
    marked = labels.select(F.col(key).alias("_key"), *marks).where(
        F.col("_key").isNotNull() & ~F.greatest(*[F.col(n).isNull().cast("int") for n in names]).cast("boolean")
    )
    sample = marked.groupBy("_key").agg(*[F.max(n).alias(n) for n in names]).orderBy(F.xxhash64("_key"), "_key").limit(rows)

    @F.udf("array<string>", useArrow=True)
    def found(value):
        return sorted(words_of(value))

    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    drawn = cut_lineage(
        texts.join(F.broadcast(sample), "_key").select("_key", *names, found("_text").alias("_words"))
    )
    told = drawn.groupBy().agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    if not told["n"]:
        return Chain(tuple(names), {}, tuple(np.zeros(1 + c) for c in range(len(names))))
    n = told["n"]
    counts = drawn.select(*names, F.explode("_words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]
    )
    # How far a word's share of a category is from the category's share, in standard errors.
    surprise = [
        F.abs(F.col(c) - F.col("n") * F.lit(told[c] / n)) / F.sqrt(F.col("n") * F.lit(max(told[c] / n * (1 - told[c] / n), 1e-9)))
        for c in names
    ]
    # A word is taken if it tells any one category; none takes the place of another's.
    tells = F.greatest(*[s >= LEAST_SURPRISE for s in surprise], F.lit(False))
    chosen = counts.where(F.col("n") >= LEAST_DOCUMENTS).where(tells).select("word").toArrow().column(0).to_pylist()
    vocabulary = {w: i for i, w in enumerate(sorted(chosen))}

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [sorted(vocabulary[w] for w in words if w in vocabulary) for words in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hits, pa.list_(pa.int32()))], names=[*batch.schema.names[:-1], "_hits"])

    schema = drawn.drop("_words").schema.add("_hits", ArrayType(IntegerType()))
    stored = cut_lineage(
        drawn.mapInArrow(per_batch(place), schema)
        .orderBy(F.xxhash64("_key"), "_key", "_hits")
        .limit(rows)
        .select(F.monotonically_increasing_id().alias("_n"), *names, "_hits")
    )
    return _fit_chain(names, vocabulary, np.arange(min(n, rows)) % FOLDS, _on_executors(stored, names, len(vocabulary)))


def score(docs: DataFrame, model: Chain, text: str, keep: Sequence[str], prefix: str = "p_") -> DataFrame:
    """The columns ``keep`` plus one probability per category; null texts count as empty."""
    rows = docs.select(*keep)
    names = []
    for name in model.names:
        names.append(fresh(rows, prefix + name))
    given = docs.select(*keep, F.col(text).alias(fresh(rows, "_text")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.probabilities(batch.column(batch.num_columns - 1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(names))]],
            names=[*batch.schema.names[:-1], *names],
        )

    schema = rows.schema
    for name in names:
        schema = schema.add(name, "double")
    return given.mapInArrow(per_batch(work), schema)


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", chain=CHAIN, rows: int = TRAIN_ROWS
) -> DataFrame:
    """One row per document: ``key``, ``p_<category>`` for every category of the chain, and ``toxic``.

    ``toxic`` says that the last category is likelier than not. Texts that are null or empty are
    scored as texts without words; null and repeated keys keep their rows; rows of ``labels`` with a null
    are not used, contradicting ones count as marked; without usable labels all probabilities are one
    half and nothing is toxic; an empty table gives an empty result.
    """
    model = train(docs, labels, key, text, chain, rows)
    rows_ = docs.select(F.col(key).alias(key), F.col(text).alias(fresh(docs.select(key), "_given")))
    scored = score(rows_, model, rows_.columns[1], [key])
    last = scored.columns[-1]
    return scored.withColumn("toxic", F.col(last) > THRESHOLD)
