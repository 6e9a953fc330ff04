"""Quality scores: histogram gradient-boosted trees over statistics of the document."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidewright.llm.boosting import Boosted, fit
from tidewright.llm.common import byte_values, per_batch, text_bytes
from tidewright.session import cut_lineage

# Labelled rows the trees are fitted on: the first so many in the order of a hash of the key.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

SHARES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": b" ", "newline": b"\n\r",
    "tab": b"\t\x0b\x0c", "stop": b".", "comma": b",;:", "shout": b"!", "ask": b"?", "bar": b"|", "quote": b"'\"`",
    "symbol": b"#$%&*@^~+=<>", "bracket": b"()[]{}", "slash": b"/\\_-", "beyond": range(128, 256),
}
OTHER = (
    "log_bytes", "log_words", "log_lines", "word_length", "word_spread", "longest_word", "distinct", "top_word", "caps_words",
    "odd_ends", "plain_words", "line_length", "line_repeats", "entropy", "stop_every", "one_letter",
)
FEATURES = tuple(SHARES) + OTHER
_ODD = frozenset(b"#$%&*@^~+=<>|!_\\/")


def statistics(text: bytes) -> list[float]:
    """``FEATURES`` of one text; all are defined for the empty text."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = counts / max(n, 1)
    words = text.split()
    n_words = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    frequency = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_lines = max(len(lines), 1)
    present = share[share > 0]
    plain = sum(k for w, k in frequency.items() if w.isalpha())
    values = [float(share[list(which)].sum()) for which in SHARES.values()]
    values += [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        len(frequency) / n_words, max(frequency.values(), default=0) / n_words,
        sum(k for w, k in frequency.items() if w.isupper() and len(w) > 1) / n_words,
        sum(k for w, k in frequency.items() if w[-1] in _ODD) / n_words,
        plain / n_words, np.log1p(n / n_lines), 1 - len(set(lines)) / n_lines if lines else 0.0,
        float(-(present * np.log2(present)).sum()), share[46] * n / n_words,
        sum(k for w, k in frequency.items() if len(w) == 1) / n_words,
    ]
    return [float(v) for v in values]


def document_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, x): one row per document, on shared storage."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [statistics(bytes(v)) for v in byte_values(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["key", "x"])

    rows = docs.select(F.col(key).alias("key"), text_bytes(text).alias("raw"))
    return cut_lineage(rows.mapInArrow(per_batch(work), rows.select("key").schema.add("x", ArrayType(DoubleType()))))


def held_out(key: str = "key") -> F.Column:
    """One in five documents, by the CRC-32 of the key as text; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, key: str, label: str, rows: int = TRAIN_ROWS) -> Boosted:
    """Trees fitted on at most ``rows`` labelled documents that are not held out.

    The sample is the only thing that reaches the driver; its size is fixed by ``rows``.
    """
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
    usable = marked.where(F.col("key").isNotNull() & F.col("y").isin(0.0, 1.0) & ~held_out())
    draw = F.xxhash64("key")
    sample = usable.groupBy("key").agg(F.max("y").alias("y")).orderBy(draw, "key").limit(rows)
    fitted = stats.join(F.broadcast(sample), "key").orderBy(draw, "key", "x").limit(rows).select("x", "y").toArrow()
    x = np.array(fitted.column(0).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, fitted.column(1).to_numpy())


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS
) -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Only the text makes the score. Null texts count as empty and get a score too; null and repeated keys
    keep their rows; without usable labels every score is one half; an empty table gives an empty
    result. Contradicting labels of one key count as good; other labels than 0 and 1 are ignored.
    """
    stats = document_statistics(docs, key, text)
    model = train(stats, labels, key, label, rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["key", "score"])

    scored = stats.mapInArrow(per_batch(work), stats.select("key").schema.add("score", "double"))
    return scored.select(
        F.col("key").alias(key), held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
