"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import tune

# Rows per Arrow batch: a Python worker holds one batch of whole texts at a time.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; all can be changed on a running session."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(column: str | Column) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("binary"), F.lit(b""))


def byte_values(column: pa.Array) -> list[memoryview]:
    """Values of a binary column without copying them."""
    data = memoryview(column.buffers()[2]) if column.buffers()[2] is not None else memoryview(b"")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32, count=len(column) + 1 + column.offset)
    ends = ends[column.offset :].tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def per_batch(work):
    """For ``mapInArrow``: apply ``work`` to every batch; it returns a batch or a list of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            yield from out if isinstance(out, list) else [out]

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
