"""Tables: SQL scans, and append with key checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewright.operators.ingest import marked_keys, nested_to_json
from tidewright.session import cut_lineage


def sql_scan(spark: SparkSession, query: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Run SQL text with named frames bound to ``{name}`` and literals to ``:name``.

    A database table is bound the same way, from ``spark.read.format("jdbc")``.
    """
    return spark.sql(query, args=args or None, **tables)


BATCH = "batch_id"


@dataclass(frozen=True)
class AppendResult:
    written: int
    conflicts: int


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table, or an empty frame of its schema before the first write."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return spark.createDataFrame([], schema)


def append_records(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: StructType,
    key: Sequence[str],
    on_conflict: str = "reject",
    batch_id: str | None = None,
) -> AppendResult:
    """Append a batch to a table. Nested values are stored as JSON text, an empty batch is a no-op,
    and a key conflict rejects the batch or skips rows; the outcome is reported, not raised.

    A batch fills a folder of its own, named by ``batch_id``. A retry under the same id replaces what the first
    attempt left and is checked against the other batches only, so it ends as one run would. The keys of the table
    are read once, within the batch's time range; the batch is computed and written once. Appends to one table must
    follow one another: two at a time would not see each other's keys.
    """
    name = batch_id or uuid.uuid4().hex
    rows = nested_to_json(batch).select(*schema.fieldNames()).persist()
    try:
        others = read_table(spark, path, StructType([*schema.fields, StructField(BATCH, StringType())]))
        marks = cut_lineage(marked_keys(rows, others.where(F.col(BATCH) != name), key))
        conflicts = marks.where("present OR copies > 1").count()
        if conflicts and on_conflict == "reject":
            return AppendResult(0, conflicts)
        fresh = rows
        if conflicts:
            fresh = rows.dropDuplicates(list(key)).join(marks.where("NOT present").select(*key), list(key), "left_semi")
        seen = Observation()
        written = fresh.observe(seen, F.count(F.lit(1)).alias("n"))
        if marks.isEmpty() and batch_id is None:
            return AppendResult(0, 0)
        written.write.mode("overwrite").parquet(f"{path}/{BATCH}={name}")
        return AppendResult(seen.get["n"], conflicts)
    finally:
        rows.unpersist()
