"""Transform runs: what the raw layer has gained since a table's last row is flattened and written to the table.

One plan per table: the mark of the table as a scalar subquery, the raw rows past it (the comparison reaches the scan
of the raw table), their items, and an append with a key check or an upsert. A run carries a batch id; a retry
under the same id takes its mark from the other batches and replaces what the first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewright.operators.ingest import (
    SNIPPET_OVERWRITE,
    fetched_transcripts,
    flatten_comments,
    flatten_snippets,
    flatten_stats,
    missing_transcripts,
    rows_after_mark,
    upserted,
)
from tidewright.schemas import COMMENTS, PRIMARY_KEYS, SNIPPETS, STATS, TRANSCRIPT_LIMIT, TRANSCRIPTS
from tidewright.sources.tables import BATCH, AppendResult, append_records, read_table

MARK = "scraped_at"


def _batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_table(spark, path, StructType([*schema.fields, StructField(BATCH, LongType())]))


def _new_rows(spark: SparkSession, raw: DataFrame, path: str, schema: StructType, batch_id: int) -> DataFrame:
    others = _batches(spark, path, schema).where(F.col(BATCH) < batch_id)
    return rows_after_mark(raw, others, MARK)


def next_batch(spark: SparkSession, path: str, schema: StructType) -> int:
    last = _batches(spark, path, schema).agg(F.max(BATCH)).first()[0]
    return 0 if last is None else last + 1


def _append_run(
    spark: SparkSession, raw: DataFrame, path: str, schema: StructType, key: list[str], flatten: Callable[[DataFrame], DataFrame],
    batch_id: int | None, on_conflict: str,
) -> AppendResult:
    batch_id = next_batch(spark, path, schema) if batch_id is None else batch_id
    rows = flatten(_new_rows(spark, raw, path, schema, batch_id))
    return append_records(spark, rows, path, schema, key, on_conflict, str(batch_id))


def transform_stats(
    spark: SparkSession, raw_videos: DataFrame, path: str, batch_id: int | None = None, on_conflict: str = "reject"
) -> AppendResult:
    """Append the counters of payloads later than the table."""
    return _append_run(spark, raw_videos, path, STATS, PRIMARY_KEYS["stats"], flatten_stats, batch_id, on_conflict)


def transform_comments(
    spark: SparkSession, raw_comments: DataFrame, path: str, batch_id: int | None = None, on_conflict: str = "reject"
) -> AppendResult:
    """Append the comments of payloads later than the table."""
    return _append_run(spark, raw_comments, path, COMMENTS, PRIMARY_KEYS["comments"], flatten_comments, batch_id, on_conflict)


def transform_snippets(spark: SparkSession, raw_videos: DataFrame, registry: DataFrame, path: str, batch_id: int | None = None) -> int:
    """Upsert the metadata of payloads later than the table, which `streaming.ingest.read_upserted` reads: one row per
    key and batch, with the key's first and last write in it. Returns the batch id."""
    batch_id = next_batch(spark, path, SNIPPETS) if batch_id is None else batch_id
    rows = flatten_snippets(_new_rows(spark, raw_videos, path, SNIPPETS, batch_id), registry)
    once = upserted(None, rows.select(*SNIPPETS.fieldNames(), "position"), "video_id", SNIPPET_OVERWRITE)
    once.select(*SNIPPETS.fieldNames()).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return batch_id


@dataclass(frozen=True)
class TranscriptRun:
    batch_id: int
    written: int
    unavailable: int


def transform_transcripts(
    spark: SparkSession, snippets: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame],
    limit: int | None = TRANSCRIPT_LIMIT, batch_id: int | None = None,
) -> TranscriptRun:
    """Fetch transcripts for videos that have no row yet and append what came back.

    ``fetch`` turns the work list (``video_id``) into attempts (``video_id``, ``transcript``): a text, null where there is
    none to be had, or the mark of a failed fetch. Failed ones are not stored, so the next run asks for them again; nulls
    are, so it does not. ``limit`` None asks for all at once. A retry under the same batch id works off the same list.
    """
    batch_id = next_batch(spark, path, TRANSCRIPTS) if batch_id is None else batch_id
    have = _batches(spark, path, TRANSCRIPTS).where(F.col(BATCH) < batch_id)
    kept = fetched_transcripts(fetch(missing_transcripts(snippets, have, limit)))
    done = append_records(spark, kept, path, TRANSCRIPTS, PRIMARY_KEYS["transcripts"], "skip", str(batch_id))
    mine = _batches(spark, path, TRANSCRIPTS).where(F.col(BATCH) == batch_id)
    return TranscriptRun(batch_id, done.written, mine.where(F.col("transcript").isNull()).count())
