"""The daily incremental ingest as streams over a landing folder.

Every query drains what has arrived and stops; the checkpoint remembers the files already seen, so a
second run adds nothing and a restart continues where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidewright.operators.ingest import (
    SNIPPET_OVERWRITE,
    flatten_comments,
    flatten_snippets,
    flatten_stats,
    upserted,
)
from tidewright.schemas import RAW_COMMENTS, RAW_VIDEOS, SNIPPETS
from tidewright.sources.tables import read_table

BATCH = "batch_id"


def landing_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )


def _append(df: DataFrame, out: str, checkpoint: str, key: Sequence[str] | None) -> StreamingQuery:
    """Every batch fills a folder of its own below ``out``, which a replay overwrites. With a ``key``,
    a batch leaves out the keys that earlier batches have landed, however late it comes.

    The batch numbers belong to the checkpoint: one target takes one stream.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/{BATCH}={batch_id}"
        if key is None:
            batch.write.mode("overwrite").parquet(target)
            return
        batch = batch.persist()
        try:
            landed = read_table(batch.sparkSession, out, StructType([*df.schema.fields, StructField(BATCH, LongType())]))
            earlier = landed.where(F.col(BATCH) < batch_id).drop(BATCH)
            unseen_snapshots(batch, earlier, key).write.mode("overwrite").parquet(target)
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unseen_snapshots(
    batch: DataFrame, earlier: DataFrame, key: Sequence[str], ts: str = "scraped_at"
) -> DataFrame:
    """One row for every key of the batch that ``earlier`` does not hold; nulls compare as values.

    Of repeats inside the batch the lowest row stays, so a replay decides alike. Of the earlier rows
    only those inside the time range of the batch are read.
    """
    rest = [c for c in batch.columns if c not in key]
    once = batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    once = once.select(*[c if c in key else F.col(f"_row.{c}").alias(c) for c in batch.columns])
    first, last = batch.agg(F.min(ts), F.max(ts)).first()
    known = F.col(ts).isNull()
    if first is not None:
        known = known | F.col(ts).between(F.lit(first), F.lit(last))
    old = earlier.where(known).select(*[F.col(c).alias(f"_old_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in key]
    return once.join(old, same, "left_anti")


def read_landed(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows of all batches; empty before the first one."""
    return read_table(spark, out, schema).select(*schema.fieldNames())


def stream_stats(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    strict_after: Column | None = None,
    distinct: bool = True,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append counter rows from new payload files; read them with `read_landed`.

    Late files are included; ``strict_after`` restores the rule that only rows past a mark count.
    ``distinct`` suppresses repeats of (video_id, scraped_at), those of earlier batches included.
    """
    rows = flatten_stats(landing_stream(spark, folder, RAW_VIDEOS, files_per_batch))
    if strict_after is not None:
        rows = rows.where(F.col("scraped_at") > strict_after)
    return _append(rows, out, checkpoint, ["video_id", "scraped_at"] if distinct else None)


def stream_comments(
    spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    rows = flatten_comments(landing_stream(spark, folder, RAW_COMMENTS, files_per_batch))
    return _append(rows, out, checkpoint, ["comment_id", "scraped_at"])


def stream_snippets(
    spark: SparkSession,
    folder: str,
    registry: DataFrame,
    table_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Upsert metadata rows batch by batch; read the table with `read_upserted`.

    A batch leaves one row per key it holds, with the key's first and last write in the batch, in a folder of its
    own, which a replay overwrites. Nothing that earlier batches left is read or written again.
    """
    rows = flatten_snippets(landing_stream(spark, folder, RAW_VIDEOS, files_per_batch), registry)

    def merge(batch: DataFrame, batch_id: int) -> None:
        once = upserted(None, batch.select(*SNIPPETS.fieldNames(), "position"), "video_id", SNIPPET_OVERWRITE)
        once.select(*SNIPPETS.fieldNames()).write.mode("overwrite").parquet(f"{table_path}/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The metadata table: per key the first batch's first write and the last batch's last one."""
    rows = read_table(spark, path, StructType([*SNIPPETS.fields, StructField(BATCH, LongType())]))
    return upserted(None, rows, "video_id", SNIPPET_OVERWRITE, [BATCH]).select(*SNIPPETS.fieldNames())


def run_stages(stages: Sequence[Sequence[Callable[[], StreamingQuery]]], timeout: int = 12 * 3600) -> None:
    """Run the queries of a stage together; the next stage starts when all of them have finished.

    Used as metadata, then counters and comments, then transcripts, so children never arrive before
    their parents.
    """
    for stage in stages:
        queries = [start() for start in stage]
        for query in queries:
            if not query.awaitTermination(timeout):
                query.stop()
                raise TimeoutError(f"stage did not finish within {timeout} seconds")
