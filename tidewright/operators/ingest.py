"""Flattening of raw payloads and the incremental rules of the ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampNTZType, TimestampType

from tidewright.functions.text import join_tags, video_link
from tidewright.functions.times import keep_record
from tidewright.operators.integrity import duplicate_keys
from tidewright.operators.ranks import row_numbers
from tidewright.schemas import (
    COMMENT_PAYLOAD,
    FAILED_FETCH,
    ID_BATCH_SIZE,
    TRANSCRIBED_FORMATS,
    TRANSCRIPT_LIMIT,
    UNKNOWN_AUTHOR,
    UNKNOWN_FORMAT,
    VIDEO_SNIPPET_PAYLOAD,
    VIDEO_STATS_PAYLOAD,
)

# The mark of an empty target: every timestamp is later.
BEGINNING = "0001-01-01 00:00:00"


def _items(raw: DataFrame, column: str, schema: StructType, *keep: str) -> DataFrame:
    """One row per element of ``items`` with its position; payloads without items give no rows."""
    parsed = F.from_json(F.col(column), schema)
    return raw.select(*keep, F.posexplode(parsed["items"]).alias("position", "item"))


def flatten_stats(raw: DataFrame) -> DataFrame:
    """Counter rows; counters arrive as text and missing ones count as 0."""

    def counter(name: str) -> Column:
        return F.coalesce(F.col(f"item.statistics.{name}").cast("bigint"), F.lit(0).cast("bigint"))

    return _items(raw, "video_response", VIDEO_STATS_PAYLOAD, "scraped_at").select(
        F.col("item.id").alias("video_id"),
        "scraped_at",
        counter("viewCount").alias("view_count"),
        counter("likeCount").alias("like_count"),
        counter("commentCount").alias("comment_count"),
    )


def flatten_snippets(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Metadata rows with the registered format, plus ``position`` inside the payload."""
    snippet = "item.snippet"
    rows = _items(raw, "video_response", VIDEO_SNIPPET_PAYLOAD, "scraped_at").select(
        F.col("item.id").alias("video_id"),
        F.col(f"{snippet}.publishedAt").cast("timestamp").alias("published_at"),
        F.col(f"{snippet}.title").alias("title"),
        F.col(f"{snippet}.description").alias("description"),
        F.col(f"{snippet}.categoryId").alias("category_id"),
        join_tags(F.col(f"{snippet}.tags")).alias("tags"),
        video_link(F.col("item.id")).alias("video_link"),
        "scraped_at",
        "position",
    )
    return with_lookup(rows, registry, "video_id", "video_format", UNKNOWN_FORMAT)


def flatten_comments(raw: DataFrame) -> DataFrame:
    top = "item.snippet.topLevelComment.snippet"
    return _items(raw, "comment_response", COMMENT_PAYLOAD, "video_id", "scraped_at").select(
        "video_id",
        F.col("item.id").alias("comment_id"),
        F.coalesce(F.col(f"{top}.authorDisplayName"), F.lit(UNKNOWN_AUTHOR)).alias("author"),
        F.coalesce(F.col(f"{top}.textDisplay"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"{top}.likeCount"), F.lit(0)).cast("int").alias("like_count"),
        F.col(f"{top}.publishedAt").cast("timestamp").alias("published_at"),
        "scraped_at",
    )


def with_lookup(
    df: DataFrame, lookup: DataFrame, key: str, value: str, default: str
) -> DataFrame:
    """Left join on a unique key; unlisted keys get the default. The lookup table grows with the
    data, so no broadcast is hinted: the runtime plan decides by its measured size."""
    listed = lookup.select(key, F.col(value).alias("_listed"), F.lit(True).alias("_found"))
    return (
        df.join(listed, key, "left")
        .withColumn(value, F.when(F.col("_found"), F.col("_listed")).otherwise(F.lit(default)))
        .drop("_listed", "_found")
    )


def high_water_mark(target: DataFrame, ts: str) -> Column:
    """Latest timestamp already processed, as a scalar subquery."""
    return target.agg(F.coalesce(F.max(ts), F.lit(BEGINNING).cast(target.schema[ts].dataType))).scalar()


def rows_after_mark(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Source rows strictly later than the target's mark; without a target, all rows.

    Rows at or before the mark are never picked up, even if they arrived late.
    """
    if target is None:
        return source
    return source.where(F.col(ts) > high_water_mark(target, ts))


def nested_to_json(df: DataFrame) -> DataFrame:
    nested = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))
    ]
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in nested})


def same_period(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows that can share a key with the batch: if the key has a timestamp, only those
    within the batch's time range. The bounds are scalar subqueries, so they reach the scan."""
    for c in key:
        if isinstance(batch.schema[c].dataType, (TimestampType, TimestampNTZType)):
            low, high = batch.agg(F.min(c)).scalar(), batch.agg(F.max(c)).scalar()
            return existing.where((F.col(c) >= low) & (F.col(c) <= high))
    return existing


def key_conflicts(batch: DataFrame, existing: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Keys that would violate the primary key: repeated in the batch or already present."""
    key = list(key)
    repeated = duplicate_keys(batch, key).select(*key)
    if existing is None:
        return repeated
    existing = same_period(existing, batch, key)
    present = batch.select(*key).join(existing.select(*key), key, "left_semi").distinct()
    return repeated.union(present).distinct()


def marked_keys(batch: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key of the batch with its ``copies`` there and whether it is ``present`` among the existing rows."""
    key = list(key)
    keys = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    old = same_period(existing, batch, key).select(*key).distinct().withColumn("_there", F.lit(True))
    return keys.join(old, key, "left").select(*key, "copies", F.coalesce("_there", F.lit(False)).alias("present"))


def admitted(
    batch: DataFrame, existing: DataFrame | None, key: Sequence[str], on_conflict: str = "reject"
) -> DataFrame:
    """Rows of a batch that may be appended.

    ``reject``: one conflicting key rejects the whole batch, as a single transaction would.
    ``skip``: rows whose key exists are left out and a key repeated in the batch enters once.
    """
    key = list(key)
    if on_conflict == "reject":
        conflicts = key_conflicts(batch, existing, key).agg(F.count(F.lit(1))).scalar()
        return batch.where(conflicts == 0)
    if on_conflict == "skip":
        once = batch.dropDuplicates(key)
        if existing is None:
            return once
        return once.join(same_period(existing, batch, key).select(*key), key, "left_anti")
    raise ValueError("on_conflict must be 'reject' or 'skip'")


def upserted(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    overwrite: Sequence[str],
    order: Sequence[str] = ("scraped_at", "position"),
) -> DataFrame:
    """Merge of metadata rows: ``overwrite`` columns come from the last write of a key, all others from its first.

    Existing rows precede incoming ones; incoming rows apply in ``order``, a timestamp or whole number and perhaps
    a second whole number. The order is one number per row, so a hash aggregation of fixed width, combined map-side,
    finds the first and last write of a key; then only these rows are fetched, by key and order together, so that a
    key that is rewritten very often is spread too. Of writes that share their place the least row goes first.
    """
    columns = [c for c in (incoming.columns if existing is None else existing.columns) if c not in order or c in overwrite]
    first = [c for c in columns if c != key and c not in overwrite]
    kinds = {f.name: f.dataType for f in incoming.schema.fields}

    def number(c: str) -> Column:
        timed = isinstance(kinds[c], (TimestampType, TimestampNTZType))
        return (F.unix_micros(F.col(c).cast("timestamp")) if timed else F.col(c)).cast("decimal(18,0)")

    place = [F.coalesce(number(c), F.lit(0).cast("decimal(18,0)")) for c in order] + [F.lit(0).cast("decimal(18,0)")]
    rows = incoming.select(*columns, (place[0] * F.lit(str(10**19)).cast("decimal(20,0)") + place[1]).cast("decimal(38,0)").alias("_seq"))
    if existing is not None:
        rows = existing.select(*columns, F.lit(str(-(10**37))).cast("decimal(38,0)").alias("_seq")).unionByName(rows)
    ends = rows.groupBy(F.col(key).alias("_key")).agg(F.min("_seq").alias("_first"), F.max("_seq").alias("_last"))
    wanted = ends.select("_key", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_at"))
    met = rows.join(wanted, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_seq") == F.col("_at"))).drop("_key", "_at")
    along = Window.partitionBy(key).orderBy("_seq", *[c for c in columns if c != key])
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    merged = met.withColumns({f"_first_{c}": F.first(c).over(upto) for c in first} | {"_next": F.lead(F.lit(1)).over(along)})
    return merged.where("_next IS NULL").select(*[F.col(f"_first_{c}").alias(c) if c in first else F.col(c) for c in columns])


# Columns of the metadata table that follow the last write.
SNIPPET_OVERWRITE = ["title", "description", "category_id", "tags", "scraped_at"]


def upsert_snippets(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return upserted(existing, incoming, "video_id", SNIPPET_OVERWRITE)


def id_batches(ids: DataFrame, column: str, order: Sequence[str], size: int = ID_BATCH_SIZE) -> DataFrame:
    """Consecutive chunks of at most ``size`` ids in the given order."""
    numbered = row_numbers(ids.select(column, *[c for c in order if c != column]), list(order))
    chunk = F.floor((F.col("row_number") - 1) / size).alias("batch")
    packed = F.array_sort(F.collect_list(F.struct("row_number", column)))
    return (
        numbered.groupBy(chunk)
        .agg(packed.alias("_rows"))
        .select("batch", F.col("_rows")[column].alias("ids"))
    )


def tag_sources(lists: dict[str, DataFrame], name: str) -> DataFrame:
    """Concatenate id lists, each row tagged with the label of its list."""
    out = None
    for label, ids in lists.items():
        tagged = ids.withColumn(name, F.lit(label))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def new_registry_rows(
    current: DataFrame, registry: DataFrame, scraped_at: Column, order: str
) -> DataFrame:
    """Ids not registered yet, stamped with their first sighting; of a repeated id the entry last in
    ``order`` decides the format."""
    once = current.groupBy("video_id").agg(F.max_by("video_format", order).alias("video_format"))
    return once.join(registry.select("video_id"), "video_id", "left_anti").withColumn(
        "first_scraped_at", scraped_at
    )


def missing_transcripts(
    snippets: DataFrame, transcripts: DataFrame, limit: int | None = TRANSCRIPT_LIMIT
) -> DataFrame:
    """Ids of transcribed formats without a transcript row, at most ``limit`` (None: all), lowest ids first."""
    missing = (
        snippets.where(F.col("video_format").isin(*TRANSCRIBED_FORMATS))
        .select("video_id")
        .join(transcripts.select("video_id"), "video_id", "left_anti")
    )
    return missing if limit is None else missing.orderBy("video_id").limit(limit)


def joined_segments(segments: DataFrame, key: Sequence[str], position: str, text: str) -> DataFrame:
    """One text per key from its ordered segments; newlines become spaces.

    The segments of one key end up in a single string value, so they must fit one row by nature.
    """
    ordered = F.array_sort(F.collect_list(F.struct(position, text)))
    return (
        segments.groupBy(*key)
        .agg(ordered.alias("_parts"))
        .select(
            *key, F.translate(F.array_join(F.col("_parts")[text], " "), "\n", " ").alias("transcript")
        )
    )


def fetched_transcripts(attempts: DataFrame, text: str = "transcript") -> DataFrame:
    """Drop failed fetches; a null text stays, as the transcript is known to be unavailable."""
    return attempts.where(F.col(text).isNull() | (F.col(text) != FAILED_FETCH))


def unavailable_count(attempts: DataFrame, text: str = "transcript") -> DataFrame:
    return fetched_transcripts(attempts, text).agg(
        F.count(F.lit(1)).alias("n_kept"), F.count_if(F.col(text).isNull()).alias("n_unavailable")
    )


def pruned(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows inside the retention; older ones are dropped."""
    return df.where(keep_record(F.col(ts), max_days=days, as_of=as_of))


def prune_report(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    keep = keep_record(F.col(ts), max_days=days, as_of=as_of)
    return df.agg(F.count_if(keep).alias("n_kept"), F.count_if(~keep).alias("n_pruned"))
