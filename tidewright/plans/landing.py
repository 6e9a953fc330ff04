"""Landing one extraction run in the raw layer: three appends with per-set retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.ingest import pruned
from tidewright.schemas import (
    JSONL_RETENTION_DAYS,
    PRIMARY_KEYS,
    RAW_COMMENTS,
    RAW_VIDEOS,
    REGISTRY,
    TABLE_RETENTION_DAYS,
)
from tidewright.session import fresh_path
from tidewright.sources.files import merge_jsonl
from tidewright.sources.tables import BATCH, AppendResult, append_records, read_table

RAW_SETS = {"raw_videos": RAW_VIDEOS, "registry": REGISTRY, "raw_comments": RAW_COMMENTS}


def land_tables(
    spark: SparkSession, batches: dict[str, DataFrame], root: str
) -> dict[str, AppendResult]:
    """Append each set to its table under ``root``."""
    return {
        name: append_records(spark, batches[name], f"{root}/{name}", schema, PRIMARY_KEYS[name])
        for name, schema in RAW_SETS.items()
        if name in batches
    }


def retained(
    spark: SparkSession, root: str, as_of: Column, days: int = TABLE_RETENTION_DAYS
) -> dict[str, DataFrame]:
    """The payload tables inside the retention; the registry is kept without limit."""
    out = {}
    for name, schema in RAW_SETS.items():
        df = read_table(spark, f"{root}/{name}", schema)
        out[name] = df if name == "registry" else pruned(df, "scraped_at", as_of, days)
    return out


def prune_tables(
    spark: SparkSession, root: str, as_of: Column, days: int = TABLE_RETENTION_DAYS
) -> str:
    """Write the retained tables to a new root and return it; the old one stays readable."""
    new_root = fresh_path(spark, "raw")
    for name, df in retained(spark, root, as_of, days).items():
        df.write.mode("overwrite").parquet(f"{new_root}/{name}/{BATCH}=retained")
    return new_root


def land_jsonl(
    spark: SparkSession,
    batches: dict[str, DataFrame],
    old_root: str | None,
    new_root: str,
    as_of: Column,
    days: int = JSONL_RETENTION_DAYS,
) -> None:
    """Merge each set into JSON lines under a new root: payload lines past the retention are
    dropped, the registry keeps every line."""
    for name, batch in batches.items():
        filtering = name != "registry"
        merge_jsonl(
            spark,
            None if old_root is None else f"{old_root}/{name}",
            batch,
            f"{new_root}/{name}",
            should_filter=filtering,
            max_days=days if filtering else None,
            as_of=as_of,
        )


def land_run(
    spark: SparkSession,
    batches: dict[str, DataFrame],
    sink: str,
    root: str,
    as_of: Column | None = None,
    new_root: str | None = None,
) -> str:
    """Land whatever a run produced (missing sets are skipped) and return the current root."""
    as_of = F.current_timestamp() if as_of is None else as_of
    if sink == "table":
        land_tables(spark, batches, root)
        return prune_tables(spark, root, as_of)
    if sink == "jsonl":
        new_root = new_root or fresh_path(spark, "raw-jsonl")
        land_jsonl(spark, batches, root, new_root, as_of)
        return new_root
    raise ValueError(f"unsupported sink: {sink}")
