"""Reductions of snapshot tables: first and last state per key, latest row, dual ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.ranks import row_numbers


def in_window(ts: Column, start: str, end: str) -> Column:
    """Half-open time window; both bounds are literals, so the predicate reaches the scan."""
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))


def first_and_last(df: DataFrame, key: str, ts: str, counters: Sequence[str]) -> DataFrame:
    """Counters of the earliest and latest snapshot of every key.

    One hash aggregate with map-side combine: no window, no sort, and a key with very many
    snapshots reaches the shuffle as one partial row per task. Nulls of the chosen rows are kept.
    """
    picks = [F.min(ts).alias("first_scraped_at"), F.max(ts).alias("last_scraped_at")]
    for c in counters:
        picks += [
            F.min_by(c, ts).alias(f"earliest_{c}"),
            F.max_by(c, ts).alias(f"latest_{c}"),
        ]
    return df.groupBy(key).agg(*picks)


def both_ranks(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Position of every snapshot from the start (``entry_rank``) and the end (``exit_rank``)."""
    return (
        row_numbers(df, [ts], [key], name="entry_rank")
        .withColumn("exit_rank", F.col("total") - F.col("entry_rank") + 1)
        .drop("total")
    )


def first_and_last_by_rank(df: DataFrame, key: str, ts: str, counters: Sequence[str]) -> DataFrame:
    """The same reduction written with ranks and filtered aggregates; cross-checks the other."""
    picks = [
        F.expr(f"min({ts}) FILTER (WHERE entry_rank = 1)").alias("first_scraped_at"),
        F.expr(f"max({ts}) FILTER (WHERE exit_rank = 1)").alias("last_scraped_at"),
    ]
    for c in counters:
        picks += [
            F.expr(f"max({c}) FILTER (WHERE entry_rank = 1)").alias(f"earliest_{c}"),
            F.expr(f"max({c}) FILTER (WHERE exit_rank = 1)").alias(f"latest_{c}"),
        ]
    return both_ranks(df, key, ts).groupBy(key).agg(*picks)


def latest_row(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Whole latest row per key. The limit of one is pushed below the shuffle, so every task sends
    at most one row per key."""
    place = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")
