"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.session import cut_lineage


def attach_counted(
    left: DataFrame, right: DataFrame, keys: list[str], count_col: str, shares: int = 1000
) -> DataFrame:
    """Inner join of ``left`` with one ``right`` row per key, where ``count_col`` says how many
    ``left`` rows carry that key.

    Keys holding at least ``1/shares`` of all rows number at most ``shares`` (their counts add up
    to no more than the total), so that part of ``right`` is safe to broadcast at any data size and
    its ``left`` rows never move. All other keys are hash-joined; none of them exceeds
    ``1/shares`` of the rows.
    """
    total = right.agg(F.sum(count_col)).scalar()
    heavy = F.col(count_col) * F.lit(shares) >= total
    hot = right.where(heavy)
    hot_keys = hot.select(*keys)
    hot_rows = left.join(F.broadcast(hot), keys, "inner")
    cold_rows = left.join(F.broadcast(hot_keys), keys, "left_anti").join(
        right.where(~heavy), keys, "inner"
    )
    return hot_rows.unionByName(cold_rows)


def attach_measured(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a result that has one row per group.

    The result is stored first, so the optimizer knows its size before it plans: a small one is
    broadcast under the session's threshold and ``left`` is not shuffled at all, a large one is joined
    by shuffle, where the runtime plan splits a skewed group.
    """
    return left.join(cut_lineage(right), keys, "inner")


def same_keys(keys: Sequence[str], prefix: str = "_by_") -> Column:
    """Join condition between the columns ``keys`` and their renamed copies; nulls match."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in keys])
