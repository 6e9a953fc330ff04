"""Frame helpers: selection by type, distinct rows, scaling, literal frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def columns_of(df: DataFrame, *types: type[DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def select_types(df: DataFrame, *types: type[DataType]) -> DataFrame:
    return df.select(*columns_of(df, *types))


def drop_types(df: DataFrame, *types: type[DataType]) -> DataFrame:
    return df.drop(*columns_of(df, *types))


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct, key included: one key with two labels stays two rows."""
    return df.dropDuplicates()


def only_listed(df: DataFrame, column: str, *lists: DataFrame) -> DataFrame:
    """Rows whose value occurs in the set union of one-column lists."""
    wanted = None
    for item in lists:
        one = item.select(F.col(item.columns[0]).alias(column))
        wanted = one if wanted is None else wanted.union(one)
    return df.join(wanted.distinct(), column, "left_semi")


def min_max_scaled(df: DataFrame, column: str) -> Column:
    """Scaled to [0, 1] over ``df``; a constant column gives null."""
    bounds = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    return F.try_divide(F.col(column) - low, high - low)


def value_matrix(
    df: DataFrame, value_col: str, percent_col: str, keep: Column
) -> DataFrame:
    """Filtered subset with one column min-max scaled and a percentage turned into a rate."""
    subset = df.where(keep)
    return subset.withColumns(
        {value_col: min_max_scaled(subset, value_col), percent_col: F.col(percent_col) / 100}
    )


def value_list(spark: SparkSession, values: Sequence, name: str) -> DataFrame:
    """One-column frame of a few literal values, built without Python workers."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def literal_frame(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    """Typed frame from a few literal records; missing keys become null."""
    records = [
        F.struct(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]) for r in rows
    ]
    return spark.range(1).select(F.inline(F.array(*records)))
