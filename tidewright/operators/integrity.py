"""Constraints of the data model as audits and repairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def duplicate_keys(df: DataFrame, key: Sequence[str], name: str = "n") -> DataFrame:
    """Key values that occur more than once, with their number of rows as ``name``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def orphans(child: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Child rows whose key is missing from the parent."""
    return child.join(parent.select(*key), list(key), "left_anti")


def cascade_delete(child: DataFrame, surviving: DataFrame, key: Sequence[str]) -> DataFrame:
    """Child rows that survive the deletion of parents."""
    return child.join(surviving.select(*key), list(key), "left_semi")


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Null count of every required column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def in_domain(value: Column, domain: Sequence[str]) -> Column:
    """Null is allowed, as in a nullable enumeration."""
    return value.isNull() | value.isin(*domain)


def enforce_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Strict cast: a label outside the domain raises."""
    checked = F.when(in_domain(F.col(column), domain), F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"{column} outside its domain: "), F.col(column))).cast("string")
    )
    return df.withColumn(column, checked)


def quarantine(df: DataFrame, column: str, domain: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (inside the domain, outside the domain)."""
    good = in_domain(F.col(column), domain)
    return df.where(good), df.where(~good)


def unsigned(value: Column, upper: int, strict: bool = True) -> Column:
    """Integer within [0, upper]; outside, raise (strict) or keep the value."""
    if not strict:
        return value.cast("int")
    return F.when(
        (value >= 0) & (value <= upper) | value.isNull(), value.cast("int")
    ).otherwise(F.raise_error(F.concat(F.lit("out of unsigned range: "), value.cast("string"))).cast("int"))


def _missing(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def _infinite(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        return F.col(column).isin(float("inf"), float("-inf"))
    return F.lit(False)


def missing_and_infinite(df: DataFrame) -> DataFrame:
    """One row per column with its missing (null or NaN) and infinite counts; one pass."""
    return _per_column(
        df,
        lambda c: [
            F.count_if(_missing(df, c)).alias("missing"),
            F.count_if(_infinite(df, c)).alias("infinite"),
        ],
    )


def profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and row count of every column; one pass."""
    return _per_column(
        df,
        lambda c: [
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.count(c).alias("non_null"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        ],
    )


def _per_column(df: DataFrame, measures) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column_name"), *measures(c)) for c in df.columns]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
