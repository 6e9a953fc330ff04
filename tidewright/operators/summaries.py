"""Descriptive summaries: counts, shares, medians, histograms, box plots and densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.hotkeys import attach_measured, same_keys
from tidewright.operators.ranks import clean_numbers, exact_quantiles, prefix_sum
from tidewright.session import cut_lineage


def value_counts(df: DataFrame, column: str, counted: str | None = None) -> DataFrame:
    """Rows per value, most frequent first; with ``counted``, its non-null rows per value."""
    n = F.count(F.lit(1) if counted is None else F.col(counted)).alias("n")
    return df.groupBy(column).agg(n).orderBy(F.desc("n"), column)


def class_share(df: DataFrame, key: str, column: str, wanted: str, name: str) -> DataFrame:
    """Percentage of a key's rows in one class; a null class counts as outside."""
    hit = F.when(F.col(column) == wanted, 1.0).otherwise(0.0)
    return df.groupBy(key).agg((F.avg(hit) * 100).alias(name))


def leading_values(df: DataFrame, column: str, percent: int = 90) -> DataFrame:
    """Most frequent values while their running share stays at or below ``percent``.

    Ties in frequency are taken in value order. The running share is a scan over slabs, so distinct values may be many.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    summed = prefix_sum(counts, [F.desc("n"), column], "n").withColumn("cum_n", F.col("before") + F.col("n"))
    return summed.where(F.col("cum_n") * 100 <= F.col("total") * percent).select(column, "n", "cum_n", "total")


def group_median(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Exact interpolated median per group; memory does not grow with the group."""
    return exact_quantiles(df, value, {"median": 0.5}, by)


def group_mode(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per group, the lowest one on ties."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # min over (-count, value): highest count first, then lowest value.
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(column).alias("value")))
    return counts.groupBy(*by).agg(best.alias("_best")).select(*by, F.col("_best.value").alias(column))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of every column."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    long = clean_numbers(long, "value")
    basics = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(
        long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column_name"]
    ).drop("n_values")
    return basics.join(quartiles, "column_name")


def at_least_baseline(df: DataFrame, measure: str, cohort: Column, baseline: Column) -> DataFrame:
    """Rows of one cohort at or above the mean of another."""
    mean = df.where(baseline).agg(F.avg(measure)).scalar()
    return df.where(cohort & (F.col(measure) >= mean))


def fast_but_flat(df: DataFrame, speed: str, gain: str) -> DataFrame:
    """Rows faster than average whose gain is not positive."""
    mean = df.agg(F.avg(speed)).scalar()
    return df.where((F.col(speed) > mean) & (F.col(gain) <= 0))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are listed."""
    spark = df.sparkSession
    data = clean_numbers(df, value)
    margin = F.when(F.min(value) == F.max(value), 0.5).otherwise(0.0)
    bounds = data.agg(F.struct((F.min(value) - margin).alias("lo"), (F.max(value) + margin).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    place = F.floor((F.col(value) - lo) / (hi - lo) * bins).cast("int")
    counts = (
        data.withColumn("bin", F.least(place, F.lit(bins - 1)))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        spark.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (lo + (hi - lo) * F.col("bin") / bins).alias("left_edge"),
            (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("right_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def _fenced(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The numbers of every group with its quartiles and fences."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = quartiles.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})
    return attach_measured(clean_numbers(df, value).select(*by, value), fences, list(by))


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the fences) and outlier count per group."""
    inside = F.col(value).between(F.col("low_fence"), F.col("high_fence"))
    return _fenced(df, value, by).groupBy(*by).agg(
        F.max("n_values").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def box_outliers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Values outside the fences with their multiplicity."""
    outside = (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))
    return _fenced(df, value, by).where(outside).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


# Beyond so many bandwidths the Gaussian kernel is zero in double precision.
KERNEL_REACH = 39.0


def density(df: DataFrame, value: str, by: Sequence[str], grid: int = 100, cut: float = 2.0) -> DataFrame:
    """Gaussian kernel density per group on an even grid reaching ``cut`` bandwidths past the data.

    Bandwidth is Scott's rule. A value meets the grid points its kernel reaches and no others; the sums are combined
    map-side, so the shuffle carries at most grid x groups rows per task. Points that nothing reaches have density
    zero. A group without spread has one row: point 0 at its value, with a null density.
    """
    by = list(by)
    counts = clean_numbers(df, value).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    shape = (
        clean_numbers(df, value)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.stddev_samp(value).alias("_sd"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
        )
        .withColumn("bandwidth", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
        .withColumn("bandwidth", F.when(F.col("bandwidth") > 0, F.col("bandwidth")))
        .withColumn("_lo", F.col("_lo") - F.coalesce(cut * F.col("bandwidth"), F.lit(0.0)))
        .withColumn("_hi", F.col("_hi") + F.coalesce(cut * F.col("bandwidth"), F.lit(0.0)))
        .withColumn("_points", F.when(F.col("bandwidth").isNull(), 1).otherwise(grid))
        .withColumn("_step", (F.col("_hi") - F.col("_lo")) / (grid - 1))
    )
    shape = cut_lineage(shape.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_n", "bandwidth", "_lo", "_points", "_step"))
    reach, last = KERNEL_REACH * F.col("bandwidth"), F.col("_points") - 1
    first = F.greatest(F.ceil((F.col(value) - reach - F.col("_lo")) / F.col("_step")).cast("int"), F.lit(0))
    upto = F.least(F.floor((F.col(value) + reach - F.col("_lo")) / F.col("_step")).cast("int"), last)
    met = counts.join(shape, same_keys(by)).where("bandwidth IS NOT NULL").withColumns({"_first": first, "_last": upto})
    near = met.where("_first <= _last").select(
        *by, value, "n", "bandwidth", "_lo", "_step", F.explode(F.sequence("_first", "_last")).alias("point")
    )
    u = (F.col("_lo") + F.col("_step") * F.col("point") - F.col(value)) / F.col("bandwidth")
    sums = near.groupBy(*by, "point").agg(F.sum(F.col("n") * F.exp(-0.5 * u * u)).alias("_sum"))
    points = shape.select(*[F.col(f"_by_{c}") for c in by], "_n", "bandwidth", "_lo", "_step", F.explode(F.sequence(F.lit(0), last)).alias("_point"))
    whole = points.join(sums, same_keys(by) & (F.col("point") == F.col("_point")), "left")
    return whole.select(
        *[F.col(f"_by_{c}").alias(c) for c in by], F.col("_point").alias("point"),
        (F.col("_lo") + F.col("_step") * F.col("_point")).alias("x"),
        (F.coalesce("_sum", F.lit(0.0)) / (F.col("_n") * F.col("bandwidth")) / F.sqrt(F.lit(2.0) * F.pi())).alias("density"),
    )
