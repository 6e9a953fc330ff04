"""How groups of videos differ in a feature: distribution, level, and tests of both, per format or per pillar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators import group_tests, normality
from tidewright.operators.ranks import clean_numbers, exact_quantiles
from tidewright.schemas import ALPHA


def group_normality(features: DataFrame, value: str, by: str, large: int = 200) -> DataFrame:
    """Per group a normality test: the omnibus test above ``large`` values, Lilliefors otherwise."""
    return normality.test_by_size(features.where(F.col(by).isNotNull()), value, [by], "lilliefors", "dagostino", large)


def group_levels(features: DataFrame, value: str, by: str) -> DataFrame:
    """Per group its number of values and their median; which groups are better is read from the median."""
    data = clean_numbers(features, value).where(F.col(by).isNotNull())
    return exact_quantiles(data, value, {"median": 0.5}, [by]).withColumnRenamed("n_values", "n")


def difference_tests(features: DataFrame, value: str, by: str, alpha: float = ALPHA) -> DataFrame:
    """One row per test: equal spread (Levene, around medians) and equal level (Kruskal-Wallis). ``differs`` is null where
    the groups allow no test."""
    rows = [
        test(features, value, by).select(F.lit(name).alias("test_name"), "stat", "p_value")
        for name, test in (("levene", group_tests.levene), ("kruskal", group_tests.kruskal))
    ]
    return rows[0].unionByName(rows[1]).withColumn("differs", F.col("p_value") < alpha)


def level_pairs(features: DataFrame, value: str, by: str, alpha: float = ALPHA) -> DataFrame:
    """Every pair of groups with Dunn's comparison, and whether the two stand at the same level."""
    return group_tests.dunn(features, value, by).withColumn("same", F.col("p_adjusted") >= alpha)


def per_part(report, features: DataFrame, value: str, by: str, part: str, parts: list[str]) -> DataFrame:
    """A report above within each value of ``part`` (the formats, say), which come from a fixed domain."""
    done = [report(features.where(F.col(part) == p), value, by).withColumn(part, F.lit(p)) for p in parts]
    return reduce(DataFrame.unionByName, done)
