"""Tests that compare groups: Levene, Kruskal-Wallis, Dunn with Benjamini-Hochberg, Spearman."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.distributions import chi2_p, f_p, two_sided_p
from tidewright.operators.hotkeys import attach_counted, attach_measured
from tidewright.operators.ranks import average_ranks, clean_numbers, exact_quantiles, row_numbers, running
from tidewright.schemas import ALPHA
from tidewright.session import cut_lineage


def levene(df: DataFrame, value: str, by: str) -> DataFrame:
    """Median-centred Levene test (Brown & Forsythe 1974) over all groups."""
    data = clean_numbers(df, value).where(F.col(by).isNotNull())
    medians = exact_quantiles(data, value, {"_median": 0.5}, [by])
    groups = (
        attach_measured(data.select(by, value), medians, [by])
        .withColumn("_z", F.abs(F.col(value) - F.col("_median")))
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_z").alias("mean"),
            (F.var_pop("_z") * F.count(F.lit(1))).alias("within"),
        )
    )
    grand = groups.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    gap = F.col("mean") - grand
    out = groups.agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum("n").cast("double").alias("n"),
        F.sum(F.col("n") * gap * gap).alias("between"),
        F.sum("within").alias("within"),
    )
    stat = F.try_divide(
        (F.col("n") - F.col("k")) * F.col("between"), (F.col("k") - 1) * F.col("within")
    )
    return out.select(
        stat.alias("stat"), (F.col("k") - 1).alias("df1"), (F.col("n") - F.col("k")).alias("df2")
    ).withColumn("p_value", f_p("stat", "df1", "df2"))


def rank_sums(df: DataFrame, value: str, by: str) -> tuple[DataFrame, DataFrame]:
    """(per-group size and rank sum, one row with total size and tie sum).

    The data is reduced to distinct (value, group) counts first; the ranks of the distinct values
    come from the distributed prefix sum and are joined back on the value, which is unique there.
    """
    data = clean_numbers(df, value).where(F.col(by).isNotNull())
    cells = data.groupBy(value, by).agg(F.count(F.lit(1)).alias("cell_n"))
    ranks = average_ranks(data, value).select(value, "avg_rank", "n")
    groups = (
        cells.join(ranks, value)
        .groupBy(by)
        .agg(
            F.sum("cell_n").alias("n"),
            F.sum(F.col("cell_n") * F.col("avg_rank")).alias("rank_sum"),
        )
    )
    t = F.col("n").cast("double")
    overall = ranks.agg(
        F.sum("n").cast("double").alias("total"), F.sum(t * t * t - t).alias("ties")
    )
    return groups, overall


def kruskal(df: DataFrame, value: str, by: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction."""
    groups, overall = rank_sums(df, value, by)
    all_rows = overall.select(F.struct("total", "ties")).scalar()
    out = groups.agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("_s"),
    ).withColumns({"_n": all_rows["total"], "_ties": all_rows["ties"]})
    n = F.col("_n")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    correction = 1 - F.col("_ties") / (n * n * n - n)
    return out.select(
        F.try_divide(raw, correction).alias("stat"), (F.col("k") - 1).alias("df")
    ).withColumn("p_value", chi2_p("stat", "df"))


def dunn(df: DataFrame, value: str, by: str) -> DataFrame:
    """Dunn's pairwise comparison of mean ranks with Benjamini-Hochberg adjusted p-values.

    One row per unordered pair. The pairs are the result itself; each group lists the positions of
    its later partners and fetches them by an equality join.
    """
    groups, overall = rank_sums(df, value, by)
    means = row_numbers(
        groups.select(F.col(by), F.col("n"), (F.col("rank_sum") / F.col("n")).alias("mean_rank")), [by], name="i"
    ).withColumnRenamed("total", "k")
    left = means.where(F.col("i") < F.col("k")).select(
        F.col(by).alias("group_a"), F.col("n").alias("n_a"), F.col("mean_rank").alias("rank_a"),
        F.explode(F.sequence(F.col("i") + 1, F.col("k"))).alias("partner"),
    )
    right = means.select(
        F.col("i").alias("partner"), F.col(by).alias("group_b"), F.col("n").alias("n_b"),
        F.col("mean_rank").alias("rank_b"),
    )
    all_rows = overall.select(F.struct("total", "ties")).scalar()
    pairs = left.join(right, "partner").withColumns({"_n": all_rows["total"], "_ties": all_rows["ties"]})
    big = F.col("_n")
    variance = (big * (big + 1) / 12 - F.col("_ties") / (12 * (big - 1))) * (
        1 / F.col("n_a") + 1 / F.col("n_b")
    )
    z = F.try_divide(F.col("rank_a") - F.col("rank_b"), F.sqrt(variance))
    pairs = pairs.select("group_a", "group_b", z.alias("z")).withColumn(
        "p_value", two_sided_p(F.col("z"))
    )
    return adjust_fdr(pairs, "p_value", "p_adjusted")


def adjust_fdr(df: DataFrame, p: str, name: str) -> DataFrame:
    """Benjamini-Hochberg: running minimum of p*m/rank from the largest p down, at most 1; null where p is.

    Ranks and minima are scans over slabs, so the comparisons may be as many as the pairs of any number of groups."""
    known = row_numbers(df.where(F.col(p).isNotNull()), [p], name="_rank")
    raw = known.withColumn("_raw", F.col(p) * F.col("total") / F.col("_rank"))
    least = running(raw, [F.desc("_rank")], "_raw", "_least", kind="min")
    adjusted = least.withColumn(name, F.least("_least", F.lit(1.0))).drop("_rank", "total", "_raw", "_least")
    return adjusted.unionByName(df.where(F.col(p).isNull()).withColumn(name, F.lit(None).cast("double")))


def same_level_pairs(pairs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Pairs whose difference is not significant."""
    return pairs.where(F.col("p_adjusted") >= alpha).select("group_a", "group_b")


def p_matrix(pairs: DataFrame) -> DataFrame:
    """Symmetric matrix in long form with a unit diagonal and the ``>= 0.05`` flag."""
    ab = cut_lineage(pairs.select("group_a", "group_b", "p_adjusted"))
    ba = ab.select(F.col("group_b").alias("group_a"), F.col("group_a").alias("group_b"), "p_adjusted")
    names = ab.select("group_a").union(ab.select("group_b")).distinct()
    diagonal = names.select("group_a", F.col("group_a").alias("group_b"), F.lit(1.0).alias("p_adjusted"))
    return (
        ab.unionByName(ba).unionByName(diagonal).withColumn("same", F.col("p_adjusted") >= ALPHA)
    )


def spearman(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Spearman correlation of every pair of columns over rows complete in all of them.

    ``key`` identifies a row. The columns are ranked together in one prefix sum (grouped by column
    name); heavily tied values are attached without shuffling their rows.
    """
    columns = list(columns)
    numeric = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        numeric = numeric.where(F.col(c).isNotNull() & ~F.isnan(c))
    long = numeric.unpivot([key], columns, "_column", "_value")
    ranks = average_ranks(long, "_value", ["_column"]).select("_column", "_value", "n", "avg_rank")
    ranked = attach_counted(long, ranks, ["_column", "_value"], "n")
    wide = ranked.groupBy(key).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("avg_rank"))).alias(c) for c in columns]
    )
    pairs = list(combinations(columns, 2))
    row = wide.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [_cell(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        cells += [_cell(a, b, F.col(f"r{i}")), _cell(b, a, F.col(f"r{i}"))]
    return row.select(F.inline(F.array(*cells)))


def _cell(a: str, b: str, rho):
    return F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), rho.alias("rho"))
