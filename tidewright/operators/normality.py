"""Normality tests per group, each reduced to a few sums per group.

Formulas: Jarque-Bera (1980); D'Agostino & Pearson (1973) with Anscombe & Glynn (1983) for the
kurtosis; Lilliefors with the Dallal-Wilkinson (1986) p-value and Stephens' (1974) polynomials above
0.1; Shapiro-Wilk by Royston (1995).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.distributions import normal_cdf, normal_quantile, polynomial
from tidewright.operators.hotkeys import attach_measured
from tidewright.operators.ranks import clean_numbers, value_histogram
from tidewright.schemas import ALPHA

# Tied values are laid out in runs of at most this many positions.
RUN = 10_000

# Published polynomial coefficients, highest power first.
STEPHENS = [
    (0.5, [81.218052, -138.55152, 80.709644, -19.828315, 2.76773]),
    (0.9, [-32.355711, 94.029866, -97.490286, 40.662806, -4.901232]),
    (1.31, [2.423045, -12.234627, 23.186922, -19.558097, 6.198765]),
]
ROYSTON_LAST = [-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, 0.0]
ROYSTON_NEXT = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0]
ROYSTON_SMALL_GAMMA = [0.459, -2.273]
ROYSTON_SMALL_MEAN = [-6.714e-4, 0.025054, -0.39978, 0.544]
ROYSTON_SMALL_SD = [-0.0020322, 0.062767, -0.77857, 1.3822]
ROYSTON_LARGE_MEAN = [0.0038915, -0.083751, -0.31082, -1.5861]
ROYSTON_LARGE_SD = [0.0030302, -0.082676, -0.4803]


def moments(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Size, population skewness and excess kurtosis per group, in one pass."""
    return (
        clean_numbers(df, value)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.skewness(value).alias("skew"),
            F.kurtosis(value).alias("excess"),
        )
    )


def jarque_bera(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistic, p-value and decision for every numeric column."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    skew, excess = F.col("skew"), F.col("excess")
    return (
        moments(long, "value", ["column_name"])
        .withColumn("stat", F.col("n") / 6 * (skew * skew + excess * excess / 4))
        .withColumn("p_value", F.exp(-F.col("stat") / 2))
        .select("column_name", "stat", "p_value", (F.col("p_value") > ALPHA).alias("is_normal"))
    )


def dagostino(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Omnibus K-squared from the skewness and kurtosis z-scores.

    Groups below 8 values and constant ones have a null statistic and p-value.
    """
    n = F.when(F.col("n") >= 8, F.col("n").cast("double"))
    m = moments(df, value, by)

    scaled = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    # An exactly symmetric sample is scored as if scaled to 1, as the established library does.
    scaled = F.when(scaled == 0, F.lit(1.0)).otherwise(scaled)
    beta2 = (
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
        / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    z_skew = F.asinh(scaled / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.ln(w2) / 2)

    spread = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("excess") + 3 - 3 * (n - 1) / (n + 1)) / F.sqrt(spread)
    root = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    m = m.withColumn("_x", x).withColumn("_a", a).withColumn("_z_skew", z_skew)
    denominator = 1 + F.col("_x") * F.sqrt(2 / (F.col("_a") - 4))
    cube = F.signum(denominator) * F.cbrt((1 - 2 / F.col("_a")) / F.abs(denominator))
    z_kurt = (1 - 2 / (9 * F.col("_a")) - cube) / F.sqrt(2 / (9 * F.col("_a")))
    return (
        m.withColumn("stat", F.col("_z_skew") * F.col("_z_skew") + z_kurt * z_kurt)
        .withColumn("p_value", F.exp(-F.col("stat") / 2))
        .select(*by, "n", "stat", "p_value")
    )


def lilliefors(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Largest gap between the empirical and the fitted normal distribution function."""
    centre = (
        clean_numbers(df, value)
        .groupBy(*by)
        .agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    )
    # Constant groups have no scale: their statistic and p-value are null.
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd"))
    stepped = (
        attach_measured(value_histogram(df, value, by), centre, list(by))
        .withColumn("_z", z)
        .withColumn("_cdf", normal_cdf(F.col("_z")))
    )
    above = (F.col("before") + F.col("n")) / F.col("total") - F.col("_cdf")
    below = F.col("_cdf") - F.col("before") / F.col("total")
    gap = F.when(F.col("_z").isNotNull(), F.greatest(above, below))
    out = stepped.groupBy(*by).agg(F.max("total").alias("n"), F.max(gap).alias("stat"))
    return out.withColumn("p_value", _lilliefors_p(F.col("n").cast("double"), F.col("stat")))


def _lilliefors_p(n: Column, stat: Column) -> Column:
    big = n > 100
    d = F.when(big, stat * F.pow(n / 100, F.lit(0.49))).otherwise(stat)
    m = F.when(big, F.lit(100.0)).otherwise(n)
    small_p = F.exp(
        -7.01256 * d * d * (m + 2.78019) + 2.99587 * d * F.sqrt(m + 2.78019)
        - 0.122119 + 0.974598 / F.sqrt(m) + 1.67997 / m
    )
    k = (F.sqrt(n) - 0.01 + 0.85 / F.sqrt(n)) * stat
    large_p = F.when(k <= 0.302, F.lit(1.0))
    for bound, coefficients in STEPHENS:
        large_p = large_p.when(k <= bound, polynomial(k, coefficients))
    large_p = large_p.otherwise(F.lit(0.0))
    return F.when(stat.isNotNull(), F.when(small_p <= 0.1, small_p).otherwise(large_p))


def shapiro(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Shapiro-Wilk W per group of any size.

    Groups below 3 values have a null statistic and p-value. The p-value's approximation is published
    for up to 5000 values and carried on beyond.
    """
    hist = value_histogram(df, value, by)
    few = (
        hist.where("total < 3")
        .groupBy(*by)
        .agg(F.max("total").alias("n"))
        .withColumns({c: F.lit(None).cast("double") for c in ("stat", "p_value")})
    )
    last = F.col("before") + F.col("n")
    ranked = (
        hist.where("total >= 3")
        .withColumn("_from", F.explode(F.sequence(F.col("before") + 1, last, F.lit(RUN).cast("bigint"))))
        .withColumn("i", F.explode(F.sequence(F.col("_from"), F.least(last, F.col("_from") + RUN - 1))))
        .select(*by, F.col(value).alias("x"), F.col("total").cast("double").alias("n"), "i")
        .withColumn("_p", (F.col("i") - 0.375) / (F.col("n") + 0.25))
        .withColumn("m", normal_quantile(F.col("_p")))
    )
    i, n, m = F.col("i"), F.col("n"), F.col("m")
    sums = ranked.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.avg("x").alias("_mean"),
        F.sum(m * m).alias("_mm"),
        F.max(F.when(i == n, m)).alias("_m1"),
        F.max(F.when(i == n - 1, m)).alias("_m2"),
    )
    u = 1 / F.sqrt(n)
    length = F.sqrt(F.col("_mm"))
    sums = sums.withColumns(
        {
            "_a1": F.when(n == 3, F.sqrt(F.lit(0.5))).otherwise(
                polynomial(u, ROYSTON_LAST) + F.col("_m1") / length
            ),
            "_a2": polynomial(u, ROYSTON_NEXT) + F.col("_m2") / length,
        }
    )
    m1, m2, a1, a2 = (F.col(c) for c in ("_m1", "_m2", "_a1", "_a2"))
    inner_two = (F.col("_mm") - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)
    inner_one = (F.col("_mm") - 2 * m1 * m1) / (1 - 2 * a1 * a1)
    sums = sums.withColumn(
        "_scale", F.when(n > 5, F.sqrt(inner_two)).when(n > 3, F.sqrt(inner_one)).otherwise(F.lit(1.0))
    ).drop("n")
    weighted = attach_measured(ranked, sums, list(by))
    from_end = F.least(i, n + 1 - i)
    size = (
        F.when(from_end == 1, a1)
        .when((from_end == 2) & (n > 5), a2)
        .otherwise(F.abs(m) / F.col("_scale"))
    )
    weight = F.when(2 * i == n + 1, F.lit(0.0)).otherwise(F.signum(m) * size)
    deviation = F.col("x") - F.col("_mean")
    w = F.try_divide(
        F.pow(F.sum(weight * F.col("x")), F.lit(2.0)), F.sum(deviation * deviation)
    )
    return (
        weighted.groupBy(*by)
        .agg(F.max("n").cast("long").alias("n"), F.least(w, F.lit(1.0)).alias("stat"))
        .withColumn("p_value", _shapiro_p(F.col("n").cast("double"), F.col("stat")))
        .unionByName(few)
    )


def _shapiro_p(n: Column, w: Column) -> Column:
    exact3 = 6 / F.pi() * (F.asin(F.sqrt(w)) - F.asin(F.sqrt(F.lit(0.75))))
    y = F.ln(1 - w)
    gamma = polynomial(n, ROYSTON_SMALL_GAMMA)
    small = normal_cdf(
        -(-F.ln(gamma - y) - polynomial(n, ROYSTON_SMALL_MEAN))
        / F.exp(polynomial(n, ROYSTON_SMALL_SD))
    )
    ln_n = F.ln(n)
    large = normal_cdf(
        -(y - polynomial(ln_n, ROYSTON_LARGE_MEAN)) / F.exp(polynomial(ln_n, ROYSTON_LARGE_SD))
    )
    return (
        F.when(w.isNull(), F.lit(None).cast("double"))
        .when(w >= 1, F.lit(1.0))
        .when(n == 3, F.greatest(exact3, F.lit(0.0)))
        .when((n <= 11) & (y >= gamma), F.lit(0.0))
        .when(n <= 11, small)
        .otherwise(large)
    )


def test_by_size(
    df: DataFrame, value: str, by: Sequence[str], small: str, large: str, above: int
) -> DataFrame:
    """One test for groups with more than ``above`` values, another for the rest, and the decision
    at 5 %. ``small`` and ``large`` name one of the three group tests of this module."""
    tests = {"dagostino": dagostino, "lilliefors": lilliefors, "shapiro": shapiro}
    data = clean_numbers(df, value).select(*by, value)
    sizes = data.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    sized = attach_measured(data, sizes, list(by))
    keep = {small: F.col("_size") <= above, large: F.col("_size") > above}
    parts = [
        tests[name](sized.where(keep[name]), value, by).select(
            *by, "n", F.lit(name).alias("test_name"), "stat", "p_value"
        )
        for name in (small, large)
    ]
    return parts[0].unionByName(parts[1]).withColumn("is_normal", F.col("p_value") > ALPHA)


test_by_size.__test__ = False
