"""Exponential decay V(t) = V0 * exp(-rate * t) + floor per group, with bounds and reliability.

The fit needs only (group, t) cells, so the data is reduced to them once. For a fixed rate the best
non-negative V0 and floor are closed-form (variable projection); the rate is found on a geometric
grid that is refined around each group's best point. The grid spans every rate that the group's ages
can tell apart in double precision, so it yields the global optimum, where an iterative solver would
yield the optimum near its starting point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.rates import half_even, half_life
from tidewright.session import cut_lineage
from tidewright.schemas import LOWEST_TIER, RELIABILITY_TIERS

GRID, ROUNDS = 200, 5
# Rates the ages of a group can tell apart. A curve that loses a smaller share over the whole span is a
# line in double precision; one that loses more e-folds by the second age is at its floor there.
LEAST_LOSS, MOST_FOLDS = 1e-7, 40.0
Z95 = 1.96


def decay_cells(df: DataFrame, group: str, t: str, y: str) -> DataFrame:
    """Complete rows reduced to size, mean and inner scatter per (group, t)."""
    t_col, y_col = F.col(t).cast("double"), F.col(y).cast("double")
    return (
        df.select(F.col(group).alias("g"), t_col.alias("t"), y_col.alias("y"))
        .where("g IS NOT NULL AND t IS NOT NULL AND y IS NOT NULL AND NOT isnan(t) AND NOT isnan(y)")
        .groupBy("g", "t")
        .agg(
            F.count(F.lit(1)).cast("double").alias("w"),
            F.avg("y").alias("y"),
            (F.var_pop("y") * F.count(F.lit(1))).alias("scatter"),
        )
    )


def _best_on_grid(cells: DataFrame, rates: DataFrame) -> DataFrame:
    """Best rate per group among centre * exp(j * log_step), j = -GRID/2 .. GRID/2; the next grid has
    the two steps around it."""
    steps = F.explode(F.sequence(F.lit(-(GRID // 2)), F.lit(GRID // 2)))
    grid = (
        cells.join(rates, "g")
        .withColumn("j", steps)
        .withColumn("rate", F.col("centre") * F.exp(F.col("log_step") * F.col("j")))
    )
    # x = 1 - exp(-rate t): the model is linear in x, top = V0 + floor and slope = -V0. Time counts
    # from the group's first age, so x runs from 0 to at most 1 whatever the rate; with the centred y
    # this keeps precision for nearly flat, very steep and nearly perfect curves.
    w, x, y = F.col("w"), -F.expm1(-F.col("rate") * F.col("t")), F.col("y") - F.col("y_mean")
    sums = (
        grid.withColumns({"x": x, "yc": y})
        .groupBy("g", "j")
        .agg(
            F.first("rate").alias("rate"),
            F.sum("w").alias("n"),
            F.sum(w * F.col("x")).alias("sx"),
            F.sum(w * F.col("x") * F.col("x")).alias("sxx"),
            F.sum(w * F.col("x") * F.col("yc")).alias("sxy"),
            F.sum(w * F.col("yc") * F.col("yc")).alias("syy"),
            F.first("y_mean").alias("y_mean"),
            F.first("log_step").alias("log_step"),
        )
    )
    n, sx, sxx, sxy, syy = (F.col(c) for c in ("n", "sx", "sxx", "sxy", "syy"))
    cxx = sxx - sx * sx / n
    ybar = F.col("y_mean")
    start = F.coalesce(-F.try_divide(sxy, cxx), F.lit(0.0))
    floor = ybar + start * sx / n - start  # intercept ybar + V0*xbar is V0 + floor
    # On the boundary floor = 0 the curve is V0 * (1 - x); centred sums give its best V0.
    e_e = n - 2 * sx + sxx
    e_y = n * ybar - (sxy + ybar * sx)
    start0 = F.greatest(F.coalesce(F.try_divide(e_y, e_e), F.lit(0.0)), F.lit(0.0))
    flat = F.greatest(ybar, F.lit(0.0))
    solved = sums.select(
        "g", "j", "rate", "log_step", "n", "sx", "sxx", "sxy", "syy", "y_mean",
        F.when(start <= 0, F.lit(0.0)).when(floor < 0, start0).otherwise(start).alias("v0"),
        F.when(start <= 0, flat).when(floor < 0, F.lit(0.0)).otherwise(floor).alias("floor"),
    )
    # Residual about y_mean is yc - (d - V0 x) with d = V0 + floor - y_mean.
    v0, d = F.col("v0"), F.col("v0") + F.col("floor") - ybar
    sse = syy + n * d * d + v0 * v0 * sxx + 2 * v0 * sxy - 2 * d * v0 * sx
    fit = F.struct("rate", "v0", "floor", "log_step")
    return (
        solved.withColumn("sse", sse)
        .groupBy("g")
        # Rates that fit alike (a flat group) leave the centre where it is.
        .agg(F.min_by(fit, F.struct("sse", F.abs("j"))).alias("fit"))
        .select(
            "g", F.col("fit.rate").alias("centre"), (2 * F.col("fit.log_step") / GRID).alias("log_step"),
            F.col("fit.v0"), F.col("fit.floor"),
        )
    )


def fit_decay(df: DataFrame, group: str, t: str, y: str) -> DataFrame:
    """Fitted parameters, standard error of the rate and residual size per group.

    A group with one age has no rate to find: it keeps the rate 1 and an infinite error.
    """
    cells = decay_cells(df, group, t, y)
    # Bounded by groups x distinct ages; read by every round below.
    cells = cut_lineage(cells)
    means = cells.groupBy("g").agg(
        (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("y_mean"),
        F.sum("scatter").alias("inner"),
        F.min("t").alias("t_min"),
    )
    cells = cells.join(means.select("g", "y_mean", "t_min"), "g").withColumn("t", F.col("t") - F.col("t_min"))
    later = F.when(F.col("t") > 0, F.col("t"))
    ends = cells.groupBy("g").agg((LEAST_LOSS / F.max(later)).alias("low"), (MOST_FOLDS / F.min(later)).alias("high"))
    one_age = F.col("low").isNull()
    best = ends.select(
        "g",
        F.when(one_age, 1.0).otherwise(F.exp((F.ln("low") + F.ln("high")) / 2)).alias("centre"),
        F.when(one_age, 0.0).otherwise((F.ln("high") - F.ln("low")) / GRID).alias("log_step"),
    )
    for _ in range(ROUNDS):
        best = _best_on_grid(cells, best.select("g", "centre", "log_step"))
    rate, v0, floor = F.col("centre"), F.col("v0"), F.col("floor")
    e = F.exp(-rate * F.col("t"))
    te = F.col("t") * e
    miss = F.col("y") - (v0 * e + floor)
    w = F.col("w")
    sums = cells.join(best, "g").groupBy("g").agg(
        F.first("centre").alias("decay_const"),
        F.first("v0").alias("start_value"),
        F.first("floor").alias("floor_value"),
        F.sum("w").alias("n"),
        F.sum(w * miss * miss).alias("_miss"),
        F.sum(w * e * e).alias("_ee"),
        F.sum(w * e).alias("_e"),
        F.sum(w * e * te).alias("_ete"),
        F.sum(w * te).alias("_te"),
        F.sum(w * te * te).alias("_tete"),
    )
    n, ee, e1, ete, te1, tete = (F.col(c) for c in ("n", "_ee", "_e", "_ete", "_te", "_tete"))
    v = F.col("start_value")
    # Normal matrix of (V0, rate, floor): [[ee, -v ete, e], [., v^2 tete, -v te], [., ., n]]. Shifting
    # the time rescales V0 only, so the variance of the rate is that of the unshifted model.
    minor = ee * n - e1 * e1
    det = v * v * (tete * minor - ete * (ete * n - te1 * e1) + te1 * (ete * e1 - te1 * ee))
    noise = F.try_divide(F.col("sse"), n - 3)
    return (
        sums.join(means.select("g", "inner", "t_min"), "g")
        .withColumn("sse", F.col("_miss") + F.col("inner"))
        .withColumn(
            "rate_error",
            F.when((n > 3) & (det > 0), F.sqrt(noise * F.try_divide(minor, det))).otherwise(
                F.lit(float("inf"))
            ),
        )
        .select(
            F.col("g").alias(group), n.cast("long").alias("n"), "decay_const",
            F.when(v == 0, 0.0).otherwise(v * F.exp(F.col("decay_const") * F.col("t_min"))).alias("start_value"),
            "floor_value", "sse", "rate_error",
        )
    )


def half_life_bounds(fits: DataFrame) -> DataFrame:
    """Half-life with 95 % bounds; an interval reaching zero decay has no upper bound or margin."""
    rate, error = F.col("decay_const"), F.col("rate_error")
    slow = rate - Z95 * error
    out = fits.withColumns(
        {
            "half_life": half_life(rate),
            "lower": half_life(rate + Z95 * error),
            "upper": F.when(slow > 0, half_life(slow)).otherwise(F.lit(float("inf"))),
        }
    )
    margin = (F.col("upper") - F.col("lower")) / 2 / F.col("half_life") * 100
    return out.withColumn("margin", F.when(F.col("upper") < float("inf"), margin))


def reliability_tier(margin):
    chain = None
    for label, bound in RELIABILITY_TIERS:
        chain = (F if chain is None else chain).when(margin < bound, F.lit(label))
    return chain.otherwise(F.lit(LOWEST_TIER))


def half_life_table(df: DataFrame, group: str, t: str, y: str) -> DataFrame:
    """One row per group: rate, rounded half-life, bounds, relative margin and tier."""
    fits = half_life_bounds(fit_decay(df, group, t, y))
    return fits.select(
        group,
        "decay_const",
        # A curve that hardly falls can have a half-life beyond an integer: null.
        half_even(F.col("half_life")).try_cast("int").alias("half_life_estimate"),
        half_even(F.col("lower"), 2).alias("estimate_lb"),
        half_even(F.col("upper"), 2).alias("estimate_ub"),
        half_even(F.col("margin"), 2).alias("rel_moe"),
        reliability_tier(F.col("margin")).alias("tier"),
    )
