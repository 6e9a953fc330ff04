import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import decay, group_tests, normality, summaries
from tidewright.plans.halflife import dependable, half_life_report

# Sample and results published in the documentation of widely used statistics packages.
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def grouped(spark, groups):
    return spark.createDataFrame([(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs], "g string, v double")


def test_published_normality_results(spark):
    df = grouped(spark, {"w": WEIGHTS})
    jb = normality.jarque_bera(df, ["v"]).first()
    assert (jb["stat"], jb["p_value"]) == (pytest.approx(6.982848237344646), pytest.approx(0.03045746622458189))
    assert jb["is_normal"] is False
    k2 = normality.dagostino(df, "v", ["g"]).first()
    assert (k2["stat"], k2["p_value"]) == (pytest.approx(13.034263121192582), pytest.approx(0.0014779023013100172))
    w = normality.shapiro(df, "v", ["g"]).first()
    assert (w["stat"], w["p_value"]) == (pytest.approx(0.7888147830963135, abs=1e-6), pytest.approx(0.006703814, abs=1e-6))


def test_lilliefors_matches_brute_force(spark):
    rng = random.Random(3)
    groups = {"a": [rng.gauss(0, 1) for _ in range(150)], "b": [round(rng.expovariate(1), 1) for _ in range(80)]}
    got = {r["g"]: r for r in normality.lilliefors(grouped(spark, groups), "v", ["g"]).collect()}
    for g, values in groups.items():
        x = np.sort(values)
        n, z = len(x), (x - np.mean(x)) / np.std(x, ddof=1)
        phi = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
        i = np.arange(1, n + 1)
        assert got[g]["stat"] == pytest.approx(max((i / n - phi).max(), (phi - (i - 1) / n).max()), abs=1e-9)
    assert got["a"]["p_value"] > 0.05 > got["b"]["p_value"]


def test_lilliefors_without_scale(spark):
    got = {r["g"]: r for r in normality.lilliefors(grouped(spark, {"flat": [2, 2, 2], "one": [1], "ok": [1, 2, 4, 9]}), "v", ["g"]).collect()}
    assert got["flat"]["stat"] is got["flat"]["p_value"] is got["one"]["stat"] is None
    assert 0 < got["ok"]["p_value"] <= 1
    small = normality.test_by_size(grouped(spark, {"a": [1]}), "v", ["g"], "shapiro", "lilliefors", 6000).first()
    assert (small["n"], small["test_name"], small["stat"], small["is_normal"]) == (1, "shapiro", None, None)


def test_no_group_is_lost(spark):
    rng = random.Random(8)
    groups = {"many": [rng.gauss(0, 1) for _ in range(6000)], "tied": [1] * 11_000 + [2] * 11_000, "one": [1], "two": [1, 2]}
    got = {r["g"]: r for r in normality.shapiro(grouped(spark, groups), "v", ["g"]).collect()}
    assert {g: r["n"] for g, r in got.items()} == {"many": 6000, "tied": 22_000, "one": 1, "two": 2}
    assert got["many"]["stat"] > 0.99 and 0.5 < got["tied"]["stat"] < 0.7 and got["one"]["stat"] is got["two"]["p_value"] is None
    k2 = {r["g"]: r for r in normality.dagostino(grouped(spark, {"flat": [3] * 9, **groups}), "v", ["g"]).collect()}
    assert set(k2) == {"flat", *groups} and k2["two"]["stat"] is k2["one"]["p_value"] is None and k2["many"]["stat"] is not None


def test_density_keeps_groups_without_spread(spark):
    got = summaries.density(grouped(spark, {"flat": [5, 5, 5], "one": [7], "ok": [1, 2, 4]}), "v", ["g"], grid=10).collect()
    assert sorted((r["g"], r["point"], r["x"], r["density"]) for r in got if r["g"] != "ok") == [("flat", 0, 5.0, None), ("one", 0, 7.0, None)]
    assert sorted(r["point"] for r in got if r["g"] == "ok") == list(range(10)) and all(r["density"] for r in got if r["g"] == "ok")


def test_shapiro_edges(spark):
    got = {r["g"]: r for r in normality.shapiro(grouped(spark, {"three": [1, 2, 4], "flat": [5, 5, 5, 5], "two": [1, 2]}), "v", ["g"]).collect()}
    assert set(got) == {"three", "flat", "two"} and got["two"]["stat"] is got["two"]["p_value"] is None
    assert got["three"]["stat"] == pytest.approx(0.9642857, abs=1e-6)
    assert got["flat"]["stat"] == 1.0 and got["flat"]["p_value"] == 1.0


def test_test_choice(spark):
    rng = random.Random(5)
    groups = {"small": [rng.gauss(0, 1) for _ in range(50)], "large": [rng.gauss(0, 1) for _ in range(51)]}
    got = {r["g"]: r["test_name"] for r in normality.test_by_size(grouped(spark, groups), "v", ["g"], "shapiro", "lilliefors", 50).collect()}
    assert got == {"small": "shapiro", "large": "lilliefors"}


def test_published_group_tests(spark):
    kw = group_tests.kruskal(grouped(spark, {"x": [1, 3, 5, 7, 9], "y": [2, 4, 6, 8, 10, None]}), "v", "g").first()
    assert (kw["stat"], kw["p_value"]) == (pytest.approx(0.2727272727272734), pytest.approx(0.6015081344405895))
    abc = {
        "a": [8.88, 9.12, 9.04, 8.98, 9.00, 9.08, 9.01, 8.85, 9.06, 8.99],
        "b": [8.88, 8.95, 9.29, 9.44, 9.15, 9.58, 8.36, 9.18, 8.67, 9.05],
        "c": [8.95, 9.12, 8.95, 8.85, 9.03, 8.84, 9.07, 8.98, 8.86, 8.98],
    }
    lev = group_tests.levene(grouped(spark, abc), "v", "g").first()
    assert (lev["stat"], lev["p_value"]) == (pytest.approx(7.584952754501659), pytest.approx(0.002431505967249681))


def test_dunn_with_ties_matches_brute_force(spark):
    groups = {"a": [1, 2, 2, 3, 9], "b": [2, 5, 6, 6], "c": [7, 8, 9, 9, 9, 10]}
    values = np.array([v for vs in groups.values() for v in vs], dtype=float)
    n = len(values)
    rank = {v: (values < v).sum() + ((values == v).sum() + 1) / 2 for v in values}
    ties = sum(c**3 - c for c in np.unique(values, return_counts=True)[1])
    mean = {g: np.mean([rank[v] for v in vs]) for g, vs in groups.items()}
    raw = {}
    for a, b in (("a", "b"), ("a", "c"), ("b", "c")):
        se = math.sqrt((n * (n + 1) / 12 - ties / (12 * (n - 1))) * (1 / len(groups[a]) + 1 / len(groups[b])))
        raw[a, b] = math.erfc(abs(mean[a] - mean[b]) / se / math.sqrt(2))
    order = sorted(raw, key=raw.get, reverse=True)
    adjusted, low = {}, 1.0
    for place, pair in enumerate(order):
        low = min(low, raw[pair] * 3 / (3 - place))
        adjusted[pair] = low
    got = {(r["group_a"], r["group_b"]): r for r in group_tests.dunn(grouped(spark, groups), "v", "g").collect()}
    assert set(got) == set(raw)
    for pair in raw:
        assert got[pair]["p_value"] == pytest.approx(raw[pair], abs=1e-10)
        assert got[pair]["p_adjusted"] == pytest.approx(adjusted[pair], abs=1e-10)
    matrix = group_tests.p_matrix(group_tests.dunn(grouped(spark, groups), "v", "g"))
    assert matrix.count() == 9


def test_spearman_uses_complete_rows(spark):
    rng = random.Random(11)
    data = [(i, float(rng.randrange(5)), rng.random(), rng.random() if i % 7 else None) for i in range(300)]
    got = {(r[0], r[1]): r[2] for r in group_tests.spearman(spark.createDataFrame(data, "k int, a double, b double, c double"), "k", ["a", "b", "c"]).collect()}
    full = np.array([d[1:] for d in data if d[3] is not None])
    ranks = np.array([[(col < v).sum() + ((col == v).sum() + 1) / 2 for v in col] for col in full.T])
    want = np.corrcoef(ranks)
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert got[a, b] == pytest.approx(want[i, j], abs=1e-9)


def test_leading_values_edges(spark):
    def kept(*counts):
        df = spark.createDataFrame([(name,) for name, n in counts for _ in range(n)], "lang string")
        return sorted(r["lang"] for r in summaries.leading_values(df, "lang").collect())

    assert kept(("a", 91), ("b", 9)) == []
    assert kept(("a", 60), ("b", 30), ("c", 10)) == ["a", "b"]
    assert kept(("a", 50), ("b", 25), ("c", 25)) == ["a", "b"]


def test_share_counts_null_labels(spark):
    df = spark.createDataFrame([("v", "positive"), ("v", None), ("v", "negative"), ("v", "positive")], "k string, l string")
    assert summaries.class_share(df, "k", "l", "positive", "share").first()["share"] == 50.0


def test_mode_takes_lowest_on_ties(spark, rows):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("g", None), ("g", None)], "k string, x string")
    assert rows(summaries.group_mode(df, "x", ["k"])) == [("g", "a")]


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 2, 10)], "v double").withColumn("g", F.lit("x"))
    assert [r["n"] for r in summaries.histogram(df, "v", 5).orderBy("bin").collect()] == [3, 1, 0, 0, 1]
    flat = df.where("v = 1")
    assert sum(r["n"] for r in summaries.histogram(flat, "v", 5).collect()) == 2
    box = summaries.box_stats(df, "v", ["g"]).first()
    assert (box["q1"], box["median"], box["q3"], box["whisker_low"], box["whisker_high"], box["n_outliers"]) == (1, 1, 2, 0, 2, 1)
    assert [tuple(r) for r in summaries.box_outliers(df, "v", ["g"]).collect()] == [("x", 10.0, 1)]


def test_density_integrates_to_one(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([("g", rng.gauss(5, 2)) for _ in range(500)], "g string, v double")
    got = sorted((r["x"], r["density"]) for r in summaries.density(df, "v", ["g"], cut=5).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(got, got[1:]))
    assert area == pytest.approx(1, abs=1e-3)


# ---- decay


def curve(rate, start, floor, noise, n=200, seed=1):
    rng = random.Random(seed)
    return [(t, start * math.exp(-rate * t) + floor + rng.gauss(0, noise)) for t in range(n)]


def gauss_newton(points, v0, rate, floor):
    """Independent least-squares fit from a good start, with its covariance."""
    t, y = np.array(points, dtype=float).T
    for _ in range(50):
        e = np.exp(-rate * t)
        jac = np.column_stack([e, -v0 * t * e, np.ones_like(t)])
        step = np.linalg.lstsq(jac, y - (v0 * e + floor), rcond=None)[0]
        v0, rate, floor = v0 + step[0], rate + step[1], floor + step[2]
    e = np.exp(-rate * t)
    jac = np.column_stack([e, -v0 * t * e, np.ones_like(t)])
    noise = ((y - v0 * e - floor) ** 2).sum() / (len(t) - 3)
    return rate, v0, floor, math.sqrt(np.linalg.inv(jac.T @ jac)[1, 1] * noise)


@pytest.fixture(scope="module")
def fits(spark):
    data = {
        "fast": curve(0.3, 5000, 50, 5), "slow": curve(0.01, 800, 10, 2), "twice": curve(0.05, 900, 12, 8) + curve(0.05, 900, 12, 8, seed=9),
        "flat": [(t, 7.0) for t in range(30)], "rising": [(t, float(t)) for t in range(30)], "three": [(0, 9.0), (1, 5.0), (2, 3.0)],
        "no floor": curve(0.02, 1000, 0, 30, n=40),
        "steep": [(t / 200, y) for t, y in curve(0.2, 3000, 40, 1)], "lasting": [(t * 5000, y) for t, y in curve(0.01, 800, 10, 2, seed=5)],
        "one age": [(3, 5.0)] * 6,
        "late": [(t, y) for t, y in curve(0.04, 1000, 20, 3, seed=4) if t >= 9 and t % 6 == 0],
    }
    df = spark.createDataFrame([(g, float(t), float(y)) for g, pts in data.items() for t, y in pts] + [("fast", None, 1.0)], "g string, t double, y double")
    table = decay.half_life_bounds(decay.fit_decay(df, "g", "t", "y"))
    return df, data, {r["g"]: r for r in table.collect()}


@pytest.mark.parametrize("name, start", [("fast", (5000, 0.3, 50)), ("slow", (800, 0.01, 10)), ("twice", (900, 0.05, 12)), ("steep", (3000, 40, 40)), ("lasting", (800, 2e-6, 10)), ("late", (1000, 0.04, 20))])
def test_fit_matches_least_squares(fits, name, start):
    _, data, got = fits
    rate, v0, floor, error = gauss_newton(data[name], *start)
    row = got[name]
    assert row["decay_const"] == pytest.approx(rate, rel=2e-5)
    assert row["start_value"] == pytest.approx(v0, rel=1e-4)
    assert row["floor_value"] == pytest.approx(floor, rel=1e-2, abs=1e-1)
    assert row["rate_error"] == pytest.approx(error, rel=1e-3)
    assert row["half_life"] == pytest.approx(math.log(2) / rate, rel=1e-4)
    assert row["lower"] < row["half_life"] < row["upper"]


def test_fit_bounds_and_degenerate_groups(fits):
    _, _, got = fits
    assert got["rising"]["start_value"] == 0 and got["rising"]["floor_value"] == pytest.approx(14.5)
    assert got["no floor"]["floor_value"] >= 0
    assert got["one age"]["start_value"] == 0 and got["one age"]["floor_value"] == 5
    for name in ("flat", "rising", "three", "one age"):
        assert got[name]["upper"] == float("inf") and got[name]["margin"] is None


def test_half_life_report(spark, fits):
    df, _, _ = fits
    report = half_life_report(df.withColumn("f", F.lit("Long-form")), "g", "t", "y", "f")
    rows = {r["g"]: r for r in report.collect()}
    assert rows["fast"]["tier"] == "Reliable" and rows["fast"]["half_life_estimate"] == 2
    assert rows["flat"]["tier"] == "Unreliable" and rows["flat"]["rel_moe"] is None
    listed = [r["half_life_estimate"] for r in dependable(report, "g", "f").collect()]
    assert listed == sorted(listed, reverse=True) and 14 in listed


@pytest.mark.parametrize("margin, tier", [(9.99, "Reliable"), (10, "Acceptable"), (20, "Proceed with Caution"), (40, "Unreliable"), (None, "Unreliable")])
def test_tiers(spark, margin, tier):
    assert spark.range(1).select(decay.reliability_tier(F.lit(margin).cast("double"))).first()[0] == tier


def test_density_looks_at_what_a_kernel_reaches(spark):
    """Two far clusters: the points between them get nothing and stay, as zeros."""
    values = [i / 1000 for i in range(2000)] + [5000 + i / 1000 for i in range(2000)] * 40
    narrow = [0.0, 1.0] * 60_000 + [1e4]
    df = spark.createDataFrame([("two", v) for v in values] + [("one", v) for v in narrow] + [("flat", 3.0)] * 4 + [(None, 1.0), (None, 2.0)], "g string, v double")
    got = summaries.density(df, "v", ["g"]).collect()
    for g in ("two", "one", None):
        own = np.array([v for h, v in [("two", v) for v in values] + [("one", v) for v in narrow] + [(None, 1.0), (None, 2.0)] if h == g])
        rows = sorted((r.point, r.x, r.density) for r in got if r.g == g)
        width = own.std(ddof=1) * len(own) ** -0.2
        assert [p for p, _, _ in rows] == list(range(100))
        kinds, n = np.unique(own, return_counts=True)
        for _, x, d in rows:
            assert d == pytest.approx((n * np.exp(-0.5 * ((x - kinds) / width) ** 2)).sum() / len(own) / width / np.sqrt(2 * np.pi), rel=1e-9, abs=1e-300)
    assert [(r.point, r.x, r.density) for r in got if r.g == "flat"] == [(0, 3.0, None)]
    assert any(r.density == 0 for r in got if r.g == "one")
