import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import ranks, snapshots, summaries
from tidewright.operators.hotkeys import attach_counted


def numpy_ranks(values):
    values = np.asarray(values, dtype=float)
    return {v: (values < v).sum() + ((values == v).sum() + 1) / 2 for v in values}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one value a third of them."""
    rng = random.Random(7)
    data = [("hot", 1.0) for _ in range(700)] + [("hot", rng.random() * 50) for _ in range(900)]
    data += [(f"g{i % 5}", float(rng.randrange(30))) for i in range(400)] + [("null", None), ("nan", float("nan"))]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, v double"), data


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_ranks_do_not_depend_on_partitioning(spark, skewed, partitions):
    df, data = skewed
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["v"]: r["avg_rank"] for r in ranks.average_ranks(df, "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == numpy_ranks([v for _, v in data if v is not None and v == v])


def test_group_ranks_and_totals(spark, skewed):
    df, data = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = ranks.average_ranks(df, "v", ["g"]).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g in {g for g, _ in data} - {"null", "nan"}:
        values = [v for h, v in data if h == g]
        assert {r["v"]: r["avg_rank"] for r in got if r["g"] == g} == numpy_ranks(values)
        assert {r["total"] for r in got if r["g"] == g} == {len(values)}


def test_quantiles_and_median(spark, skewed):
    df, data = skewed
    probs = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    got = {r["g"]: r for r in ranks.exact_quantiles(df, "v", probs, ["g"]).collect()}
    medians = {r["g"]: r["median"] for r in summaries.group_median(df, "v", ["g"]).collect()}
    for g in got:
        values = [v for h, v in data if h == g]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p))
        assert medians[g] == pytest.approx(median(values))


def test_row_numbers_are_complete(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    out = ranks.row_numbers(df, [F.desc("id")], ["g"]).collect()
    for r in out:
        assert r["row_number"] == (999 - r["id"]) // 3 + 1 if r["g"] == 0 else True
    assert sorted((r["g"], r["row_number"]) for r in out) == sorted((i % 3, i // 3 + 1) for i in range(1000))


def test_null_group_is_a_group(spark, rows):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert rows(summaries.group_median(df, "v", ["g"]), "g", "median") == [("a", 2.0), (None, 2.0)]


def test_attach_counted_equals_plain_join(spark, rows):
    left = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"), "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.col("k") * 10)
    got = attach_counted(left, right, ["k"], "n", shares=8)
    assert rows(got, "k", "id", "label") == rows(left.join(right, "k"), "k", "id", "label")


def test_first_and_last_agree_with_ranks(spark, rows):
    data = [("a", "2024-01-03", 5, None), ("a", "2024-01-01", 1, 4), ("b", "2024-01-02", 7, 8), ("a", "2024-01-02", 9, 9)]
    df = spark.createDataFrame(data, "k string, d string, x int, y int").withColumn("ts", F.col("d").cast("timestamp"))
    one = snapshots.first_and_last(df, "k", "ts", ["x", "y"])
    two = snapshots.first_and_last_by_rank(df, "k", "ts", ["x", "y"])
    assert rows(one) == rows(two.select(*one.columns))
    a = one.where("k = 'a'").first()
    assert (a["earliest_x"], a["latest_x"], a["earliest_y"], a["latest_y"]) == (1, 5, 4, None)


def test_reduction_plan_has_no_window(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, ts int, x int")
    plan = snapshots.first_and_last(df, "k", "ts", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan


def test_latest_row_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, ts int, x string")
    plan = snapshots.latest_row(df, ["k"], [F.desc("ts")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_window_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kept = df.where(snapshots.in_window(F.col("ts"), "2024-01-05 00:00:00", "2024-01-06 00:00:00")).select("event_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


@pytest.mark.parametrize("slab_rows", [7, 10_000])
def test_running_scans(spark, monkeypatch, slab_rows):
    monkeypatch.setattr(ranks, "SLAB_ROWS", slab_rows)
    rng = random.Random(3)
    data = [(i, rng.randrange(50), rng.random()) for i in range(300)]
    df = spark.createDataFrame(data, "i long, w long, x double").repartition(5)
    sums = {r["i"]: r["s"] for r in ranks.running(df, ["i"], "w", "s").collect()}
    lows = {r["i"]: r["m"] for r in ranks.running(df, [F.desc("i")], "x", "m", kind="min").collect()}
    assert sums == {i: sum(w for j, w, _ in data if j <= i) for i, _, _ in data}
    assert lows == {i: min(x for j, _, x in data if j >= i) for i, _, _ in data}


def test_scans_shuffle_rows_once_and_need_no_window(spark):
    df = spark.range(1000).withColumn("n", F.lit(1))
    plan = ranks.running(df, ["id"], "n", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan and "hashpartitioning" not in plan


def test_quantiles_need_no_order(spark, skewed):
    plan = ranks.exact_quantiles(skewed[0], "v", {"q": 0.5}, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("name, value", [("BRACKET", 3), ("ACCURACY", 2)])
def test_quantiles_where_brackets_are_wide(spark, monkeypatch, name, value):
    """Brackets with more values than a task takes, and a sketch as coarse as can be."""
    monkeypatch.setattr(ranks, name, value)
    rng = random.Random(5)
    data = [(f"g{i % 3}", rng.choice([1.0, rng.random(), -rng.random() * 9])) for i in range(900)] + [(None, 4.0), ("g0", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    probs = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q100": 1.0}
    got = {r["g"]: r for r in ranks.exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in ("g0", "g1", "g2", None):
        values = [v for h, v in data if h == g and v is not None]
        assert got[g]["n_values"] == len(values)
        for q, p in probs.items():
            assert got[g][q] == pytest.approx(np.quantile(values, p))
    whole = ranks.exact_quantiles(df, "v", probs).first()
    assert whole["q10"] == pytest.approx(np.quantile([v for _, v in data if v is not None], 0.1))
    assert ranks.exact_quantiles(df.limit(0), "v", probs, ["g"]).count() == 0


def test_quantiles_fall_back_when_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr(F, "percentile_approx", lambda *_: F.array(*[F.lit(2.0)] * 2))
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 9)], "v double")
    assert ranks.exact_quantiles(df, "v", {"q": 0.75}).first()["q"] == 4.0
