"""Aggregation, summary and statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.shapes import WINDOW, Tables
from tidewright.catalog.sqltext import normal_cdf, normal_quantile
from tidewright.functions.rates import float_ratio
from tidewright.functions.text import label_name
from tidewright.functions.times import age_cohort, whole_days
from tidewright.operators import decay, group_tests, normality, ranks, snapshots, summaries
from tidewright.operators.snapshots import in_window
from tidewright.plans.halflife import dependable, half_life_report

COUNTERS = ["view_count", "like_count", "comment_count"]


def micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- aggregation

FIRST_LAST_SQL = """
    SELECT video_id, epoch_us(min(scraped_at)) AS first_scraped_at, epoch_us(max(scraped_at)) AS last_scraped_at,
           max(view_count) FILTER (WHERE up = 1) AS earliest_view_count, max(view_count) FILTER (WHERE down = 1) AS latest_view_count,
           max(like_count) FILTER (WHERE up = 1) AS earliest_like_count, max(like_count) FILTER (WHERE down = 1) AS latest_like_count,
           max(comment_count) FILTER (WHERE up = 1) AS earliest_comment_count, max(comment_count) FILTER (WHERE down = 1) AS latest_comment_count
    FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY scraped_at) AS up,
                 row_number() OVER (PARTITION BY video_id ORDER BY scraped_at DESC) AS down
          FROM snapshots WHERE scraped_at >= TIMESTAMP '2024-01-05' AND scraped_at < TIMESTAMP '2024-01-26') AS r
    GROUP BY video_id"""


def windowed(t: Tables) -> DataFrame:
    return t.snapshots().where(in_window(F.col("scraped_at"), *WINDOW))


@query("a01_first_and_last", FIRST_LAST_SQL)
def a01(t: Tables) -> DataFrame:
    out = snapshots.first_and_last(windowed(t), "video_id", "scraped_at", COUNTERS)
    return out.withColumns({c: micros(c) for c in ("first_scraped_at", "last_scraped_at")})


@query("a02_filtered_aggregate", FIRST_LAST_SQL)
def a02(t: Tables) -> DataFrame:
    out = snapshots.first_and_last_by_rank(windowed(t), "video_id", "scraped_at", COUNTERS)
    return out.withColumns({c: micros(c) for c in ("first_scraped_at", "last_scraped_at")})


@query(
    "a03_group_by_computed_label",
    """SELECT l_returnflag, CASE WHEN d < 30 THEN 'New Release (<30 Days)' WHEN d < 180 THEN 'Recent (1-6 Months)'
              WHEN d < 720 THEN 'Catalog (6-24 Months)' ELSE 'Legacy (2+ Years)' END AS cohort, count(*) AS n, sum(l_quantity) AS quantity
       FROM (SELECT l_returnflag, l_quantity, datesub('day', o_orderdate, l_shipdate) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS s
       GROUP BY ALL""",
)
def a03(t: Tables) -> DataFrame:
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    cohort = age_cohort(whole_days(F.col("l_shipdate"), F.col("o_orderdate")))
    return (
        joined.withColumn("cohort", cohort).groupBy("l_returnflag", "cohort")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    )


@query("a04_scalar_aggregates", "SELECT max(value) AS top, min(value) AS low, round(avg(value), 8) AS mean, epoch_us(max(ts)) AS mark FROM events")
def a04(t: Tables) -> DataFrame:
    return t.table("events").agg(
        F.max("value").alias("top"), F.min("value").alias("low"), F.round(F.avg("value"), 8).alias("mean"),
        F.unix_micros(F.max("ts").cast("timestamp")).alias("mark"),
    )


@query("a05_value_counts", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def a05(t: Tables) -> DataFrame:
    return summaries.value_counts(t.table("documents"), "source")


@query("a05_count_non_null", "SELECT video_id, count(comment_count) AS n FROM snapshots GROUP BY video_id")
def a05b(t: Tables) -> DataFrame:
    return summaries.value_counts(t.snapshots(), "video_id", "comment_count")


@query(
    "a06_class_share",
    "SELECT video_id, round(avg(CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS share FROM labelled GROUP BY video_id",
)
def a06(t: Tables) -> DataFrame:
    named = t.labelled().select("video_id", label_name(F.col("label")).alias("sentiment_label"))
    return rounded(summaries.class_share(named, "video_id", "sentiment_label", "positive", "share"), 6, "share")


@query(
    "a07_leading_values",
    """SELECT lang, n, cum_n, total FROM (
         SELECT lang, n, CAST(sum(n) OVER (ORDER BY n DESC, lang ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_n, CAST(sum(n) OVER () AS BIGINT) AS total
         FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) AS c) AS r WHERE cum_n * 100 <= total * 90""",
)
def a07(t: Tables) -> DataFrame:
    return summaries.leading_values(t.table("documents"), "lang")


@query("a08_group_median", "SELECT o_orderpriority, count(*) AS n_values, round(median(o_totalprice), 6) AS median FROM orders GROUP BY o_orderpriority")
def a08(t: Tables) -> DataFrame:
    return summaries.group_median(t.table("orders"), "o_totalprice", ["o_orderpriority"]).withColumn("median", F.round("median", 6))


@query(
    "a09_group_mode",
    """SELECT o_custkey, o_orderpriority FROM (
         SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS r
         FROM orders GROUP BY o_custkey, o_orderpriority) AS m WHERE r = 1""",
)
def a09(t: Tables) -> DataFrame:
    return summaries.group_mode(t.table("orders"), "o_orderpriority", ["o_custkey"])


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "a10_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
            round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
            max({c}) AS max FROM lineitem"""
        for c in DESCRIBED
    ),
)
def a10(t: Tables) -> DataFrame:
    return rounded(summaries.describe(t.table("lineitem"), DESCRIBED), 6, "mean", "std", "q25", "q50", "q75")


@query(
    "a11_cohort_above_baseline",
    """SELECT video_id, round(marginal_engagement_rate, 8) AS rate FROM features WHERE video_age_cohort = 'Legacy (2+ Years)'
         AND marginal_engagement_rate >= (SELECT avg(marginal_engagement_rate) FROM features WHERE video_age_cohort = 'New Release (<30 Days)')""",
)
def a11(t: Tables) -> DataFrame:
    cohort = F.col("video_age_cohort")
    out = summaries.at_least_baseline(
        t.features(), "marginal_engagement_rate", cohort == "Legacy (2+ Years)", cohort == "New Release (<30 Days)"
    )
    return out.select("video_id", F.round("marginal_engagement_rate", 8).alias("rate"))


@query(
    "a12_fast_but_flat",
    """SELECT video_id FROM features WHERE daily_view_velocity > (SELECT avg(daily_view_velocity) FROM features) AND marginal_engagement_rate <= 0.051""",
)
def a12(t: Tables) -> DataFrame:
    # The sample has no falling counters, so the gain is measured against a small threshold.
    shifted = t.features().withColumn("gain", F.col("marginal_engagement_rate") - 0.051)
    return summaries.fast_but_flat(shifted, "daily_view_velocity", "gain").select("video_id")


@query(
    "a13_histogram",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
       c AS (SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM orders, b GROUP BY 1)
       SELECT CAST(g.i AS INTEGER) AS bin, round(lo + (hi - lo) * g.i / 50, 6) AS left_edge, round(lo + (hi - lo) * (g.i + 1) / 50, 6) AS right_edge,
              coalesce(n, 0) AS n
       FROM range(50) AS g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i""",
)
def a13(t: Tables) -> DataFrame:
    return rounded(summaries.histogram(t.table("orders"), "o_totalprice", 50), 6, "left_edge", "right_edge")


BOX_SQL = """
    WITH q AS (SELECT p_type, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
               FROM (SELECT p_type, p_retailprice * CASE WHEN p_size > 47 THEN 9 ELSE 1 END AS price FROM part) AS x GROUP BY p_type),
    f AS (SELECT x.p_type, x.price, q.*, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM (SELECT p_type, p_retailprice * CASE WHEN p_size > 47 THEN 9 ELSE 1 END AS price FROM part) AS x JOIN q ON x.p_type = q.p_type)"""


def box_input(t: Tables) -> DataFrame:
    return t.table("part").select("p_type", (F.col("p_retailprice") * F.when(F.col("p_size") > 47, 9).otherwise(1)).alias("price"))


@query(
    "a14_box_stats",
    BOX_SQL + """ SELECT p_type, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
           min(price) FILTER (WHERE price BETWEEN lo AND hi) AS whisker_low, max(price) FILTER (WHERE price BETWEEN lo AND hi) AS whisker_high,
           count(*) FILTER (WHERE NOT price BETWEEN lo AND hi) AS n_outliers FROM f GROUP BY p_type""",
)
def a14(t: Tables) -> DataFrame:
    return rounded(summaries.box_stats(box_input(t), "price", ["p_type"]), 6, "q1", "median", "q3")


@query("a14_box_outliers", BOX_SQL + " SELECT p_type, price, count(*) AS n FROM f WHERE price < lo OR price > hi GROUP BY p_type, price")
def a14b(t: Tables) -> DataFrame:
    return summaries.box_outliers(box_input(t), "price", ["p_type"])


@query(
    "a15_density",
    """WITH s AS (SELECT p_type, count(*) AS n, stddev_samp(p_size) * pow(count(*), -0.2) AS h, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY p_type),
       g AS (SELECT s.*, i, (lo - 2 * h) + ((hi + 2 * h) - (lo - 2 * h)) / 99 * i AS x FROM s, range(100) AS r(i))
       SELECT g.p_type, CAST(i AS INTEGER) AS point, round(any_value(x), 6) AS x,
              round(sum(exp(-0.5 * pow((x - p_size) / h, 2))) / (any_value(n) * any_value(h)) / sqrt(2 * pi()), 8) AS density
       FROM g JOIN part ON part.p_type = g.p_type WHERE h > 0 GROUP BY g.p_type, i
       UNION ALL SELECT p_type, 0, lo, NULL FROM s WHERE h IS NULL OR h = 0""",
)
def a15(t: Tables) -> DataFrame:
    out = summaries.density(t.table("part"), "p_size", ["p_type"])
    return out.withColumns({"x": F.round("x", 6), "density": F.round("density", 8)})


@query(
    "a19_window_ratio",
    f"""SELECT video_id, round(CAST(CAST(latest_like_count - earliest_like_count AS FLOAT)
            / nullif(CAST(latest_view_count - earliest_view_count AS FLOAT), 0) AS DOUBLE), 6) AS ratio FROM ({FIRST_LAST_SQL}) AS x""",
)
def a19(t: Tables) -> DataFrame:
    w = snapshots.first_and_last(windowed(t), "video_id", "scraped_at", COUNTERS)
    ratio = float_ratio(
        F.col("latest_like_count") - F.col("earliest_like_count"), F.col("latest_view_count") - F.col("earliest_view_count")
    )
    return w.select("video_id", F.round(ratio.cast("double"), 6).alias("ratio"))


# ---- ranks and statistics

RANK_SQL = """SELECT price, count(*) AS n, (SELECT count(*) FROM prices AS b WHERE b.price < a.price) + (count(*) + 1) / 2 AS avg_rank
              FROM prices AS a GROUP BY price"""


@query("w5_average_ranks", RANK_SQL)
def w5(t: Tables) -> DataFrame:
    return ranks.average_ranks(t.prices(), "price").select("price", "n", "avg_rank")


S1_COLUMNS = ["l_quantity", "l_extendedprice"]
JB_SQL = """SELECT '{c}' AS column_name, round(n / 6.0 * (s * s + k * k / 4), 4) AS stat,
           round(exp(-n / 12.0 * (s * s + k * k / 4)), 8) AS p_value FROM (
    SELECT count(*) AS n, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS s, avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 AS k
    FROM {t}, (SELECT avg({c}) AS m FROM {t}) AS a) AS b"""


@query("s01_jarque_bera", " UNION ALL ".join(JB_SQL.format(c=c, t="lineitem") for c in S1_COLUMNS))
def s01(t: Tables) -> DataFrame:
    out = normality.jarque_bera(t.table("lineitem"), S1_COLUMNS)
    return out.select("column_name", F.round("stat", 4).alias("stat"), F.round("p_value", 8).alias("p_value"))


MOMENTS_SQL = """
    WITH m AS (SELECT grp, avg(price) AS mean FROM prices GROUP BY grp),
    mo AS (SELECT p.grp, count(*)::DOUBLE AS n, avg(pow(price - mean, 3)) / pow(avg(pow(price - mean, 2)), 1.5) AS g1,
                  avg(pow(price - mean, 4)) / pow(avg(pow(price - mean, 2)), 2) AS b2 FROM prices AS p JOIN m ON p.grp = m.grp GROUP BY p.grp),
    sk AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
                  sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2 FROM mo),
    zs AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
                  (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x,
                  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM sk),
    za AS (SELECT *, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a FROM zs),
    zz AS (SELECT *, ((1 - 2 / (9 * a)) - sign(1 + x * sqrt(2 / (a - 4))) * cbrt((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2 FROM za)"""


CUSTOMERS_SQL = (
    MOMENTS_SQL.replace("prices", "spending")
    .replace("WITH m AS", "WITH spending AS (SELECT o_custkey AS grp, o_totalprice AS price FROM orders), m AS")
    .replace("p.grp = m.grp GROUP BY p.grp", "p.grp = m.grp GROUP BY p.grp HAVING count(*) >= 8")
)


@query(
    "s02_dagostino_small_groups",
    CUSTOMERS_SQL + """ SELECT grp AS o_custkey, CAST(n AS BIGINT) AS n, round(z1 * z1 + z2 * z2, 5) AS stat, round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p_value FROM zz
        UNION ALL SELECT o_custkey, count(*), NULL, NULL FROM orders GROUP BY o_custkey HAVING count(*) < 8""",
)
def s02b(t: Tables) -> DataFrame:
    """Customers with fewer than 8 orders keep their row."""
    out = normality.dagostino(t.table("orders"), "o_totalprice", ["o_custkey"])
    return out.select("o_custkey", "n", F.round("stat", 5).alias("stat"), F.round("p_value", 6).alias("p_value"))


@query(
    "s02_dagostino",
    MOMENTS_SQL + " SELECT grp, CAST(n AS BIGINT) AS n, round(z1 * z1 + z2 * z2, 5) AS stat, round(exp(-(z1 * z1 + z2 * z2) / 2), 8) AS p_value FROM zz",
)
def s02(t: Tables) -> DataFrame:
    out = normality.dagostino(t.prices(), "price", ["grp"])
    return out.select("grp", "n", F.round("stat", 5).alias("stat"), F.round("p_value", 8).alias("p_value"))


@query(
    "s03_lilliefors",
    f"""WITH c AS (SELECT grp, avg(price) AS m, stddev_samp(price) AS s, count(*) AS n FROM prices GROUP BY grp),
        z AS (SELECT p.grp, n, (price - m) / s AS z, row_number() OVER (PARTITION BY p.grp ORDER BY price) AS i FROM prices AS p JOIN c ON p.grp = c.grp),
        f AS (SELECT *, {normal_cdf('z')} AS phi FROM z)
        SELECT grp, any_value(n) AS n, round(max(greatest(i / n - phi, phi - (i - 1) / n)), 7) AS stat FROM f GROUP BY grp""",
)
def s03(t: Tables) -> DataFrame:
    return normality.lilliefors(t.prices(), "price", ["grp"]).select("grp", "n", F.round("stat", 7).alias("stat"))


SHAPIRO_SQL = f"""
    WITH g AS (SELECT o_custkey, o_totalprice AS x, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS i,
                      count(*) OVER (PARTITION BY o_custkey)::DOUBLE AS n FROM orders),
    q AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM g WHERE n > 2),
    m AS (SELECT *, {normal_quantile('p')} AS m FROM q),
    s AS (SELECT o_custkey AS k, sum(m * m) AS mm, max(m) FILTER (WHERE i = n) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2, avg(x) AS mean, any_value(n) AS nn
          FROM m GROUP BY o_custkey),
    a AS (SELECT *, m1 / sqrt(mm) + 0.221157 * u - 0.147981 * pow(u, 2) - 2.07119 * pow(u, 3) + 4.434685 * pow(u, 4) - 2.706056 * pow(u, 5) AS a1,
                 m2 / sqrt(mm) + 0.042981 * u - 0.293762 * pow(u, 2) - 1.752461 * pow(u, 3) + 5.682633 * pow(u, 4) - 3.582633 * pow(u, 5) AS a2
          FROM (SELECT *, 1 / sqrt(nn) AS u FROM s) AS su),
    w AS (SELECT m.o_custkey, m.n, x, mean,
                 CASE WHEN n = 3 THEN (i - 2) * sqrt(0.5) WHEN i = n THEN a1 WHEN i = 1 THEN -a1
                      WHEN n > 5 AND i = n - 1 THEN a2 WHEN n > 5 AND i = 2 THEN -a2
                      WHEN n > 5 THEN m / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
                      ELSE m / sqrt((mm - 2 * m1 * m1) / (1 - 2 * a1 * a1)) END AS weight
          FROM m JOIN a ON m.o_custkey = a.k)
    SELECT DISTINCT o_custkey, CAST(n AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS stat FROM g WHERE n < 3
    UNION ALL SELECT o_custkey, CAST(any_value(n) AS BIGINT) AS n, round(pow(sum(weight * x), 2) / sum(pow(x - mean, 2)), 6) AS stat FROM w GROUP BY o_custkey"""


@query("s04_shapiro", SHAPIRO_SQL)
def s04(t: Tables) -> DataFrame:
    out = normality.shapiro(t.table("orders"), "o_totalprice", ["o_custkey"])
    return out.select("o_custkey", "n", F.round("stat", 6).alias("stat"))


@query(
    "s05_test_by_size",
    """SELECT o_custkey, count(*) AS n, CASE WHEN count(*) > 10 THEN 'lilliefors' ELSE 'shapiro' END AS test_name
       FROM orders GROUP BY o_custkey""",
)
def s05(t: Tables) -> DataFrame:
    return normality.test_by_size(t.table("orders"), "o_totalprice", ["o_custkey"], "shapiro", "lilliefors", 10).select(
        "o_custkey", "n", "test_name"
    )


@query(
    "s05_normality_report",
    MOMENTS_SQL + """ SELECT grp, CAST(n AS BIGINT) AS n, 'dagostino' AS test_name, round(z1 * z1 + z2 * z2, 5) AS stat,
                             exp(-(z1 * z1 + z2 * z2) / 2) > 0.05 AS is_normal FROM zz""",
)
def s05b(t: Tables) -> DataFrame:
    """Every priority has more than 200 orders, so the omnibus test is chosen throughout."""
    out = normality.test_by_size(t.prices(), "price", ["grp"], "lilliefors", "dagostino", 200)
    return out.select("grp", "n", "test_name", F.round("stat", 5).alias("stat"), "is_normal")


@query(
    "s06_levene",
    """WITH md AS (SELECT grp, median(price) AS med FROM prices GROUP BY grp),
       z AS (SELECT p.grp, abs(price - med) AS z FROM prices AS p JOIN md ON p.grp = md.grp),
       g AS (SELECT grp, count(*) AS n, avg(z) AS m FROM z GROUP BY grp),
       w AS (SELECT sum(pow(z - m, 2)) AS within FROM z JOIN g ON z.grp = g.grp),
       l AS (SELECT (sum(n) - count(*))::DOUBLE AS df, (sum(n) - count(*)) * sum(n * pow(m - (SELECT avg(z) FROM z), 2)) / ((count(*) - 1) * any_value(within)) AS stat FROM g, w),
       q AS (SELECT stat, df / 2 AS b, df / (df + 4 * stat) AS t FROM l)
       SELECT round(stat, 6) AS stat, round(pow(t, b) * (1 + b - b * t), 6) AS p_value FROM q""",
)
def s06(t: Tables) -> DataFrame:
    """Five priorities, so four degrees of freedom, for which the tail has a closed form."""
    return rounded(group_tests.levene(t.prices(), "price", "grp"), 6, "stat", "p_value").select("stat", "p_value")


GROUP_RANK_SQL = """
    WITH v AS (SELECT price, count(*)::DOUBLE AS c FROM prices GROUP BY price),
    r AS (SELECT price, c, sum(c) OVER (ORDER BY price) - c + (c + 1) / 2 AS rk FROM v),
    g AS (SELECT grp, count(*)::DOUBLE AS n, sum(rk) AS rs FROM prices AS p JOIN r ON p.price = r.price GROUP BY grp),
    t AS (SELECT sum(c) AS n_all, sum(c * c * c - c) AS ties FROM v)"""


@query(
    "s07_kruskal",
    GROUP_RANK_SQL + """, h AS (SELECT (12 / (any_value(n_all) * (any_value(n_all) + 1)) * sum(rs * rs / n) - 3 * (any_value(n_all) + 1))
        / (1 - any_value(ties) / (pow(any_value(n_all), 3) - any_value(n_all))) AS stat FROM g, t)
        SELECT round(stat, 6) AS stat, round(exp(-stat / 2) * (1 + stat / 2), 6) AS p_value FROM h""",
)
def s07(t: Tables) -> DataFrame:
    """Five priorities, so four degrees of freedom, for which the tail has a closed form."""
    return rounded(group_tests.kruskal(t.prices(), "price", "grp"), 6, "stat", "p_value").select("stat", "p_value")


PAIR_SQL = f"""{GROUP_RANK_SQL},
    z AS (SELECT a.grp AS group_a, b.grp AS group_b,
                 (a.rs / a.n - b.rs / b.n) / sqrt((n_all * (n_all + 1) / 12 - ties / (12 * (n_all - 1))) * (1 / a.n + 1 / b.n)) AS z
          FROM g AS a JOIN g AS b ON a.grp < b.grp CROSS JOIN t),
    p AS (SELECT *, 2 * {normal_cdf('(-abs(z))')} AS p_value FROM z),
    o AS (SELECT *, row_number() OVER (ORDER BY p_value) AS i, count(*) OVER () AS m FROM p),
    adj AS (SELECT *, least(min(p_value * m / i) OVER (ORDER BY p_value DESC ROWS UNBOUNDED PRECEDING), 1.0) AS p_adjusted FROM o)"""


@query("s08_dunn", PAIR_SQL + " SELECT group_a, group_b, round(z, 6) AS z, round(p_value, 6) AS p_value FROM adj")
def s08(t: Tables) -> DataFrame:
    return rounded(group_tests.dunn(t.prices(), "price", "grp"), 6, "z", "p_value").drop("p_adjusted")


@query("w6_adjusted_p_values", PAIR_SQL + " SELECT group_a, group_b, round(p_adjusted, 6) AS p_adjusted FROM adj")
def w6(t: Tables) -> DataFrame:
    return rounded(group_tests.dunn(t.prices(), "price", "grp"), 6, "p_adjusted").select("group_a", "group_b", "p_adjusted")


@query("s09_same_level_pairs", PAIR_SQL + " SELECT group_a, group_b FROM adj WHERE p_adjusted >= 0.05")
def s09(t: Tables) -> DataFrame:
    return group_tests.same_level_pairs(group_tests.dunn(t.prices(), "price", "grp"))


@query(
    "s09_p_matrix",
    PAIR_SQL + """ SELECT group_a, group_b, round(p_adjusted, 6) AS p_adjusted, p_adjusted >= 0.05 AS same FROM (
        SELECT group_a, group_b, p_adjusted FROM adj UNION ALL SELECT group_b, group_a, p_adjusted FROM adj UNION ALL SELECT grp, grp, 1.0 FROM g) AS u""",
)
def s09b(t: Tables) -> DataFrame:
    return rounded(group_tests.p_matrix(group_tests.dunn(t.prices(), "price", "grp")), 6, "p_adjusted")


S10 = ["n_chars", "source_no", "label"]


def s10_input(t: Tables) -> DataFrame:
    docs = t.table("documents").select("doc_id", "n_chars", F.try_to_number(F.regexp_replace("source", "[^0-9]", ""), F.lit("999999")).cast("double").alias("source_no"))
    return docs.join(t.labelled().select("doc_id", "label"), "doc_id")


def _spearman_sql() -> str:
    base = """WITH d AS (SELECT documents.doc_id, documents.n_chars::DOUBLE AS n_chars, try_cast(regexp_replace(source, '[^0-9]', '', 'g') AS DOUBLE) AS source_no,
                     l.label::DOUBLE AS label FROM documents JOIN labelled AS l ON documents.doc_id = l.doc_id),
              c AS (SELECT * FROM d WHERE n_chars IS NOT NULL AND source_no IS NOT NULL AND label IS NOT NULL),
              r AS (SELECT """ + ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in S10
    ) + " FROM c)"
    cells = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)") + " AS rho FROM r" + (" LIMIT 1" if a == b else "")
        for a in S10 for b in S10
    ]
    return base + " " + " UNION ALL ".join(f"({c})" for c in cells)


@query("s10_spearman_matrix", _spearman_sql())
def s10(t: Tables) -> DataFrame:
    return rounded(group_tests.spearman(s10_input(t), "doc_id", S10), 6, "rho")


S10_FEATURES = ["video_age_days", "lifetime_engagement_rate", "marginal_engagement_rate", "daily_view_velocity"]


def _feature_ranks_sql() -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in S10_FEATURES)
    ranked = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in S10_FEATURES)
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS rho FROM r" for a in S10_FEATURES for b in S10_FEATURES
    )
    return f"WITH r AS (SELECT {ranked} FROM features WHERE {complete}) {cells}"


@query("s10_spearman_features", _feature_ranks_sql())
def s10b(t: Tables) -> DataFrame:
    return rounded(group_tests.spearman(t.features(), "video_id", S10_FEATURES), 6, "rho")


# ---- decay: the curves have a known rate, so the check states the truth


@query("s11_decay_fit", "SELECT DISTINCT p_type AS grp, round(0.02 * (1 + length(p_type) % 4), 3) AS rate, 1000.0::DOUBLE AS start_value, 20.0::DOUBLE AS floor_value FROM part")
def s11(t: Tables) -> DataFrame:
    fits = decay.fit_decay(t.curves(), "grp", "t", "y")
    return fits.select(
        "grp", F.round("decay_const", 3).alias("rate"), F.round("start_value", -2).alias("start_value"), F.round("floor_value", -1).alias("floor_value")
    )


def _tier_counts_sql() -> str:
    return """SELECT DISTINCT p_type AS grp, CAST(round_even(ln(2) / (0.02 * (1 + length(p_type) % 4)), 0) AS INTEGER) AS half_life_estimate,
              'Reliable' AS tier FROM part"""


def _least_squares_sql() -> str:
    """Gauss-Newton from the known truth: an independent route to the same optimum."""
    ctes = ["p0 AS (SELECT DISTINCT grp, 1000.0::DOUBLE AS v, 0.02::DOUBLE * (1 + length(grp) % 4) AS r, 20.0::DOUBLE AS f FROM curves)"]
    for i in range(4):
        ctes.append(
            f"""s{i} AS (
              SELECT grp, any_value(v) AS v, any_value(r) AS r, any_value(f) AS f, count(*) AS n, sum(m * m) AS sse, sum(e * e) AS a, sum(e * d) AS b,
                     sum(e) AS c, sum(d * d) AS g, sum(d) AS h, sum(e * m) AS x, sum(d * m) AS y, sum(m) AS z
              FROM (SELECT p.*, exp(-r * t) AS e, -v * t * exp(-r * t) AS d, k.y - (v * exp(-r * t) + f) AS m
                    FROM curves AS k JOIN p{i} AS p ON k.grp = p.grp) AS j GROUP BY grp),
            d{i} AS (SELECT *, a * (g * n - h * h) - b * (b * n - h * c) + c * (b * h - g * c) AS det FROM s{i}),
            p{i + 1} AS (
              SELECT grp, v + (x * (g * n - h * h) - b * (y * n - h * z) + c * (y * h - g * z)) / det AS v,
                     r + (a * (y * n - z * h) - x * (b * n - h * c) + c * (b * z - y * c)) / det AS r,
                     f + (a * (g * z - y * h) - b * (b * z - y * c) + x * (b * h - g * c)) / det AS f FROM d{i})"""
        )
    ctes.append("fit AS (SELECT grp, n, r, sqrt(sse / (n - 3) * (a * n - c * c) / det) AS se FROM d3)")
    return "WITH " + ", ".join(ctes)


@query("s12_rate_error", _least_squares_sql() + " SELECT grp, n, round(r, 6) AS decay_const, round(se, 7) AS rate_error FROM fit")
def s12(t: Tables) -> DataFrame:
    fits = decay.fit_decay(t.curves(), "grp", "t", "y")
    return fits.select("grp", "n", F.round("decay_const", 6).alias("decay_const"), F.round("rate_error", 7).alias("rate_error"))


@query(
    "s13_half_life_bounds",
    _least_squares_sql() + """, h AS (SELECT grp, ln(2) / r AS hl, ln(2) / (r + 1.96 * se) AS lo, ln(2) / (r - 1.96 * se) AS hi FROM fit)
      SELECT grp, round(hl, 2) AS half_life, round(lo, 2) AS lower, round(hi, 2) AS upper, round((hi - lo) / 2 / hl * 100, 3) AS margin FROM h""",
)
def s13(t: Tables) -> DataFrame:
    bounds = decay.half_life_bounds(decay.fit_decay(t.curves(), "grp", "t", "y"))
    return rounded(bounds.select("grp", "half_life", "lower", "upper", "margin"), 2, "half_life", "lower", "upper").withColumn(
        "margin", F.round("margin", 3)
    )


@query("s14_reliability_tier", _tier_counts_sql())
def s14(t: Tables) -> DataFrame:
    return decay.half_life_table(t.curves(), "grp", "t", "y").select("grp", "half_life_estimate", "tier")


@query(
    "s15_half_life_report",
    """SELECT x.grp, CAST(round_even(ln(2) / (0.02 * (1 + length(x.grp) % 4)), 0) AS INTEGER) AS half_life_estimate, p_brand
       FROM (SELECT p_type AS grp, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY p_type, p_brand) AS x
       WHERE r = 1""",
)
def s15(t: Tables) -> DataFrame:
    report = half_life_report(t.curves(), "grp", "t", "y", "p_brand")
    return dependable(report, "grp", "p_brand")


def _feature_half_lives_sql() -> str:
    """Search over the rate on the plain rows with the database's own regression; errors from the normal matrix."""
    ctes = [
        """d AS (SELECT content_pillar AS g, video_age_days::DOUBLE AS t0, daily_view_velocity AS y FROM features
                 WHERE content_pillar IS NOT NULL AND video_age_days IS NOT NULL AND daily_view_velocity IS NOT NULL),
           pts AS (SELECT g, t0 - min(t0) OVER (PARTITION BY g) AS t, y FROM d),
           r0 AS (SELECT g, ln(1e-7 / max(t)) AS lo, ln(40 / min(t) FILTER (WHERE t > 0)) AS hi FROM pts GROUP BY g HAVING max(t) > 0)"""
    ]
    for i in range(6):
        ctes.append(
            f"""x{i} AS (SELECT r.g, lr, h, exp(-exp(lr) * t) AS x, y
                         FROM (SELECT g, lo + (hi - lo) * j / 200.0 AS lr, (hi - lo) / 200 AS h FROM r{i}, range(201) AS s(j)) AS r JOIN pts ON pts.g = r.g),
            c{i} AS (SELECT g, lr, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(y) AS m, sum(x * y) / sum(x * x) AS b0 FROM x{i} GROUP BY g, lr),
            f{i} AS (SELECT g, lr, CASE WHEN b > 0 AND NOT isnan(b) THEN CASE WHEN a < 0 THEN greatest(b0, 0) ELSE b END ELSE 0 END AS v,
                            CASE WHEN b > 0 AND NOT isnan(b) THEN greatest(a, 0) ELSE greatest(m, 0) END AS f FROM c{i}),
            q{i} AS (SELECT x.g, x.lr, any_value(h) AS h, any_value(v) AS v, any_value(f) AS f, sum((y - v * x - f) ** 2) AS sse
                     FROM x{i} AS x JOIN f{i} AS k ON x.g = k.g AND x.lr = k.lr GROUP BY x.g, x.lr),
            r{i + 1} AS (SELECT g, arg_min(lr, sse) - any_value(h) AS lo, arg_min(lr, sse) + any_value(h) AS hi,
                                exp(arg_min(lr, sse)) AS r, arg_min(v, sse) AS v, min(sse) AS sse FROM q{i} GROUP BY g)"""
        )
    ctes.append(
        """s AS (SELECT p.g, any_value(r) AS r, any_value(sse) AS sse, count(*) AS n, sum(e * e) AS a, sum(e * k) AS b, sum(e) AS c, sum(k * k) AS q, sum(k) AS h
                 FROM (SELECT r6.*, exp(-r * t) AS e, -v * t * exp(-r * t) AS k FROM r6 JOIN pts ON pts.g = r6.g) AS p GROUP BY p.g),
           fit AS (SELECT g, r, 1.96 * sqrt(sse / (n - 3) * (a * n - c * c) / (a * (q * n - h * h) - b * (b * n - h * c) + c * (b * h - q * c))) AS w FROM s
                   WHERE n > 3 AND a * (q * n - h * h) - b * (b * n - h * c) + c * (b * h - q * c) > 0),
           bound AS (SELECT g, ln(2) / r AS hl, ln(2) / (r + w) AS lo, ln(2) / (r - w) AS hi FROM fit WHERE r > w),
           mode AS (SELECT content_pillar, video_format, row_number() OVER (PARTITION BY content_pillar ORDER BY count(*) DESC, video_format) AS k
                    FROM features WHERE video_format IS NOT NULL GROUP BY content_pillar, video_format)"""
    )
    return "WITH " + ", ".join(ctes) + """
        SELECT p.g AS content_pillar, video_format, CAST(round_even(hl, 0) AS INTEGER) AS half_life_estimate, round(lo, 2) AS estimate_lb,
               round(hi, 2) AS estimate_ub, round((hi - lo) / 2 / hl * 100, 2) AS rel_moe,
               CASE WHEN (hi - lo) / 2 / hl < 0.1 THEN 'Reliable' WHEN (hi - lo) / 2 / hl < 0.2 THEN 'Acceptable'
                    WHEN (hi - lo) / 2 / hl < 0.4 THEN 'Proceed with Caution' ELSE 'Unreliable' END AS tier
        FROM (SELECT DISTINCT g FROM d) AS p LEFT JOIN bound ON bound.g = p.g LEFT JOIN mode ON mode.content_pillar = p.g AND k = 1"""


@query("s15_feature_half_lives", _feature_half_lives_sql())
def s15b(t: Tables) -> DataFrame:
    """The report on the feature table; a half-life without an upper bound is not stated."""
    stated = {c: F.when(F.col("rel_moe").isNotNull(), F.col(c)) for c in ("half_life_estimate", "estimate_lb", "estimate_ub")}
    return half_life_report(t.features()).withColumns(stated).drop("decay_const")


@query(
    "u3_native_mode",
    """SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
       FROM events GROUP BY user_id, event_type) AS m WHERE r = 1""",
)
def u3(t: Tables) -> DataFrame:
    return summaries.group_mode(t.table("events"), "event_type", ["user_id"])
