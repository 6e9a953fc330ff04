"""Group reports over the feature table, the audit of the data model, and titles that reach every label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.catalog.shapes import FORMAT_ORDER, Tables
from tidewright.catalog.sqltext import normal_cdf
from tidewright.functions import rules
from tidewright.plans import groups
from tidewright.plans.model import audit_model, with_model_defaults
from tidewright.session import cut_lineage

METRICS = ["lifetime_engagement_rate", "marginal_engagement_rate", "daily_view_velocity"]


def stored_features(t: Tables) -> DataFrame:
    """The reports read the feature table several times."""
    return cut_lineage(t.features())


def difference_sql(metric: str) -> str:
    """Levene and Kruskal-Wallis over the three formats; with two degrees of freedom both tails have a closed form."""
    return f"""SELECT * FROM (
        WITH f AS (SELECT video_format AS grp, {metric} AS x FROM features WHERE video_format IS NOT NULL AND {metric} IS NOT NULL),
        md AS (SELECT grp, median(x) AS med FROM f GROUP BY grp),
        z AS (SELECT f.grp, abs(x - med) AS z FROM f JOIN md ON f.grp = md.grp),
        zg AS (SELECT grp, count(*)::DOUBLE AS n, avg(z) AS m FROM z GROUP BY grp),
        w AS (SELECT sum(pow(z - m, 2)) AS within FROM z JOIN zg ON z.grp = zg.grp),
        l AS (SELECT sum(n) - count(*) AS df, (sum(n) - count(*)) * sum(n * pow(m - (SELECT avg(z) FROM z), 2))
                     / ((count(*) - 1) * any_value(within)) AS stat FROM zg, w),
        v AS (SELECT x, count(*)::DOUBLE AS c FROM f GROUP BY x),
        r AS (SELECT x, sum(c) OVER (ORDER BY x) - c + (c + 1) / 2 AS rk FROM v),
        g AS (SELECT grp, count(*)::DOUBLE AS n, sum(rk) AS rs FROM f JOIN r ON f.x = r.x GROUP BY grp),
        s AS (SELECT sum(c) AS n, sum(c * c * c - c) AS ties FROM v),
        k AS (SELECT (12 / (any_value(s.n) * (any_value(s.n) + 1)) * sum(rs * rs / g.n) - 3 * (any_value(s.n) + 1))
                     / (1 - any_value(ties) / (pow(any_value(s.n), 3) - any_value(s.n))) AS stat FROM g, s),
        b AS (SELECT 'levene' AS test_name, stat, pow(1 + 2 * stat / df, -df / 2) AS p_value FROM l
              UNION ALL SELECT 'kruskal', stat, exp(-stat / 2) FROM k)
        SELECT '{metric}' AS metric, test_name, round(stat, 6) AS stat, round(p_value, 6) AS p_value, p_value < 0.05 AS differs FROM b)"""


@query("g1_format_differences", " UNION ALL ".join(difference_sql(m) for m in METRICS))
def g1(t: Tables) -> DataFrame:
    features = stored_features(t)
    tests = [groups.difference_tests(features, m, "video_format").withColumn("metric", F.lit(m)) for m in METRICS]
    out = reduce(DataFrame.unionByName, tests)
    return out.withColumns({"stat": F.round("stat", 6), "p_value": F.round("p_value", 6)})


def pair_sql(fmt: str, metric: str = METRICS[0]) -> str:
    return f"""SELECT * FROM (
        WITH f AS (SELECT content_pillar AS grp, {metric} AS x FROM features WHERE video_format = '{fmt}' AND {metric} IS NOT NULL),
        v AS (SELECT x, count(*)::DOUBLE AS c FROM f GROUP BY x),
        r AS (SELECT x, sum(c) OVER (ORDER BY x) - c + (c + 1) / 2 AS rk FROM v),
        g AS (SELECT grp, count(*)::DOUBLE AS n, sum(rk) AS rs FROM f JOIN r ON f.x = r.x GROUP BY grp),
        s AS (SELECT sum(c) AS n_all, sum(c * c * c - c) AS ties FROM v),
        z AS (SELECT a.grp AS group_a, b.grp AS group_b,
                     (a.rs / a.n - b.rs / b.n) / sqrt((n_all * (n_all + 1) / 12 - ties / (12 * (n_all - 1))) * (1 / a.n + 1 / b.n)) AS z
              FROM g AS a JOIN g AS b ON a.grp < b.grp CROSS JOIN s),
        p AS (SELECT *, 2 * {normal_cdf('(-abs(z))')} AS p_value FROM z),
        o AS (SELECT *, row_number() OVER (ORDER BY p_value) AS i, count(*) OVER () AS m FROM p),
        a AS (SELECT *, least(min(p_value * m / i) OVER (ORDER BY p_value DESC ROWS UNBOUNDED PRECEDING), 1.0) AS p_adjusted FROM o)
        SELECT '{fmt}' AS video_format, group_a, group_b, round(z, 6) AS z, round(p_value, 6) AS p_value,
               round(p_adjusted, 6) AS p_adjusted, p_adjusted >= 0.05 AS same FROM a)"""


@query("g2_pillar_pairs", " UNION ALL ".join(pair_sql(f) for f in FORMAT_ORDER))
def g2(t: Tables) -> DataFrame:
    out = groups.per_part(groups.level_pairs, stored_features(t), METRICS[0], "content_pillar", "video_format", FORMAT_ORDER)
    return out.withColumns({c: F.round(c, 6) for c in ("z", "p_value", "p_adjusted")})


@query(
    "g3_pillar_levels",
    f"""SELECT video_format, content_pillar, count(*) AS n, round(median({METRICS[0]}), 9) AS median FROM features
        WHERE video_format IS NOT NULL AND {METRICS[0]} IS NOT NULL GROUP BY video_format, content_pillar""",
)
def g3(t: Tables) -> DataFrame:
    out = groups.per_part(groups.group_levels, stored_features(t), METRICS[0], "content_pillar", "video_format", FORMAT_ORDER)
    return out.withColumn("median", F.round("median", 9))


# ---- the data model; comments carry counters and authors in one half of the rows only, so that defaults have work

AUDIT_TABLES = """
    WITH reg AS (SELECT video_id, video_format, CASE WHEN video_format <> 'Short' THEN 1 END AS first_scraped_at FROM registered
                 UNION ALL SELECT video_id, 'Clip', 1 FROM registered WHERE video_format = 'Short'),
    snip AS (SELECT video_id, video_format, CASE WHEN category_id <> '3' THEN published_at END AS published_at, title FROM items),
    note AS (SELECT comment_id, video_id, scraped_at, CASE WHEN lang <> 'es' THEN 1 END AS like_count FROM comments)"""


def audit_tables(t: Tables) -> dict[str, DataFrame]:
    known = t.registered()
    reg = known.withColumn("first_scraped_at", F.when(F.col("video_format") != "Short", 1))
    clips = known.where("video_format = 'Short'").select("video_id", F.lit("Clip").alias("video_format"), F.lit(1).alias("first_scraped_at"))
    return {
        "registry": reg.unionByName(clips),
        "snippets": t.items().withColumn("published_at", F.when(F.col("category_id") != "3", F.col("published_at"))),
        "stats": t.snapshots(),
        "comments": t.comments().withColumn("like_count", F.when(F.col("lang") != "es", 1)),
    }


def rule_sql(table: str, rule: str, columns: str, rows: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{columns}' AS columns, count(*) AS violations FROM ({rows}) AS broken"


def absent(table: str, column: str) -> str:
    return f"SELECT 1 FROM {table} WHERE {column} IS NULL"


def repeated(table: str, columns: str) -> str:
    return f"SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1"


def unknown(table: str) -> str:
    return f"SELECT 1 FROM {table} WHERE video_id IS NOT NULL AND video_id NOT IN (SELECT video_id FROM snip)"


def off_domain(table: str) -> str:
    return f"SELECT 1 FROM {table} WHERE video_format NOT IN ('Live/VOD', 'Long-form', 'Short')"


AUDIT_SQL = [
    rule_sql("registry", "primary_key", "video_id", repeated("reg", "video_id")),
    rule_sql("registry", "not_null", "video_id", absent("reg", "video_id")),
    rule_sql("registry", "not_null", "first_scraped_at", absent("reg", "first_scraped_at")),
    rule_sql("registry", "domain", "video_format", off_domain("reg")),
    rule_sql("snippets", "primary_key", "video_id", repeated("snip", "video_id")),
    rule_sql("snippets", "not_null", "video_id", absent("snip", "video_id")),
    rule_sql("snippets", "not_null", "published_at", absent("snip", "published_at")),
    rule_sql("snippets", "not_null", "title", absent("snip", "title")),
    rule_sql("snippets", "domain", "video_format", off_domain("snip")),
    rule_sql("stats", "primary_key", "video_id,scraped_at", repeated("snapshots", "video_id, scraped_at")),
    rule_sql("stats", "foreign_key", "video_id", unknown("snapshots")),
    rule_sql("stats", "not_null", "video_id", absent("snapshots", "video_id")),
    rule_sql("stats", "not_null", "scraped_at", absent("snapshots", "scraped_at")),
    rule_sql("stats", "default", "view_count", absent("snapshots", "view_count")),
    rule_sql("stats", "default", "like_count", absent("snapshots", "like_count")),
    rule_sql("stats", "default", "comment_count", absent("snapshots", "comment_count")),
    rule_sql("comments", "primary_key", "comment_id,scraped_at", repeated("note", "comment_id, scraped_at")),
    rule_sql("comments", "foreign_key", "video_id", unknown("note")),
    rule_sql("comments", "not_null", "comment_id", absent("note", "comment_id")),
    rule_sql("comments", "not_null", "scraped_at", absent("note", "scraped_at")),
    rule_sql("comments", "default", "like_count", absent("note", "like_count")),
]


@query("v8_model_audit", AUDIT_TABLES + " " + " UNION ALL ".join(AUDIT_SQL))
def v8(t: Tables) -> DataFrame:
    return audit_model(audit_tables(t))


@query(
    "v9_model_defaults",
    """SELECT video_id, epoch_us(scraped_at) AS scraped_at, coalesce(view_count, 0) AS view_count, coalesce(like_count, 0) AS like_count,
              coalesce(comment_count, 0) AS comment_count FROM snapshots""",
)
def v9(t: Tables) -> DataFrame:
    filled = with_model_defaults("stats", t.snapshots())
    return filled.withColumn("scraped_at", F.unix_micros(F.col("scraped_at").cast("timestamp")))


# ---- titles with the label each must get, stated beside it and not taken from the rules

LONG_TITLES = [
    ("SKZ-Talker Go! 3", "SKZ-TALKER GO!"), ("슼즈토커 12", "SKZ-TALKER"), ("skz-talker 9", "SKZ-TALKER"), ("[SKZ CODE] Making Film", "SKZ CODE"),
    ("[skz code] 1", "Other/Music Videos"), ("Kid's  song", "Kids Room Series"), ("[RACHA LOG] 2", "Vlogs & Logs"), ("[SONG by] one", "SKZ-RECORD / PLAYER"),
    ("제 9구역", "The 9th"), ("[SPOT KIDS] 4", "SPOT KIDS"), ("m/v reaction", "M/V Reaction"), ("making film", "Making Film"),
    ("Lyric Visualizer", "Dance & Performance"), ("M/V", "Other/Music Videos"),
]
SHORT_TITLES = [
    ("challenge  w/ you", "Collab Challenge"), ("챌린지 w/", "Collab Challenge"), ("behind-the-scenes", "Behind Content"), ("스키즈코드", "SKZ CODE Shorts"),
    ("skz_talker_go", "SKZ-TALKER GO!"), ("dominate birthday", "Concert & Fanmeeting"), ("Cover By one", "Music Cover / Solo Release"),
    ("HappyFelixDay", "Member Birthday"), ("birthday JJAM", "Member Birthday"), ("shop", "HOP Era"), ("신선놀음", "DO IT Era"), ("skate", "ATE Era"),
    ("숨멎챌", "Lose My Breath Era"), ("lalalala", "ROCK-STAR Era"), ("s_class", "5-STAR Era"), ("Case143", "Case 143 Era"),
    ("치즈챌린지", "NOEASY Era"), ("challenge w", "General Promo / Other Shorts"),
]
LIVE_TITLES = [
    ("찬이의 작은 방", "Chan's Room"), ("리노리방", "Lee Know's Ri-Bang"), ("sunday countdown", "Celebrations & Birthdays"), ("탄신일", "Celebrations & Birthdays"),
    ("라이브  스트림", "Official Promos & Events"), ("Countdown", "Official Promos & Events"), ("찬이의", "Casual & Unit Lives"), ("talk", "Casual & Unit Lives"),
]
UPPER_TITLES = [
    ("skz code 5", "SKZ CODE"), ("Two kids Room", "2 Kids Room"), ("1 kids room", "1 Kids Room"), ("skz talker", "SKZ-TALKER"),
    ("skz-record", "SKZ-PLAYER/RECORD"), ("m/v teaser", "Teaser/Trailer"), ("new m/v", "Official M/V"), ("m/v reaction", "Other/Misc"),
    ("music video 2", "Official M/V"), ("vlog", "Vlog"), ("skz  code", "Other/Misc"),
]


def register_titles(name: str, titles: list[tuple[str, str]], rule) -> None:
    labels = " ".join("WHEN {} THEN '{}'".format(i, label.replace("'", "''")) for i, (_, label) in enumerate(titles))
    tails = [title for title, _ in titles]

    @query(name, f"SELECT c_custkey, CASE c_custkey % {len(titles)} {labels} END AS label FROM customer")
    def plan(t: Tables) -> DataFrame:
        tail = F.get(F.array(*[F.lit(x) for x in tails]), (F.col("c_custkey") % len(tails)).cast("int"))
        return t.table("customer").select("c_custkey", rule(F.concat("c_name", F.lit(" "), tail)).alias("label"))


register_titles("t1_every_label", LONG_TITLES, rules.long_form_pillar)
register_titles("t2_every_label", SHORT_TITLES, rules.short_pillar)
register_titles("t3_every_label", LIVE_TITLES, rules.live_pillar)
register_titles("t5_every_label", UPPER_TITLES, rules.title_category)
