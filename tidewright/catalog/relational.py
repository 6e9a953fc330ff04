"""Projection, filter, join, window, text, time and rate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidewright.catalog.registry import query
from tidewright.catalog.shapes import WINDOW, Tables
from tidewright.catalog.sqltext import cohort_case, pillar_case, rule_case
from tidewright.functions import rates, rules, text, times
from tidewright.operators import frames, integrity, snapshots, summaries
from tidewright.operators.ingest import missing_transcripts, with_lookup
from tidewright.operators.ranks import prefix_sum
from tidewright.operators.snapshots import in_window
from tidewright.sources.tables import sql_scan


def micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


# ---- projection, filter, sort, limit, set operations


@query(
    "p01_time_window",
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-26'""",
)
def p01(t: Tables) -> DataFrame:
    return t.table("events").where(in_window(F.col("ts"), *WINDOW)).select("event_id", "user_id", "event_type", "value")


@query("p02_select_by_type", "SELECT o_orderkey, o_custkey FROM orders")
def p02(t: Tables) -> DataFrame:
    return frames.select_types(t.table("orders"), LongType)


@query("p02_exclude_types", "SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def p02b(t: Tables) -> DataFrame:
    return frames.drop_types(t.table("orders"), TimestampNTZType, LongType)


@query(
    "p03_simultaneous_columns",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS l_extendedprice,
              round(l_extendedprice * l_tax, 4) AS tax_amount FROM lineitem""",
)
def p03(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return (
        t.table("lineitem")
        .withColumns(
            {
                "l_extendedprice": F.round(price * (1 - F.col("l_discount")), 4),
                "tax_amount": F.round(price * F.col("l_tax"), 4),
            }
        )
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "tax_amount")
    )


@query(
    "p04_predicates",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'
         AND o_totalprice > (SELECT avg(o_totalprice) FROM orders)""",
)
def p04(t: Tables) -> DataFrame:
    orders = t.table("orders")
    mean = orders.agg(F.avg("o_totalprice")).scalar()
    return orders.where(
        F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW") & (F.col("o_totalprice") > mean)
    ).select("o_orderkey", "o_totalprice")


@query(
    "p05_first_match_case",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {cohort_case("datesub('day', o_orderdate, l_shipdate)")} AS cohort
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def p05(t: Tables) -> DataFrame:
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    age = times.whole_days(F.col("l_shipdate"), F.col("o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", times.age_cohort(age).alias("cohort"))


@query("p06_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def p06(t: Tables) -> DataFrame:
    return t.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("p07_total_sort", "SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderpriority, o_orderkey")
def p07(t: Tables) -> DataFrame:
    return t.table("orders").select("o_orderpriority", "o_totalprice", "o_orderkey").orderBy(
        F.desc("o_totalprice"), F.asc("o_orderpriority"), F.asc("o_orderkey")
    )


@query("p08_union_all", "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def p08(t: Tables) -> DataFrame:
    c = t.table("customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = t.table("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return frames.concat_frames([c, s])


@query(
    "p09_distinct_rows",
    """SELECT DISTINCT doc_id, label FROM (
         SELECT doc_id, quality AS label FROM labels UNION ALL SELECT doc_id, toxic AS label FROM labels) AS u""",
)
def p09(t: Tables) -> DataFrame:
    labels = t.table("labels")
    both = frames.concat_frames(
        [labels.select("doc_id", F.col("quality").alias("label")), labels.select("doc_id", F.col("toxic").alias("label"))]
    )
    return frames.distinct_rows(both)


@query(
    "p10_in_union_of_lists",
    """SELECT doc_id, lang FROM documents
       WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING avg(n_chars) > (SELECT avg(n_chars) FROM documents)
                      UNION SELECT 'es')""",
)
def p10(t: Tables) -> DataFrame:
    docs = t.table("documents")
    mean = docs.agg(F.avg("n_chars")).scalar()
    long_ones = docs.groupBy("lang").agg(F.avg("n_chars").alias("m")).where(F.col("m") > mean).select("lang")
    fixed = frames.value_list(t.spark, ["es"], "lang")
    return frames.only_listed(docs.select("doc_id", "lang"), "lang", long_ones, fixed).select("doc_id", "lang")


@query("p11_unique_values", "SELECT DISTINCT l_shipdate_year FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS l_shipdate_year FROM lineitem) AS y")
def p11(t: Tables) -> DataFrame:
    return t.table("lineitem").select(F.year("l_shipdate").alias("l_shipdate_year")).distinct()


@query("p12_drop_rename", "SELECT p_partkey AS part, p_name AS name, p_type, p_size, p_retailprice FROM part")
def p12(t: Tables) -> DataFrame:
    return t.table("part").drop("p_brand").withColumnsRenamed({"p_partkey": "part", "p_name": "name"})


@query(
    "p13_min_max_scale",
    """WITH s AS (SELECT * FROM features WHERE video_format = 'Long-form' AND daily_view_velocity <= 90000
                    AND content_pillar IN ('SKZ CODE', 'Making Film', 'Other/Music Videos'))
       SELECT video_id, content_pillar,
              round((daily_view_velocity - (SELECT min(daily_view_velocity) FROM s))
                    / nullif((SELECT max(daily_view_velocity) FROM s) - (SELECT min(daily_view_velocity) FROM s), 0), 6) AS daily_view_velocity,
              round(lifetime_engagement_rate / 100, 8) AS lifetime_engagement_rate
       FROM s""",
)
def p13(t: Tables) -> DataFrame:
    keep = (
        (F.col("video_format") == "Long-form")
        & (F.col("daily_view_velocity") <= 90000)
        & F.col("content_pillar").isin("SKZ CODE", "Making Film", "Other/Music Videos")
    )
    out = frames.value_matrix(t.features(), "daily_view_velocity", "lifetime_engagement_rate", keep)
    return out.select(
        "video_id", "content_pillar",
        F.round("daily_view_velocity", 6).alias("daily_view_velocity"),
        F.round("lifetime_engagement_rate", 8).alias("lifetime_engagement_rate"),
    )


@query("p14_drop_nulls", "SELECT video_id, scraped_at_us, comment_count FROM (SELECT video_id, epoch_us(scraped_at) AS scraped_at_us, comment_count FROM snapshots) AS s WHERE comment_count IS NOT NULL")
def p14(t: Tables) -> DataFrame:
    return t.snapshots().dropna(subset=["comment_count"]).select(
        "video_id", micros("scraped_at").alias("scraped_at_us"), "comment_count"
    )


@query(
    "p15_casts",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price_f4, CAST(o_custkey AS INTEGER) AS cust_int,
              CAST(o_orderkey AS VARCHAR) AS key_text FROM orders""",
)
def p15(t: Tables) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("float").cast("double").alias("price_f4"),
        integrity.unsigned(F.col("o_custkey"), 2**31 - 1).alias("cust_int"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


@query(
    "p16_common_table_expression",
    """WITH recent AS (SELECT user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15')
       SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM recent GROUP BY user_id""",
)
def p16(t: Tables) -> DataFrame:
    return sql_scan(
        t.spark,
        """WITH recent AS (SELECT user_id, value FROM {events} WHERE ts >= TIMESTAMP_NTZ '2024-01-15')
           SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM recent GROUP BY user_id""",
        {"events": t.table("events")},
    )


@query(
    "p17_label_vocabulary",
    """SELECT doc_id, name, CAST(CASE name WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS INTEGER) AS code
       FROM (SELECT doc_id, CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END AS name FROM labelled) AS n""",
)
def p17(t: Tables) -> DataFrame:
    named = t.labelled().select("doc_id", text.label_name(F.col("label")).alias("name"))
    return named.withColumn("code", text.label_code(F.col("name")))


# ---- joins


@query("j1_inner", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def j1(t: Tables) -> DataFrame:
    return t.table("orders").join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice"
    )


@query("j2_left_fact_dimension", "SELECT s.video_id, s.view_count, i.title FROM snapshots AS s LEFT JOIN items AS i ON s.video_id = i.video_id")
def j2(t: Tables) -> DataFrame:
    return t.snapshots().select("video_id", "view_count").join(t.items().select("video_id", "title"), "video_id", "left")


@query(
    "j3_left_features_sentiment",
    """SELECT f.video_id, f.video_format, round(s.positive_sentiment_percentage, 6) AS positive_sentiment_percentage
       FROM features AS f LEFT JOIN (
         SELECT video_id, avg(CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END) * 100 AS positive_sentiment_percentage
         FROM labelled WHERE label IS NOT NULL GROUP BY video_id) AS s ON f.video_id = s.video_id""",
)
def j3(t: Tables) -> DataFrame:
    scored = t.labelled().where("label IS NOT NULL").withColumn("sentiment_label", text.label_name(F.col("label")))
    share = summaries.class_share(scored, "video_id", "sentiment_label", "positive", "positive_sentiment_percentage")
    return t.features().select("video_id", "video_format").join(share, "video_id", "left").withColumn(
        "positive_sentiment_percentage", F.round("positive_sentiment_percentage", 6)
    )


@query("j4_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def j4(t: Tables) -> DataFrame:
    return t.table("customer").join(t.table("events"), F.col("user_id") == F.col("c_custkey"), "left_anti").select(
        "c_custkey", "c_name"
    )


@query(
    "j5_semi_and_list",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def j5(t: Tables) -> DataFrame:
    finished = t.table("orders").where("o_orderstatus = 'F'")
    return (
        t.table("customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
        .join(finished, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
        .select("c_custkey", "c_mktsegment")
    )


@query(
    "j6_lookup_default",
    """SELECT e.event_id, e.video_id, coalesce(r.video_format, 'Unknown') AS video_format
       FROM (SELECT event_id, 'v' || user_id AS video_id FROM events) AS e LEFT JOIN registered AS r ON e.video_id = r.video_id""",
)
def j6(t: Tables) -> DataFrame:
    events = t.table("events").select("event_id", F.concat(F.lit("v"), "user_id").alias("video_id"))
    return with_lookup(events, t.registered(), "video_id", "video_format", "Unknown")


@query(
    "j7_index_joins",
    """SELECT l.doc_id, l.quality, d.lang, c.n_turns
       FROM documents AS d RIGHT JOIN labels AS l ON d.doc_id = l.doc_id
       LEFT JOIN (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id) AS c ON l.doc_id = c.conv_id""",
)
def j7(t: Tables) -> DataFrame:
    turns = t.table("conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_turns"))
    return (
        t.table("documents").select("doc_id", "lang")
        .join(t.table("labels"), "doc_id", "right")
        .join(turns, "doc_id", "left")
        .select("doc_id", "quality", "lang", "n_turns")
    )


@query(
    "j8_merge_group_attribute",
    """SELECT g.grp, g.n, m.o_orderstatus FROM (SELECT grp, count(*) AS n FROM prices GROUP BY grp) AS g
       LEFT JOIN (SELECT o_orderpriority, arg_min(o_orderstatus, (-n, o_orderstatus)) AS o_orderstatus
                  FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) AS c GROUP BY o_orderpriority) AS m
       ON g.grp = m.o_orderpriority""",
)
def j8(t: Tables) -> DataFrame:
    orders = t.table("orders").withColumnRenamed("o_orderpriority", "grp")
    sizes = t.prices().groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(summaries.group_mode(orders, "o_orderstatus", ["grp"]), "grp", "left")


# ---- windows


@query(
    "w1_both_ranks",
    """SELECT video_id, epoch_us(scraped_at) AS scraped_at,
              row_number() OVER (PARTITION BY video_id ORDER BY scraped_at) AS entry_rank,
              row_number() OVER (PARTITION BY video_id ORDER BY scraped_at DESC) AS exit_rank FROM snapshots""",
)
def w1(t: Tables) -> DataFrame:
    return snapshots.both_ranks(t.snapshots(), "video_id", "scraped_at").select(
        "video_id", micros("scraped_at"), "entry_rank", "exit_rank"
    )


@query(
    "w2_latest_row",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) AS e WHERE r = 1""",
)
def w2(t: Tables) -> DataFrame:
    return snapshots.latest_row(t.table("events"), ["user_id"], [F.desc("ts"), F.asc("event_id")]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query(
    "w3_w4_running_and_total",
    """SELECT event_type, n, CAST(sum(n) OVER (ORDER BY n DESC, event_type ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running,
              CAST(sum(n) OVER () AS BIGINT) AS total
       FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) AS c""",
)
def w3(t: Tables) -> DataFrame:
    counts = t.table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    summed = prefix_sum(counts, [F.desc("n"), "event_type"], "n")
    return summed.select("event_type", "n", (F.col("before") + F.col("n")).alias("running"), "total")


# ---- text


@query("t1_long_form_rules", f"SELECT doc_id, {rule_case('text', rules.LONG_FORM_RULES, rules.LONG_FORM_DEFAULT)} AS pillar FROM documents")
def t1(t: Tables) -> DataFrame:
    return t.texts().select("doc_id", rules.long_form_pillar(F.col("text")).alias("pillar"))


@query("t2_short_rules", f"SELECT doc_id, {rule_case('text', rules.SHORT_RULES, rules.SHORT_DEFAULT)} AS pillar FROM documents")
def t2(t: Tables) -> DataFrame:
    return t.texts().select("doc_id", rules.short_pillar(F.col("text")).alias("pillar"))


@query("t3_live_rules", f"SELECT doc_id, {rule_case('text', rules.LIVE_RULES, rules.LIVE_DEFAULT)} AS pillar FROM documents")
def t3(t: Tables) -> DataFrame:
    return t.texts().select("doc_id", rules.live_pillar(F.col("text")).alias("pillar"))


@query("t4_pillar_by_format", f"SELECT video_id, {pillar_case('video_format', 'title')} AS pillar FROM items")
def t4(t: Tables) -> DataFrame:
    return t.items().select("video_id", rules.content_pillar(F.col("video_format"), F.col("title")).alias("pillar"))


@query("t5_upper_title_category", f"SELECT video_id, {rule_case('upper(title)', rules.UPPER_RULES, rules.UPPER_DEFAULT)} AS category FROM items")
def t5(t: Tables) -> DataFrame:
    return t.items().select("video_id", rules.title_category(F.col("title")).alias("category"))


@query(
    "t6_newlines_to_spaces",
    "SELECT doc_id, replace(coalesce(text, ''), chr(10), ' ') AS flat FROM texts_and_nulls",
)
def t6(t: Tables) -> DataFrame:
    return t.texts_and_nulls().select("doc_id", text.flatten_lines(F.col("text")).alias("flat"))


@query("t7_strip_label_prefix", "SELECT doc_id, replace('__label__' || lang, '__label__', '') AS lang FROM documents")
def t7(t: Tables) -> DataFrame:
    tagged = F.concat(F.lit("__label__"), "lang")
    return t.table("documents").select("doc_id", text.strip_label_prefix(tagged).alias("lang"))


@query(
    "t8_build_strings",
    """SELECT c_custkey, concat_ws(',', c_mktsegment, c_name) AS tags, 'https://www.youtube.com/watch?v=' || c_custkey AS link,
              'UULF' || replace('UC' || c_name, 'UC', '') AS list_id FROM customer""",
)
def t8(t: Tables) -> DataFrame:
    return t.table("customer").select(
        "c_custkey",
        text.join_tags(F.array("c_mktsegment", "c_name")).alias("tags"),
        text.video_link(F.col("c_custkey").cast("string")).alias("link"),
        text.upload_list_id(F.concat(F.lit("UC"), "c_name"), "Long-form").alias("list_id"),
    )


# Full Unicode upper-casing turns a sharp s into SS; the check engine would keep one letter.
@query("t9_upper", "SELECT doc_id, upper(replace(text, 'ß', 'SS')) AS upper_text FROM documents")
def t9(t: Tables) -> DataFrame:
    return t.table("documents").select("doc_id", F.upper("text").alias("upper_text"))


@query("t10_excerpt", "SELECT doc_id, substring(text, 1, 100) AS excerpt FROM documents")
def t10(t: Tables) -> DataFrame:
    return t.table("documents").select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


# ---- time and rates

SHIP = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def shipped(t: Tables) -> DataFrame:
    return t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))


@query("d1_whole_days", f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(datesub('day', o_orderdate, l_shipdate) AS INTEGER) AS days FROM {SHIP}")
def d1(t: Tables) -> DataFrame:
    return shipped(t).select("l_orderkey", "l_linenumber", "l_partkey", times.whole_days(F.col("l_shipdate"), F.col("o_orderdate")).alias("days"))


@query("d1_event_age_days", "SELECT event_id, CAST(datesub('day', ts, TIMESTAMP '2024-01-20 10:00:00') AS INTEGER) AS days FROM events")
def d1b(t: Tables) -> DataFrame:
    point = F.lit("2024-01-20 10:00:00").cast("timestamp_ntz")
    return t.table("events").select("event_id", times.whole_days(point, F.col("ts")).alias("days"))


@query(
    "d2_fractional_days",
    "SELECT event_id, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 86400000000.0 AS days FROM events",
)
def d2(t: Tables) -> DataFrame:
    end = F.lit("2024-02-01").cast("timestamp_ntz")
    return t.table("events").select("event_id", times.fractional_days(end, F.col("ts")).alias("days"))


@query("d3_year_month", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders")
def d3(t: Tables) -> DataFrame:
    day = times.instant(F.col("o_orderdate"))
    return t.table("orders").select("o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"))


@query(
    "d4_iso_parse_cutoff",
    """SELECT event_id, epoch_us(ts) AS parsed, epoch_us(ts) - 7200000000 AS shifted,
              ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY AS kept FROM events""",
)
def d4(t: Tables) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.table("events").select(
        "event_id",
        F.unix_micros(times.instant(iso)).alias("parsed"),
        F.unix_micros(times.instant(F.concat(iso, F.lit("+02:00")))).alias("shifted"),
        times.keep_record(iso, max_days=7, as_of=F.lit("2024-01-30T00:00:00Z")).alias("kept"),
    )


@query(
    "d5_age_cohort",
    f"""SELECT cohort, ord, count(*) AS n FROM (
          SELECT {cohort_case("datesub('day', o_orderdate, l_shipdate)")} AS cohort,
                 CAST(CASE WHEN datesub('day', o_orderdate, l_shipdate) < 30 THEN 1 WHEN datesub('day', o_orderdate, l_shipdate) < 180 THEN 2
                      WHEN datesub('day', o_orderdate, l_shipdate) < 720 THEN 3 ELSE 4 END AS INTEGER) AS ord
          FROM {SHIP}) AS a GROUP BY cohort, ord""",
)
def d5(t: Tables) -> DataFrame:
    cohort = times.age_cohort(times.whole_days(F.col("l_shipdate"), F.col("o_orderdate")))
    return (
        shipped(t).select(cohort.alias("cohort"))
        .withColumn("ord", times.cohort_order(F.col("cohort")))
        .groupBy("cohort", "ord").agg(F.count(F.lit(1)).alias("n"))
    )


@query("m1_lifetime_rate", "SELECT video_id, round(lifetime_engagement_rate, 8) AS rate FROM features")
def m1(t: Tables) -> DataFrame:
    return t.features().select("video_id", F.round("lifetime_engagement_rate", 8).alias("rate"))


@query("m2_marginal_rate", "SELECT video_id, round(marginal_engagement_rate, 8) AS rate FROM features")
def m2(t: Tables) -> DataFrame:
    return t.features().select("video_id", F.round("marginal_engagement_rate", 8).alias("rate"))


@query("m3_view_velocity", "SELECT video_id, round(daily_view_velocity, 4) AS velocity FROM features")
def m3(t: Tables) -> DataFrame:
    return t.features().select("video_id", F.round("daily_view_velocity", 4).alias("velocity"))


@query(
    "m4_float_ratio",
    """SELECT video_id, epoch_us(scraped_at) AS scraped_at,
              round(CAST(CAST(like_count AS FLOAT) / nullif(CAST(view_count AS FLOAT), 0) AS DOUBLE), 6) AS ratio FROM snapshots""",
)
def m4(t: Tables) -> DataFrame:
    ratio = rates.float_ratio(F.col("like_count"), F.col("view_count"))
    return t.snapshots().select("video_id", micros("scraped_at"), F.round(ratio.cast("double"), 6).alias("ratio"))


@query("m5_half_even", "SELECT o_orderkey, round_even(CAST(o_orderkey AS DOUBLE) / 2, 0) AS half, round_even(CAST(o_custkey AS DOUBLE) / 8, 2) AS eighth FROM orders")
def m5(t: Tables) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey",
        rates.half_even(F.col("o_orderkey").cast("double") / 2).alias("half"),
        rates.half_even(F.col("o_custkey").cast("double") / 8, 2).alias("eighth"),
    )


@query(
    "m6_decay_value",
    """SELECT p_partkey, round(p_retailprice * exp(-0.05 * p_size) + 3, 6) AS v, round(ln(2) / (p_size + 1), 8) AS hl,
              round(sqrt(p_retailprice), 8) AS root FROM part""",
)
def m6(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("double")
    return t.table("part").select(
        "p_partkey",
        F.round(rates.decay_value(size, F.col("p_retailprice"), F.lit(0.05), F.lit(3.0)), 6).alias("v"),
        F.round(rates.half_life(size + 1), 8).alias("hl"),
        F.round(F.sqrt("p_retailprice"), 8).alias("root"),
    )


@query("m7_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings")
def m7(t: Tables) -> DataFrame:
    return t.table("embeddings").select("vec_id", rates.argmax(F.col("embedding")).alias("best"))


@query("u1_rules_without_python", f"SELECT pillar, count(*) AS n FROM (SELECT {pillar_case('video_format', 'title')} AS pillar FROM items) AS p GROUP BY pillar")
def u1(t: Tables) -> DataFrame:
    pillar = rules.content_pillar(F.col("video_format"), F.col("title"))
    return t.items().groupBy(pillar.alias("pillar")).agg(F.count(F.lit(1)).alias("n"))


@query("i23_literal_frame", "SELECT label, name, count(*) AS n FROM (SELECT CAST(label AS INTEGER) AS label, CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS name FROM labelled WHERE label IS NOT NULL) AS l GROUP BY ALL")
def i23(t: Tables) -> DataFrame:
    schema = StructType([StructField("label", IntegerType()), StructField("name", StringType()), StructField("weight", DoubleType())])
    names = frames.literal_frame(
        t.spark, [{"label": 0, "name": "negative"}, {"label": 1, "name": "neutral"}, {"label": 2, "name": "positive"}], schema
    )
    return t.labelled().join(names, "label").groupBy("label", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i15_missing_transcripts",
    """SELECT video_id FROM items WHERE video_format IN ('Long-form', 'Live/VOD')
         AND video_id NOT IN (SELECT 'v' || conv_id FROM conversations) ORDER BY video_id LIMIT 40""",
)
def i15(t: Tables) -> DataFrame:
    transcripts = t.table("conversations").select(F.concat(F.lit("v"), "conv_id").alias("video_id")).distinct()
    return missing_transcripts(t.items(), transcripts)
