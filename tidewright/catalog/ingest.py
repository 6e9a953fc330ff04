"""Source, sink, ingest, integrity and streaming queries.

Queries that exercise files write them below the shared folder of the session first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidewright.catalog.registry import query
from tidewright.catalog.shapes import FORMAT_ORDER, Tables
from tidewright.functions.times import keep_record
from tidewright.operators import ingest, integrity
from tidewright.plans.landing import land_run
from tidewright.plans.transform import transform_comments, transform_snippets, transform_stats, transform_transcripts
from tidewright.schemas import COMMENTS, FAILED_FETCH, RAW_VIDEOS, SNIPPETS, STATS, TRANSCRIPTS
from tidewright.session import fresh_path
from tidewright.sources import files, tables
from tidewright.streaming import ingest as streams


def micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


def schema(**fields) -> StructType:
    return StructType([StructField(n, k) for n, k in fields.items()])


def stats(t: Tables) -> DataFrame:
    """Snapshots in the stored counter schema."""
    return t.snapshots().withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))


def snippets(t: Tables) -> DataFrame:
    return t.items().withColumns({c: F.col(c).cast("timestamp") for c in ("published_at", "scraped_at")})


# ---- files and tables


@query("i01_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def i01(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, f"{t.dir}/orders.parquet").where("o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query("i02_parquet_sink", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def i02(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "orders")
    files.write_parquet(t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"])
    return files.read_parquet(t.spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


EVENT_LINES = schema(video_id=StringType(), scraped_at=TimestampType(), value=DoubleType(), absent=StringType())


def event_lines(t: Tables) -> str:
    path = fresh_path(t.spark, "lines")
    rows = t.table("events").select(
        F.concat(F.lit("v"), "user_id").alias("video_id"), F.col("ts").cast("timestamp").alias("scraped_at"), "value", "props"
    )
    files.write_jsonl(rows, path)
    return path


@query(
    "i03_jsonl_keys_after_mark",
    """SELECT 'v' || user_id AS video_id, epoch_us(ts) AS scraped_at, value, CAST(NULL AS VARCHAR) AS absent
       FROM events WHERE ts > TIMESTAMP '2024-01-10 12:00:00'""",
)
def i03(t: Tables) -> DataFrame:
    out = files.read_jsonl(
        t.spark, event_lines(t), EVENT_LINES, ["video_id", "scraped_at", "value", "absent"], F.lit("2024-01-10T12:00:00Z")
    )
    return out.withColumn("scraped_at", F.unix_micros("scraped_at"))


@query("i03_jsonl_single_key", "SELECT 'v' || user_id AS video_id FROM events")
def i03b(t: Tables) -> DataFrame:
    return files.read_jsonl(t.spark, event_lines(t), EVENT_LINES, "video_id")


@query(
    "i04_jsonl_merge",
    """SELECT event_id AS id, 'old' AS kind FROM events
         WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-20' - INTERVAL 3 DAY
       UNION ALL SELECT c_custkey, 'new' FROM customer""",
)
def i04(t: Tables) -> DataFrame:
    old_path, new_path = fresh_path(t.spark, "old"), fresh_path(t.spark, "merged")
    line = F.to_json(
        F.struct(F.col("event_id").alias("id"), F.lit("old").alias("kind"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"))
    )
    # Some lines are cut short, some name a key twice, which is still valid JSON.
    repeated = F.concat(F.lit('{"kind":"first",'), F.substr(line, F.lit(2)))
    broken = F.when(F.col("event_type") == "error", F.substring(line, 1, 12))
    broken = broken.when(F.col("event_type") == "click", repeated).otherwise(line)
    t.table("events").select(broken.alias("value")).write.text(old_path)
    new = t.table("customer").select(F.col("c_custkey").alias("id"), F.lit("new").alias("kind"))
    files.merge_jsonl(t.spark, old_path, new, new_path, True, 3, F.lit("2024-01-20T00:00:00Z"))
    return files.read_jsonl(t.spark, new_path, schema(id=LongType(), kind=StringType()))


@query(
    "i05_sql_range_scan",
    """SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' AND value > 50""",
)
def i05(t: Tables) -> DataFrame:
    return tables.sql_scan(
        t.spark,
        """SELECT event_id, value FROM {events}
           WHERE ts >= CAST(:start AS TIMESTAMP_NTZ) AND ts < CAST(:stop AS TIMESTAMP_NTZ) AND value > :least""",
        {"events": t.table("events")},
        start="2024-01-10", stop="2024-01-12", least=50,
    )


@query(
    "i06_append_skip_conflicts",
    "SELECT video_id, epoch_us(scraped_at) AS scraped_at, view_count FROM snapshots",
)
def i06(t: Tables) -> DataFrame:
    path, key = fresh_path(t.spark, "stats"), ["video_id", "scraped_at"]
    first = stats(t).where("scraped_at < TIMESTAMP '2024-01-16'")
    tables.append_records(t.spark, first, path, STATS, key)
    tables.append_records(t.spark, stats(t), path, STATS, key, on_conflict="skip")
    return tables.read_table(t.spark, path, STATS).select("video_id", micros("scraped_at"), "view_count")


@query(
    "i06_append_rejects_batch",
    """SELECT count(*) FILTER (WHERE scraped_at < TIMESTAMP '2024-01-16') AS first_written, 0::BIGINT AS second_written,
              count(*) FILTER (WHERE scraped_at < TIMESTAMP '2024-01-16') AS conflicts FROM snapshots""",
)
def i06b(t: Tables) -> DataFrame:
    path, key = fresh_path(t.spark, "stats"), ["video_id", "scraped_at"]
    first = tables.append_records(t.spark, stats(t).where("scraped_at < TIMESTAMP '2024-01-16'"), path, STATS, key)
    second = tables.append_records(t.spark, stats(t), path, STATS, key)
    return t.spark.createDataFrame(
        [(first.written, second.written, second.conflicts)], "first_written long, second_written long, conflicts long"
    )


@query(
    "i07_after_high_water_mark",
    """SELECT video_id, epoch_us(scraped_at) AS scraped_at FROM snapshots
       WHERE scraped_at > (SELECT max(scraped_at) FROM snapshots WHERE scraped_at < TIMESTAMP '2024-01-20')""",
)
def i07(t: Tables) -> DataFrame:
    done = t.snapshots().where("scraped_at < TIMESTAMP_NTZ '2024-01-20'")
    return ingest.rows_after_mark(t.snapshots(), done, "scraped_at").select("video_id", micros("scraped_at"))


UPSERT_SQL = """
    WITH new_rows AS (
      SELECT p.*, coalesce(r.video_format, 'Unknown') AS video_format, 'https://www.youtube.com/watch?v=' || p.video_id AS video_link
      FROM payload_items AS p LEFT JOIN registered AS r ON p.video_id = r.video_id),
    every AS (
      SELECT video_id, published_at, video_format, title, description, category_id, tags, video_link, scraped_at, 0 AS gen, 0 AS pos FROM {old}
      UNION ALL
      SELECT video_id, published_at, video_format, title, description, category_id, tags, video_link, scraped_at, 1, position FROM new_rows),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY gen, scraped_at, pos) AS up,
             row_number() OVER (PARTITION BY video_id ORDER BY gen DESC, scraped_at DESC, pos DESC) AS down FROM every)
    SELECT f.video_id, epoch_us(f.published_at) AS published_at, f.video_format, l.title, l.description, l.category_id, l.tags,
           f.video_link, epoch_us(l.scraped_at) AS scraped_at
    FROM ranked AS f JOIN ranked AS l ON f.video_id = l.video_id AND f.up = 1 AND l.down = 1"""


def snippet_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "video_id", micros("published_at"), "video_format", "title", "description", "category_id", "tags", "video_link",
        micros("scraped_at"),
    )


@query("i08_upsert_mixed_policy", UPSERT_SQL.format(old="items"))
def i08(t: Tables) -> DataFrame:
    incoming = ingest.flatten_snippets(t.raw_videos(), t.registered())
    return snippet_columns(ingest.upsert_snippets(snippets(t), incoming))


@query(
    "i09_flatten_snippets",
    """SELECT p.video_id, epoch_us(published_at) AS published_at, coalesce(r.video_format, 'Unknown') AS video_format, title,
              description, category_id, tags, 'https://www.youtube.com/watch?v=' || p.video_id AS video_link, epoch_us(scraped_at) AS scraped_at
       FROM payload_items AS p LEFT JOIN registered AS r ON p.video_id = r.video_id""",
)
def i09(t: Tables) -> DataFrame:
    return snippet_columns(ingest.flatten_snippets(t.raw_videos(), t.registered()))


@query(
    "i10_flatten_stats",
    """SELECT video_id, epoch_us(scraped_at) AS scraped_at, view_count, like_count, CAST(comment_count AS BIGINT) AS comment_count
       FROM payload_items""",
)
def i10(t: Tables) -> DataFrame:
    return ingest.flatten_stats(t.raw_videos()).select(
        "video_id", micros("scraped_at"), "view_count", "like_count", "comment_count"
    )


COMMENTS_SQL = """
    SELECT 'v' || (doc_id % 150) AS video_id, CASE WHEN has_text THEN 'c' ELSE 'n' END || doc_id AS comment_id, CASE WHEN lang = 'es' THEN 'Unknown' ELSE source END AS author,
           CASE WHEN has_text THEN text ELSE '' END AS text,
           CAST(CASE WHEN lang = 'de' THEN 0 ELSE n_chars END AS INTEGER) AS like_count,
           epoch_us(TIMESTAMP '2024-01-02 03:04:05') AS published_at,
           epoch_us(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id // 7500 AS INTEGER))) AS scraped_at
    FROM (SELECT *, true AS has_text FROM documents UNION ALL SELECT *, false FROM documents WHERE lang = 'es') AS d"""


def comment_columns(df: DataFrame) -> DataFrame:
    return df.select("video_id", "comment_id", "author", "text", "like_count", micros("published_at"), micros("scraped_at"))


@query("i11_flatten_comments", COMMENTS_SQL)
def i11(t: Tables) -> DataFrame:
    return comment_columns(ingest.flatten_comments(t.raw_comments()))


@query(
    "i12_id_batches",
    """SELECT (rn - 1) // 50 AS batch, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY rn) AS ids
       FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) AS r GROUP BY 1""",
)
def i12(t: Tables) -> DataFrame:
    out = ingest.id_batches(t.table("customer"), "c_custkey", ["c_custkey"])
    return out.select("batch", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query(
    "i13_new_registry_rows",
    """SELECT video_id, video_format, epoch_us(TIMESTAMP '2024-02-01') AS first_scraped_at FROM (
         SELECT 'v' || user_id AS video_id, arg_max(event_type, event_id) AS video_format FROM events GROUP BY user_id) AS e
       WHERE video_id NOT IN (SELECT video_id FROM registered)""",
)
def i13(t: Tables) -> DataFrame:
    current = t.table("events").select(
        F.concat(F.lit("v"), "user_id").alias("video_id"), F.col("event_type").alias("video_format"), "event_id"
    )
    stamp = F.lit("2024-02-01").cast("timestamp")
    return ingest.new_registry_rows(current, t.registered(), stamp, "event_id").select(
        "video_id", "video_format", micros("first_scraped_at")
    )


@query(
    "i14_tag_sources",
    """SELECT c_custkey AS id, 'Long-form' AS video_format FROM customer UNION ALL SELECT s_suppkey, 'Short' FROM supplier
       UNION ALL SELECT p_partkey, 'Live/VOD' FROM part""",
)
def i14(t: Tables) -> DataFrame:
    lists = {
        "Long-form": t.table("customer").select(F.col("c_custkey").alias("id")),
        "Short": t.table("supplier").select(F.col("s_suppkey").alias("id")),
        "Live/VOD": t.table("part").select(F.col("p_partkey").alias("id")),
    }
    return ingest.tag_sources(lists, "video_format")


@query(
    "i16_joined_segments",
    "SELECT conv_id, replace(string_agg(text, ' ' ORDER BY turn), chr(10), ' ') AS transcript FROM conversations GROUP BY conv_id",
)
def i16(t: Tables) -> DataFrame:
    return ingest.joined_segments(t.table("conversations"), ["conv_id"], "turn", "text")


ATTEMPTS_SQL = "SELECT doc_id, CASE WHEN source = 'src0' THEN 'FAILED_FETCH' WHEN lang <> 'es' THEN text END AS transcript FROM documents"


def attempts(t: Tables) -> DataFrame:
    got = F.when(F.col("source") == "src0", "FAILED_FETCH").when(F.col("lang") != "es", F.col("text"))
    return t.table("documents").select("doc_id", got.alias("transcript"))


@query("i17_fetched_transcripts", f"SELECT * FROM ({ATTEMPTS_SQL}) AS a WHERE transcript IS DISTINCT FROM 'FAILED_FETCH'")
def i17(t: Tables) -> DataFrame:
    return ingest.fetched_transcripts(attempts(t))


@query(
    "i17_unavailable_count",
    f"SELECT count(*) AS n_kept, count(*) FILTER (WHERE transcript IS NULL) AS n_unavailable FROM ({ATTEMPTS_SQL}) AS a WHERE transcript IS DISTINCT FROM 'FAILED_FETCH'",
)
def i17b(t: Tables) -> DataFrame:
    return ingest.unavailable_count(attempts(t))


@query("i18_pruned", "SELECT video_id, epoch_us(scraped_at) AS scraped_at FROM snapshots WHERE scraped_at >= TIMESTAMP '2024-01-30 06:00:00' - INTERVAL 7 DAY")
def i18(t: Tables) -> DataFrame:
    return ingest.pruned(t.snapshots(), "scraped_at", F.lit("2024-01-30T06:00:00Z"), 7).select("video_id", micros("scraped_at"))


@query(
    "i18_prune_report",
    """SELECT count(*) FILTER (WHERE scraped_at >= TIMESTAMP '2024-01-23 06:00:00') AS n_kept,
              count(*) FILTER (WHERE scraped_at < TIMESTAMP '2024-01-23 06:00:00') AS n_pruned FROM snapshots""",
)
def i18b(t: Tables) -> DataFrame:
    return ingest.prune_report(t.snapshots(), "scraped_at", F.lit("2024-01-30T06:00:00Z"), 7)


@query(
    "i19_keep_rule",
    """SELECT event_id, ts > TIMESTAMP '2024-01-12' AS after_mark, ts >= TIMESTAMP '2024-01-20' - INTERVAL 3 DAY AS in_retention,
              false AS no_criterion FROM events""",
)
def i19(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.table("events").select(
        "event_id",
        keep_record(ts, after=F.lit("2024-01-12T00:00:00Z"), max_days=1).alias("after_mark"),
        keep_record(ts, max_days=3, as_of=F.lit("2024-01-20T00:00:00Z")).alias("in_retention"),
        keep_record(ts).alias("no_criterion"),
    )


@query(
    "i20_land_run_tables",
    """SELECT 'raw_comments' AS name, count(*) AS n FROM (SELECT DISTINCT doc_id % 150, doc_id // 7500 FROM documents
              WHERE TIMESTAMP '2024-01-01' + to_days(CAST(doc_id // 7500 AS INTEGER)) >= TIMESTAMP '2024-01-21') AS c
       UNION ALL SELECT 'raw_videos', count(*) FROM (SELECT max(ts) AS scraped_at FROM events GROUP BY event_id // 50) AS v
              WHERE scraped_at >= TIMESTAMP '2024-01-21'
       UNION ALL SELECT 'registry', count(*) FROM customer""",
)
def i20(t: Tables) -> DataFrame:
    batches = {
        "raw_videos": t.raw_videos(),
        "registry": t.registered().withColumn("first_scraped_at", F.lit("2024-01-01").cast("timestamp")),
        "raw_comments": t.raw_comments(),
    }
    root = land_run(t.spark, batches, "table", fresh_path(t.spark, "raw"), F.lit("2024-01-28T00:00:00Z"))
    out = None
    for name in batches:
        part = files.read_parquet(t.spark, f"{root}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "i20_land_run_jsonl",
    """SELECT count(*) AS n_lines, count(DISTINCT scraped_at) AS n_times FROM (
         SELECT max(ts) AS scraped_at FROM events GROUP BY event_id // 50
         UNION ALL (SELECT max(ts) AS scraped_at FROM events GROUP BY event_id // 50 HAVING max(ts) >= TIMESTAMP '2024-01-25')) AS v""",
)
def i20b(t: Tables) -> DataFrame:
    """Two runs with the same payloads: the second keeps three days of the first."""
    as_of = F.lit("2024-01-28T00:00:00Z")
    root = land_run(t.spark, {"raw_videos": t.raw_videos()}, "jsonl", None, as_of)
    root = land_run(t.spark, {"raw_videos": t.raw_videos()}, "jsonl", root, as_of)
    lines = files.read_jsonl(t.spark, f"{root}/raw_videos", RAW_VIDEOS)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("scraped_at").alias("n_times"))


@query("i21_csv_round_trip", "SELECT doc_id, text, lang, n_chars FROM documents")
def i21(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "csv")
    files.write_csv(t.table("documents").select("doc_id", "text", "lang", "n_chars"), path)
    return files.read_csv(t.spark, path, schema(doc_id=LongType(), text=StringType(), lang=StringType(), n_chars=LongType()))


@query("i22_json_records", "SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels")
def i22(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "json")
    files.write_jsonl(t.table("labels"), path)
    return files.read_records(t.spark, path, schema(doc_id=LongType(), quality=LongType(), toxic=LongType()))


# ---- integrity


@query("v1_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def v1(t: Tables) -> DataFrame:
    return integrity.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("v1_duplicate_single_key", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1")
def v1b(t: Tables) -> DataFrame:
    return integrity.duplicate_keys(t.table("events"), ["user_id"])


@query("v2_orphans", "SELECT video_id, epoch_us(scraped_at) AS scraped_at FROM snapshots WHERE video_id NOT IN (SELECT video_id FROM registered)")
def v2(t: Tables) -> DataFrame:
    return integrity.orphans(t.snapshots(), t.registered(), ["video_id"]).select("video_id", micros("scraped_at"))


@query(
    "v3_cascade_delete",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def v3(t: Tables) -> DataFrame:
    surviving = t.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return integrity.cascade_delete(t.table("orders"), surviving, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "v4_not_null_audit",
    "SELECT count(*) FILTER (WHERE video_id IS NULL) AS video_id, count(*) FILTER (WHERE comment_count IS NULL) AS comment_count FROM snapshots",
)
def v4(t: Tables) -> DataFrame:
    return integrity.null_violations(t.snapshots(), ["video_id", "comment_count"])


@query("v4_defaults", "SELECT video_id, epoch_us(scraped_at) AS scraped_at, coalesce(comment_count, 0) AS comment_count FROM snapshots")
def v4b(t: Tables) -> DataFrame:
    return integrity.with_defaults(t.snapshots(), {"comment_count": 0}).select("video_id", micros("scraped_at"), "comment_count")


@query(
    "v5_quarantined_labels",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
)
def v5(t: Tables) -> DataFrame:
    _, bad = integrity.quarantine(t.table("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])
    return bad.select("o_orderkey", "o_orderpriority")


@query("v5_enforced_domain", "SELECT video_id, video_format FROM items")
def v5b(t: Tables) -> DataFrame:
    return integrity.enforce_domain(t.items(), "video_format", FORMAT_ORDER).select("video_id", "video_format")


FEATURE_COLUMNS = [
    "video_id", "title", "video_format", "content_pillar", "publish_year", "publish_month", "video_age_cohort",
    "video_age_days", "lifetime_engagement_rate", "marginal_engagement_rate", "daily_view_velocity",
]


@query(
    "v6_missing_and_infinite",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, 0::BIGINT AS infinite FROM features"
        for c in FEATURE_COLUMNS
    ),
)
def v6(t: Tables) -> DataFrame:
    return integrity.missing_and_infinite(t.features())


EVENT_TYPES = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
}


@query(
    "v7_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS dtype, count({c}) AS non_null, count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM events"
        for c, k in EVENT_TYPES.items()
    ),
)
def v7(t: Tables) -> DataFrame:
    return integrity.profile(t.table("events"))


# ---- streams


def landed_videos(t: Tables) -> str:
    folder = fresh_path(t.spark, "landing-videos")
    files.write_jsonl(t.raw_videos(), folder)
    return folder


def landed_comments(t: Tables) -> str:
    folder = fresh_path(t.spark, "landing-comments")
    files.write_jsonl(t.raw_comments(), folder)
    return folder


ST_STATS_SQL = """SELECT {distinct} video_id, epoch_us(scraped_at) AS scraped_at{columns} FROM payload_items{where}"""


@query(
    "st1_stream_stats",
    ST_STATS_SQL.format(
        distinct="",
        columns=", view_count, like_count, CAST(comment_count AS BIGINT) AS comment_count",
        where=" QUALIFY row_number() OVER (PARTITION BY video_id, scraped_at ORDER BY view_count, like_count, comment_count) = 1",
    ),
)
def st1(t: Tables) -> DataFrame:
    """Drained three times: the second run finds nothing new, the third only files older than all before."""
    folder, out, marks = (fresh_path(t.spark, name) for name in ("landing-videos", "stats", "marks"))
    late = F.col("scraped_at") < F.lit("2024-01-20").cast("timestamp")
    files.write_jsonl(t.raw_videos().where(~late), f"{folder}/1")
    for _ in range(2):
        streams.stream_stats(t.spark, f"{folder}/*", out, marks).awaitTermination()
    files.write_jsonl(t.raw_videos().where(late), f"{folder}/2")
    streams.stream_stats(t.spark, f"{folder}/*", out, marks).awaitTermination()
    return streams.read_landed(t.spark, out, STATS).withColumn("scraped_at", F.unix_micros("scraped_at"))


@query(
    "st1_stream_with_repeats",
    ST_STATS_SQL.format(distinct="", columns=", view_count, like_count, CAST(comment_count AS BIGINT) AS comment_count", where=""),
)
def st1c(t: Tables) -> DataFrame:
    folder, out, marks = landed_videos(t), fresh_path(t.spark, "stats"), fresh_path(t.spark, "marks")
    for _ in range(2):
        streams.stream_stats(t.spark, folder, out, marks, distinct=False).awaitTermination()
    return streams.read_landed(t.spark, out, STATS).withColumn("scraped_at", F.unix_micros("scraped_at"))


@query(
    "st1_stream_strict_mark",
    ST_STATS_SQL.format(distinct="", columns=", view_count", where=" WHERE scraped_at > TIMESTAMP '2024-01-20'"),
)
def st1b(t: Tables) -> DataFrame:
    folder, out, marks = landed_videos(t), fresh_path(t.spark, "stats"), fresh_path(t.spark, "marks")
    mark = F.lit("2024-01-20").cast("timestamp")
    streams.stream_stats(t.spark, folder, out, marks, strict_after=mark, distinct=False).awaitTermination()
    return streams.read_landed(t.spark, out, STATS).select("video_id", F.unix_micros("scraped_at").alias("scraped_at"), "view_count")


@query(
    "st2_stream_upsert",
    UPSERT_SQL.format(old="(SELECT * FROM items WHERE false)"),
)
def st2(t: Tables) -> DataFrame:
    folder, path, marks = (fresh_path(t.spark, name) for name in ("landing-videos", "snippets", "marks"))
    raw, cuts = t.raw_videos(), ["0001-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "9999-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        # What one day after the other has brought is a batch of its own.
        here = raw.where((F.col("scraped_at") >= F.lit(low).cast("timestamp")) & (F.col("scraped_at") < F.lit(high).cast("timestamp")))
        files.write_jsonl(here, f"{folder}/{low}")
        streams.stream_snippets(t.spark, f"{folder}/*", t.registered(), path, marks).awaitTermination()
    return snippet_columns(streams.read_upserted(t.spark, path))


@query("st3_stream_distinct_snapshots", ST_STATS_SQL.format(distinct="DISTINCT", columns="", where=""))
def st3(t: Tables) -> DataFrame:
    folder, out, marks = landed_videos(t), fresh_path(t.spark, "stats"), fresh_path(t.spark, "marks")
    streams.stream_stats(t.spark, folder, out, marks, files_per_batch=2).awaitTermination()
    return streams.read_landed(t.spark, out, STATS).select("video_id", F.unix_micros("scraped_at").alias("scraped_at"))


@query(
    "st4_stage_order",
    """SELECT 'comments' AS name, count(*) + count(*) FILTER (WHERE lang = 'es') AS n FROM documents
       UNION ALL SELECT 'snippets', count(DISTINCT video_id) FROM payload_items
       UNION ALL SELECT 'stats', count(*) FROM (SELECT DISTINCT video_id, scraped_at FROM payload_items) AS d""",
)
def st4(t: Tables) -> DataFrame:
    videos, notes = landed_videos(t), landed_comments(t)
    paths = {name: fresh_path(t.spark, name) for name in ("snippets", "stats", "comments")}

    def marks() -> str:
        return fresh_path(t.spark, "marks")

    streams.run_stages(
        [
            [lambda: streams.stream_snippets(t.spark, videos, t.registered(), paths["snippets"], marks())],
            [
                lambda: streams.stream_stats(t.spark, videos, paths["stats"], marks()),
                lambda: streams.stream_comments(t.spark, notes, paths["comments"], marks()),
            ],
        ]
    )
    frames = {
        "snippets": streams.read_upserted(t.spark, paths["snippets"]),
        "stats": streams.read_landed(t.spark, paths["stats"], STATS),
        "comments": streams.read_landed(t.spark, paths["comments"], COMMENTS),
    }
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# ---- transform runs

EARLIER = "scraped_at < TIMESTAMP '2024-01-16'"


@query("x1_stats_runs", "SELECT DISTINCT video_id, epoch_us(scraped_at) AS scraped_at FROM payload_items")
def x1(t: Tables) -> DataFrame:
    """Two runs over a growing raw table; the second one is tried twice."""
    path, raw = fresh_path(t.spark, "stats"), t.raw_videos()
    transform_stats(t.spark, raw.where(EARLIER), path, 0, on_conflict="skip")
    for _ in range(2):
        transform_stats(t.spark, raw, path, 1, on_conflict="skip")
    return tables.read_table(t.spark, path, STATS).select("video_id", micros("scraped_at"))


@query("x2_comments_runs", COMMENTS_SQL)
def x2(t: Tables) -> DataFrame:
    path, raw = fresh_path(t.spark, "comments"), t.raw_comments()
    transform_comments(t.spark, raw.where(EARLIER), path)
    transform_comments(t.spark, raw, path)
    return comment_columns(tables.read_table(t.spark, path, COMMENTS))


@query("x3_snippets_runs", UPSERT_SQL.format(old="(SELECT * FROM items WHERE false)"))
def x3(t: Tables) -> DataFrame:
    path, raw = fresh_path(t.spark, "snippets"), t.raw_videos()
    transform_snippets(t.spark, raw.where(EARLIER), t.registered(), path)
    batch = transform_snippets(t.spark, raw, t.registered(), path)
    transform_snippets(t.spark, raw, t.registered(), path, batch)
    return snippet_columns(streams.read_upserted(t.spark, path))


@query(
    "x4_transcript_runs",
    """WITH c AS (SELECT 'v' || conv_id AS video_id, replace(string_agg(text, ' ' ORDER BY turn), chr(10), ' ') AS transcript FROM conversations GROUP BY conv_id),
       w AS (SELECT video_id, row_number() OVER (ORDER BY video_id) <= 40 AND right(video_id, 1) NOT IN ('0', '5') AS at_once
             FROM items WHERE video_format IN ('Long-form', 'Live/VOD'))
       SELECT w.video_id, c.transcript, CASE WHEN at_once THEN 0 ELSE 1 END::BIGINT AS batch_id FROM w LEFT JOIN c ON w.video_id = c.video_id""",
)
def x4(t: Tables) -> DataFrame:
    """A first run of forty videos, a part of which fails; a second one, tried twice, over all that still have no row."""
    path = fresh_path(t.spark, "transcripts")
    texts = ingest.joined_segments(t.table("conversations"), ["conv_id"], "turn", "text")
    texts = texts.select(F.concat(F.lit("v"), "conv_id").alias("video_id"), "transcript")

    def fetch(ids: DataFrame) -> DataFrame:
        return ids.join(texts, "video_id", "left")

    def fetch_badly(ids: DataFrame) -> DataFrame:
        failed = F.substring("video_id", -1, 1).isin("0", "5")
        return fetch(ids).withColumn("transcript", F.when(failed, F.lit(FAILED_FETCH)).otherwise(F.col("transcript")))

    transform_transcripts(t.spark, t.items(), path, fetch_badly)
    for _ in range(2):
        transform_transcripts(t.spark, t.items(), path, fetch, limit=None, batch_id=1)
    return tables.read_table(t.spark, path, StructType([*TRANSCRIPTS.fields, StructField(tables.BATCH, LongType())]))
