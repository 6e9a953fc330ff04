"""Projections of the sample tables onto the shapes of the data model, in Spark and in check SQL.

All of them are row-wise or grouped into bounded batches, so their cost follows the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.catalog.sqltext import FEATURES
from tidewright.plans.features import make_features
from tidewright.session import spread

EPOCH_2024 = 1_704_067_200
TITLE_TAILS = [
    " [SKZ CODE] Ep.1", " Birthday party", " Making Film", " HOP challenge", " countdown stage", " M/V",
]
FORMAT_ORDER = ["Live/VOD", "Long-form", "Short"]
WINDOW = ("2024-01-05 00:00:00", "2024-01-26 00:00:00")


class Tables:
    """Sample tables of one directory and the shapes derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def texts(self) -> DataFrame:
        """Documents for work that is heavy per row."""
        return spread(self.table("documents"))

    def texts_and_nulls(self) -> DataFrame:
        """Every document, and for one language a second row without a text."""
        d = self.table("documents")
        return d.select("doc_id", "text").unionByName(d.where("lang = 'es'").select("doc_id", F.lit(None).cast("string").alias("text")))

    def snapshots(self) -> DataFrame:
        """Counter snapshots from events; some have no views yet, some lack a comment counter."""
        seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000) - EPOCH_2024
        whole = F.floor("value")
        return self.table("events").select(
            F.concat(F.lit("v"), F.col("user_id")).alias("video_id"),
            F.col("ts").alias("scraped_at"),
            F.when(F.col("value") < 5, F.lit(0)).otherwise(seconds + whole).cast("bigint").alias("view_count"),
            (F.floor(seconds / 20) + whole % 7).cast("bigint").alias("like_count"),
            F.when(F.col("event_type") != "error", F.floor(seconds / 200)).cast("bigint").alias("comment_count"),
        )

    def items(self) -> DataFrame:
        """Video metadata from customers."""
        tails = F.array(*[F.lit(t) for t in TITLE_TAILS])
        formats = F.array(*[F.lit(f) for f in FORMAT_ORDER])
        age = (F.col("c_custkey") * 7 % 900).cast("int")
        return self.table("customer").select(
            F.concat(F.lit("v"), F.col("c_custkey") + 3).alias("video_id"),
            (F.lit("2023-12-31 12:00:00").cast("timestamp_ntz") - F.make_dt_interval(age)).alias("published_at"),
            F.get(formats, (F.col("c_custkey") % 3).cast("int")).alias("video_format"),
            F.concat("c_name", F.get(tails, F.col("c_nationkey") % 6)).alias("title"),
            F.col("c_mktsegment").alias("description"),
            F.col("c_nationkey").cast("string").alias("category_id"),
            F.concat_ws(",", "c_mktsegment", "c_name").alias("tags"),
            F.concat(F.lit("link/"), F.col("c_custkey")).alias("video_link"),
            F.lit("2024-01-26 00:00:00").cast("timestamp_ntz").alias("scraped_at"),
        )

    def registered(self) -> DataFrame:
        """Registry that lists only the even ids."""
        formats = F.array(*[F.lit(f) for f in FORMAT_ORDER])
        return self.table("customer").select(
            F.concat(F.lit("v"), F.col("c_custkey") * 2).alias("video_id"),
            F.get(formats, (F.col("c_custkey") % 3).cast("int")).alias("video_format"),
        )

    def raw_videos(self) -> DataFrame:
        """Payload batches of 50 consecutive events, as JSON text."""
        e = F.col
        has_stats = e("event_type") != "error"
        item = F.struct(
            F.concat(F.lit("v"), e("user_id")).alias("id"),
            F.struct(
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                F.concat_ws(" ", "event_type", "event_id").alias("title"),
                e("props").alias("description"),
                (e("user_id") % 7).cast("string").alias("categoryId"),
                F.when(e("event_type") != "click", F.array(e("event_type"), F.lit("day"))).alias("tags"),
            ).alias("snippet"),
            F.when(
                has_stats,
                F.struct(
                    F.floor(e("value") * 100).cast("string").alias("viewCount"),
                    F.floor(e("value")).cast("string").alias("likeCount"),
                    F.when(e("event_type") != "signup", F.lit("3")).alias("commentCount"),
                ),
            ).alias("statistics"),
        )
        rows = self.table("events").select(
            F.floor(e("event_id") / 50).alias("batch"), "event_id", "ts", item.alias("item")
        )
        ordered = F.array_sort(F.collect_list(F.struct("event_id", "item")))
        return (
            rows.groupBy("batch")
            .agg(F.max("ts").cast("timestamp").alias("scraped_at"), ordered.alias("rows"))
            .select(
                "scraped_at", F.to_json(F.struct(F.col("rows.item").alias("items"))).alias("video_response")
            )
        )

    def raw_comments(self) -> DataFrame:
        """One payload of the comments per video and round, as JSON text. Every document is a comment with its
        text; those of one language are a second one without."""
        d = F.col
        body = F.struct(
            F.when(d("lang") != "es", d("source")).alias("authorDisplayName"),
            F.when(d("has_text"), d("text")).alias("textDisplay"),
            F.when(d("lang") != "de", d("n_chars")).alias("likeCount"),
            F.lit("2024-01-02T03:04:05Z").alias("publishedAt"),
        )
        item = F.struct(
            F.concat(F.when(d("has_text"), "c").otherwise("n"), d("doc_id")).alias("id"),
            F.struct(F.struct(body.alias("snippet")).alias("topLevelComment")).alias("snippet"),
        )
        kinds = F.when(d("lang") == "es", F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
        return (
            self.table("documents")
            .withColumn("has_text", F.explode(kinds))
            .select(
                F.concat(F.lit("v"), d("doc_id") % 150).alias("video_id"),
                F.floor(d("doc_id") / 7500).alias("round"),
                "doc_id",
                item.alias("item"),
            )
            .groupBy("video_id", "round")
            .agg(F.array_sort(F.collect_list(F.struct("doc_id", "item"))).alias("rows"))
            .select(
                "video_id",
                (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(d("round").cast("int"))).alias("scraped_at"),
                F.to_json(F.struct(F.col("rows.item").alias("items"))).alias("comment_response"),
            )
        )

    def comments(self) -> DataFrame:
        """Flat comments from documents; two documents are two states of one comment."""
        d = F.col("doc_id")
        seen = F.make_dt_interval((d % 25).cast("int"), F.lit(0), F.lit(0), (d % 86_400).cast("decimal(18,6)"))
        return self.table("documents").select(
            F.concat(F.lit("c"), F.floor(d / 2)).alias("comment_id"),
            F.concat(F.lit("v"), F.floor(d / 2) % 150).alias("video_id"),
            "text",
            "lang",
            d.alias("doc_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + seen).alias("scraped_at"),
        )

    def labelled(self) -> DataFrame:
        """Documents with a sentiment class from the quality and toxicity labels; null if unlabelled."""
        code = (
            F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
        )
        return (
            self.texts()
            .join(self.table("labels"), "doc_id", "left")
            .select(
                "doc_id",
                F.concat(F.lit("v"), F.col("doc_id") % 150).alias("video_id"),
                F.col("doc_id").alias("comment_id"),
                "text",
                F.col("lang").alias("language"),
                code.alias("label"),
            )
        )

    def predictions(self) -> DataFrame:
        """Labelled documents with a made-up prediction that is sometimes wrong or missing."""
        guess = F.when(F.col("comment_id") % 11 != 0, (F.col("label") + F.when(F.col("comment_id") % 4 == 0, 1).otherwise(0)) % 3)
        return self.labelled().where("label IS NOT NULL").withColumn("prediction", guess.cast("int"))

    def features(self) -> DataFrame:
        """The feature table over the sample window."""
        return make_features(self.snapshots(), self.items(), None, *WINDOW)

    def prices(self) -> DataFrame:
        """Order prices in thousands (heavily tied) by priority."""
        return self.table("orders").select(
            "o_orderkey", F.col("o_orderpriority").alias("grp"), F.floor(F.col("o_totalprice") / 1000).cast("double").alias("price")
        )

    def curves(self) -> DataFrame:
        """Noisy decay curves with a known rate per part type."""
        rate = 0.02 * (1 + F.length("p_type") % 4)
        t = F.col("p_partkey") % 200
        wobble = ((F.col("p_partkey") * 7919) % 13 - 6) * 0.5
        return self.table("part").select(
            F.col("p_type").alias("grp"), t.alias("t"), (1000 * F.exp(-rate * t) + 20 + wobble).alias("y"), "p_brand"
        )


def _case(column: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {column} {whens} END"


# The same shapes for DuckDB; a shape may use the ones before it.
SQL_SHAPES = {
    "snapshots": f"""
        SELECT 'v' || user_id AS video_id, ts AS scraped_at,
               CASE WHEN value < 5 THEN 0 ELSE epoch_us(ts) // 1000000 - {EPOCH_2024} + CAST(floor(value) AS BIGINT) END AS view_count,
               (epoch_us(ts) // 1000000 - {EPOCH_2024}) // 20 + CAST(floor(value) AS BIGINT) % 7 AS like_count,
               CASE WHEN event_type <> 'error' THEN (epoch_us(ts) // 1000000 - {EPOCH_2024}) // 200 END AS comment_count
        FROM events""",
    "items": f"""
        SELECT 'v' || (c_custkey + 3) AS video_id,
               TIMESTAMP '2023-12-31 12:00:00' - to_days(CAST(c_custkey * 7 % 900 AS INTEGER)) AS published_at,
               {_case('c_custkey % 3', FORMAT_ORDER)} AS video_format,
               c_name || {_case('c_nationkey % 6', TITLE_TAILS)} AS title,
               c_mktsegment AS description, CAST(c_nationkey AS VARCHAR) AS category_id,
               c_mktsegment || ',' || c_name AS tags, 'link/' || c_custkey AS video_link,
               TIMESTAMP '2024-01-26 00:00:00' AS scraped_at
        FROM customer""",
    "registered": f"""
        SELECT 'v' || (c_custkey * 2) AS video_id, {_case('c_custkey % 3', FORMAT_ORDER)} AS video_format FROM customer""",
    "payload_items": """
        SELECT event_id, 'v' || user_id AS video_id, max(ts) OVER (PARTITION BY event_id // 50) AS scraped_at,
               event_id % 50 AS position, date_trunc('second', ts) AS published_at,
               event_type || ' ' || event_id AS title, props AS description,
               CAST(user_id % 7 AS VARCHAR) AS category_id,
               CASE WHEN event_type <> 'click' THEN event_type || ',day' ELSE '' END AS tags,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value * 100) AS BIGINT) ELSE 0 END AS view_count,
               CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS like_count,
               CASE WHEN event_type NOT IN ('error', 'signup') THEN 3 ELSE 0 END AS comment_count
        FROM events""",
    "comments": """
        SELECT 'c' || (doc_id // 2) AS comment_id, 'v' || ((doc_id // 2) % 150) AS video_id, text, lang, doc_id,
               TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 25 AS INTEGER)) + to_seconds(doc_id % 86400) AS scraped_at
        FROM documents""",
    "texts_and_nulls": "SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, NULL FROM documents WHERE lang = 'es'",
    "labelled": """
        SELECT doc_id, 'v' || (doc_id % 150) AS video_id, doc_id AS comment_id, text, lang AS language,
               CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 2 END AS label
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "predictions": """
        SELECT *, CASE WHEN comment_id % 11 <> 0
                       THEN (label + CASE WHEN comment_id % 4 = 0 THEN 1 ELSE 0 END) % 3 END AS prediction
        FROM labelled WHERE label IS NOT NULL""",
    "prices": """
        SELECT o_orderkey, o_orderpriority AS grp, floor(o_totalprice / 1000) AS price FROM orders""",
    "curves": """
        SELECT p_type AS grp, p_partkey % 200 AS t, p_brand,
               1000 * exp(-0.02 * (1 + length(p_type) % 4) * (p_partkey % 200)) + 20
                 + ((p_partkey * 7919) % 13 - 6) * 0.5 AS y
        FROM part""",
    "features": FEATURES,
}
NEEDS = {"predictions": ["labelled"], "features": ["snapshots", "items"]}


def with_shapes(sql: str) -> str:
    """Prefix the SQL with the shapes it names."""
    wanted: list[str] = []

    def want(name: str) -> None:
        for below in NEEDS.get(name, []):
            want(below)
        if name not in wanted:
            wanted.append(name)

    for name in SQL_SHAPES:
        if re.search(rf"\b{name}\b", sql):
            want(name)
    if not wanted:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({SQL_SHAPES[n]})" for n in wanted)
    body = sql.strip()
    joined = re.sub(r"^WITH\s+", ",\n", body) if re.match(r"WITH\s", body) else "\n" + body
    return f"WITH {ctes}{joined}"
