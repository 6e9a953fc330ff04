"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewright.llm import decontam, lloyd, lm, mixing, pages, quality, repeats, runs, secrets, simhash, tokens, toxicity, vectors
from tidewright.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards")
    )


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan_versions(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return findings.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_main_text(table(spark, sf_dir, "pages"))


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.mark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ",").cast("binary"), 256)).drop("centroid")


OP11_SQL = f"""
WITH RECURSIVE kept AS (
  SELECT vec_id, embedding AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
cells AS MATERIALIZED (
  SELECT vec_id, unnest(range(64)) AS d, CAST(floor(256 * CAST(unnest(x) AS DOUBLE)) AS BIGINT) AS v FROM kept
),
first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < 40
),
rounds AS (
  SELECT 0 AS r, cluster, d, v FROM first JOIN cells USING (vec_id)
  UNION ALL
  SELECT r + 1, cluster, d, coalesce(mean, v) FROM (
    WITH now AS MATERIALIZED (SELECT * FROM rounds),
    far AS (
      SELECT c.vec_id, n.cluster, sum((c.v - n.v) * (c.v - n.v)) AS far FROM cells c JOIN now n USING (d) GROUP BY ALL
    ),
    near AS (SELECT vec_id, arg_min(cluster, far * 64 + cluster) AS cluster FROM far GROUP BY vec_id),
    sums AS (SELECT cluster, d, sum(v) AS s, count(*) AS n FROM cells JOIN near USING (vec_id) GROUP BY ALL),
    means AS (SELECT cluster, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS mean FROM sums)
    SELECT now.r, now.cluster, now.d, now.v, means.mean FROM now LEFT JOIN means ON means.cluster = now.cluster AND means.d = now.d
  ) WHERE r < {lloyd.ROUNDS}
),
last AS MATERIALIZED (SELECT cluster, d, v FROM rounds WHERE r = {lloyd.ROUNDS}),
far AS (SELECT c.vec_id, n.cluster, sum((c.v - n.v) * (c.v - n.v)) AS far FROM cells c JOIN last n USING (d) GROUP BY ALL),
near AS (SELECT vec_id, arg_min(cluster, far * 64 + cluster) AS cluster, min(far) AS distance FROM far GROUP BY vec_id),
named AS (SELECT cluster, sha256(string_agg(v, ',' ORDER BY d)) AS centroid_sha256 FROM last GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near JOIN named USING (cluster)
"""


def op12_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_period(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """One document in ten, by a hash of its id, repeats the words after some place with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    placed = chosen.withColumn("a", F.when(n > 0, F.col("g") % n))
    placed = placed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    index = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    moved = F.transform("words", lambda w, i: F.element_at("words", (index(i.cast("long")) + 1).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(moved, " ")).alias("text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_repeats, op3_toxicity, op4_tokens, op5_secrets, op6_pages, op7_vectors, op8_decontamination, op9_simhash, op10_quality, op11_clusters, op12_scores, op13_runs)
} | {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {"op11_clusters": OP11_SQL} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
