"""A training corpus from raw documents: five stages, each on all that the one before kept.

    toxicity         documents that are likelier toxic than not go
    near_duplicates  one document of each SimHash group stays
    decontamination  documents that hold a benchmark passage go
    secrets          secrets are replaced in the text; every document stays
    mixing           the sources are mixed to their target weights: one row per document and copy

Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import decontam, mixing, secrets, simhash, toxicity
from tidewright.llm.common import prepare, table
from tidewright.session import fresh_path

MASK = "[secret]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, "text", docs.columns)
    return scored.where(F.col(scored.columns[-1]) <= toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs, MASK)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = mixing.mix_sources(docs)
    copy = drawn.select("doc_id", "source", "size", "source_size", "target", F.explode("draws").alias("draw"))
    return copy.select("doc_id", "source", "size", "source_size", "target", "draw.shard", "draw.pass", "draw.position")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix),
]

# Trained models and locality-sensitive hashing have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(prepare(spark), f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
