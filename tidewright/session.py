"""Session defaults, the shared working folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings the results depend on or the plans are designed for. All of them can be
# changed on a running session, so `tune` also works on a session somebody else built.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the aggregation after it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "tidewright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    ours = SparkSession.getActiveSession() is None
    session = builder.getOrCreate()
    if ours and session.sparkContext.master.partition("[")[0] == "local" and not session.conf.get("spark.checkpoint.dir", None):
        # One machine: any folder is shared. The setting cannot change while a session runs, and on a cluster it has
        # to come from outside.
        session.stop()
        session = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewright-")).getOrCreate()
    return tune(session)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to a running session."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``, which is set when a session starts."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("start the session with spark.checkpoint.dir set to a folder that all executors share")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses; all paths of one application share a
    parent, so its leftovers can be dropped together."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidewright-{application}/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """For work that is heavy per row: give a scan with fewer splits than cores one task per core.

    Large inputs already have more splits than cores and are returned unchanged. Only for scans:
    counting the partitions of a plan with shuffles would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() > 2 * cores else scan.repartition(2 * cores)


def cut_lineage(df: DataFrame, **options) -> DataFrame:
    """Materialise once on shared storage, so the rows (and any partition id stored in them)
    stay fixed when executors are lost.

    A parquet table rather than an RDD checkpoint: it is compressed, read back by column, and its
    size is known to the optimizer. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "step")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
