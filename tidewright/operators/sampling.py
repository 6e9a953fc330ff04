"""Seeded, partition-independent sampling and splitting.

The draw orders rows by md5(key:seed), so it does not depend on partitioning and is repeatable in any
engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidewright.operators.frames import literal_frame
from tidewright.operators.hotkeys import attach_measured
from tidewright.operators.ranks import row_numbers
from tidewright.schemas import SAMPLE_SIZE

# Hex digits of a draw that name its slice.
SLICE_DIGITS = 3


def draw_order(key: Column, seed: Column | int) -> Column:
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat(key.cast("string"), F.lit(":"), seed.cast("string")))


def sample_size(z: float = 1.96, margin: float = 0.05, share: float = 0.5) -> int:
    """Rows needed to estimate a share; 384 for 95 % confidence and a 5 % margin."""
    return int(z * z * share * (1 - share) / (margin * margin))


def sample_rows(df: DataFrame, key: str, n: int = SAMPLE_SIZE, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all, if fewer)."""
    return df.orderBy(draw_order(F.col(key), seed), key).limit(n)


def sample_per_class(
    df: DataFrame, key: str, label: str, draws: list[tuple[object, int, int]]
) -> DataFrame:
    """Several draws at once from (class, seed, n) triples; adds the ``seed`` of the draw."""
    kind = StructType().add(label, df.schema[label].dataType).add("seed", IntegerType()).add("n_wanted", IntegerType())
    plan = literal_frame(
        df.sparkSession, [{label: c, "seed": seed, "n_wanted": n} for c, seed, n in draws], kind
    )
    joined = df.join(F.broadcast(plan), label).withColumn(
        "_draw", draw_order(F.col(key), F.col("seed"))
    )
    wanted = F.least(F.col("n_wanted"), F.col("total"))
    cuts = _cuts(joined.select(label, "seed", "n_wanted", "_draw", key), key, [label, "seed"], wanted)
    return _up_to_cut(joined, key, cuts, [label, "seed"]).where("_within").drop("_within", "_draw", "n_wanted")


def _cuts(narrow: DataFrame, key: str, by: list[str], position: Column) -> DataFrame:
    """The last drawn row of every group, one row per group.

    Draws are uniform, so counting them by their leading digits tells which small slice of a group
    holds the wanted position; only that slice (one in 4096 rows) is ranked. Wide rows never move,
    and a group may hold most of them.
    """
    narrow = narrow.withColumn("_slice", F.substring("_draw", 1, SLICE_DIGITS))
    extra = [c for c in narrow.columns if c not in (*by, "_draw", key, "_slice")]
    counts = narrow.groupBy(*by, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in extra]
    )
    # At most 16 ** SLICE_DIGITS rows per group.
    group = Window.partitionBy(*by)
    running = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        counts.withColumns({"total": F.sum("_n").over(group), "_upto": F.sum("_n").over(running)})
        .withColumn("_position", position)
        .where((F.col("_position") <= F.col("_upto")) & (F.col("_position") > F.col("_upto") - F.col("_n")))
        .select(*by, "_slice", (F.col("_position") - F.col("_upto") + F.col("_n")).alias("_rank"))
    )
    inside = attach_measured(narrow.select(*by, "_draw", key, "_slice"), chosen, [*by, "_slice"])
    ranked = row_numbers(inside, ["_draw", key], by, "_at").where(F.col("_at") == F.col("_rank"))
    return ranked.select(*by, F.struct("_draw", F.col(key).alias("_key")).alias("_cut"))


def _up_to_cut(df: DataFrame, key: str, cuts: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``_within``: the row is at or before the cut of its group."""
    drawn = F.struct(F.col("_draw"), F.col(key).alias("_key"))
    return attach_measured(df, cuts, by).withColumn("_within", drawn <= F.col("_cut")).drop("_cut")


def rebalance(
    df: DataFrame, key: str, label: str, caps: dict[object, tuple[int, int]]
) -> DataFrame:
    """Keep at most ``cap`` rows of the listed classes (cap, seed) and all rows of the others."""
    listed = F.col(label).isin(*caps) if caps else F.lit(False)
    rest = df.where(~listed | F.col(label).isNull())
    drawn = sample_per_class(
        df, key, label, [(c, seed, cap) for c, (cap, seed) in caps.items()]
    ).drop("seed")
    return rest.unionByName(drawn.select(*df.columns))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(draw_order(F.col(key), seed), key)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 0
) -> DataFrame:
    """Adds ``split``: per class the first ceil((1 - share) * n) rows of the draw are 'train'.

    A class may hold most of the rows, so the position comes from the distributed prefix sum.
    """
    percent = round((1 - test_share) * 100)
    drawn = df.withColumn("_draw", draw_order(F.col(key), seed))
    last = F.ceil(F.col("total") * percent / F.lit(100))
    cuts = _cuts(drawn.select(label, "_draw", key), key, [label], last)
    return (
        _up_to_cut(drawn, key, cuts, [label])
        .withColumn("split", F.when(F.col("_within"), F.lit("train")).otherwise(F.lit("test")))
        .drop("_draw", "_within")
    )
