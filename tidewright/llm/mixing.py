"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is laid out in a seeded random order and cut into blocks. Its target says how many whole
passes and which part of a further pass the mix takes, hence an exact quota of blocks per source. The
quotas are divided among output shards by a binary tree: a node gives its left half a multivariate
hypergeometric draw of its blocks. The shards then take disjoint runs of each source's permuted blocks
and order their documents locally.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.ranks import row_numbers
from tidewright.session import cut_lineage

WEIGHTS = (5, 2, 1)
# The mix takes this share of all words, and at most so many passes over a source.
SHARE = 1.5
PASSES = 2
# Blocks per pass over a source: a power of two, named by the leading bits of a document's place.
BLOCK_BITS = 10
SHARD_WORDS = 1 << 24
SEED = 7


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: float = PASSES
) -> DataFrame:
    """``target`` for every row of (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. A target stops at ``passes`` times the
    source's size; what is above goes to the other sources by weight until none is above. Every round
    is one aggregate over the source table, and only its sums reach the driver.
    """
    ranked = row_numbers(sources, [F.col("source").isNull(), F.col("source")], name="rank")
    weighted = cut_lineage(
        ranked.select(
            "source",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("w"),
            (F.lit(float(passes)) * F.col("source_size")).alias("most"),
        )
    )
    total = weighted.agg(F.sum("source_size")).first()[0]
    if not total:
        return weighted.select("source", "source_size", F.lit(0.0).alias("target"))
    wanted, level, full = share * total, 0.0, 0
    while True:
        # Sources at their limit for this level stay there: the level only rises.
        at_limit = F.col("most") <= F.lit(level) * F.col("w")
        stopped, open_weight, n = weighted.agg(
            F.coalesce(F.sum(F.when(at_limit, F.col("most"))), F.lit(0.0)),
            F.sum(F.when(~at_limit, F.col("w"))),
            F.coalesce(F.sum(F.when(at_limit, 1)), F.lit(0)),
        ).first()
        if open_weight is None or (level and n == full):
            break
        level, full = (wanted - stopped) / open_weight, n
    return weighted.select("source", "source_size", F.least("most", F.lit(level) * F.col("w")).alias("target"))


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(source, shard, first, last): which of a source's permuted blocks, counted from 0, a shard takes.

    ``quotas`` has (source, blocks), one row per source. A level of the tree is one grouped pass whose
    groups are its nodes; a group holds one number per source.
    """
    depth = int(math.log2(shards))
    schema = quotas.select("source", F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("blocks")).schema
    tree = quotas.select("source", F.lit(1).cast("long").alias("node"), F.col("blocks").cast("long"))

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        node, counts = int(pdf["node"].iloc[0]), pdf["blocks"].to_numpy(np.int64)
        draw = np.random.default_rng([seed, node])
        total = int(counts.sum())
        half = total // 2 + (int(draw.integers(2)) if total % 2 else 0)
        # marginals: one hypergeometric draw after the other, so any population size works
        left, rest, room = np.zeros_like(counts), total, half
        for i, n in enumerate(counts.tolist()):
            rest -= n
            left[i] = _hypergeometric(draw, n, rest, room)
            room -= int(left[i])
        parts = [(2 * node, left), (2 * node + 1, counts - left)]
        return pd.concat([pd.DataFrame({"source": pdf["source"], "node": k, "blocks": c}) for k, c in parts])

    for _ in range(depth):
        tree = tree.groupBy("node").applyInPandas(divide, schema)
    along = Window.partitionBy("source").orderBy("node")
    leaves = tree.select(
        "source", (F.col("node") - shards).alias("shard"), "blocks", F.sum("blocks").over(along).alias("last")
    )
    return leaves.where("blocks > 0").select("source", "shard", (F.col("last") - F.col("blocks")).alias("first"), "last")


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, size: int) -> int:
    """A hypergeometric draw for populations beyond numpy's limit of 10^9 too (binomial halves there)."""
    if size == 0 or good == 0:
        return 0
    if bad == 0:
        return size
    if good + bad < 10**9:
        return int(draw.hypergeometric(good, bad, size))
    share = good / (good + bad)
    spread = math.sqrt(size * share * (1 - share) * (good + bad - size) / (good + bad - 1))
    return int(min(max(round(draw.normal(size * share, spread)), size - bad, 0), good, size))


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    shards: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``key``, ``source``, ``size`` (words), ``source_size``, ``target`` (of its
    source), ``taken`` (words the mix takes, repeats counted) and ``draws``, an array with the shard,
    the pass and the place within the shard of every copy.

    Copies of a row that agree in key and text share their place and are taken together. Texts that are
    null or empty have size 0 and are drawn like others; a null source is a source of its own; an empty
    table gives an empty result. Texts are read once and never move; only sizes and places do. Other
    columns are not read. The same input gives the same mix on any partitioning.
    """
    place = F.shiftrightunsigned(F.xxhash64(F.col(key), F.col(text), F.lit(seed)), 1)
    sized = cut_lineage(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), place.alias("place")
        )
    )
    block = F.shiftright("place", 63 - BLOCK_BITS).cast("int")
    blocks = cut_lineage(
        sized.groupBy("source", block.alias("block")).agg(F.sum("size").alias("words"))
    )
    # At most 2^BLOCK_BITS rows per source from here on.
    targets = cut_lineage(
        source_targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, passes)
    )
    by_block = Window.partitionBy("source").orderBy("block")
    t = targets.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        # A source without words takes no pass.
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int").alias("full"),
    ).withColumn("part", F.col("target") - F.col("full") * F.col("source_size"))
    laid = (
        blocks.join(t, F.col("source").eqNullSafe(F.col("of")), "inner")
        .drop("of")
        .withColumn("nth", F.row_number().over(by_block) - 1)
        .withColumn("upto", F.sum("words").over(by_block))
        .withColumn("n_blocks", F.count(F.lit(1)).over(Window.partitionBy("source")))
        .withColumn(
            "share",
            F.when(F.col("upto") <= F.col("part"), "all")
            .when(F.col("upto") - F.col("words") < F.col("part"), "some")
            .otherwise("none"),
        )
    )
    laid = cut_lineage(laid)
    # Inside the one block per source that the target cuts, the nearest place to cut.
    cut_blocks = laid.where("share = 'some'").select(
        F.col("source").alias("of"), F.col("block").alias("at"), (F.col("part") - F.col("upto") + F.col("words")).alias("room")
    )
    inside = (
        sized.withColumn("block", block)
        .join(cut_blocks, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "inner")
        .groupBy("source", "place")
        .agg(F.sum("size").alias("words"), F.first("room").alias("room"))
        .withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("place")))
        .where(F.col("upto") - F.col("words") / 2 <= F.col("room"))
        .groupBy("source")
        .agg(F.max("place").alias("cut"))
        .select(F.col("source").alias("of"), "cut")
    )
    quotas = laid.groupBy("source").agg(
        (F.max("full") * F.max("n_blocks") + F.sum(F.when(F.col("share") != "none", 1).otherwise(0))).alias("blocks")
    )
    if shards is None:
        words = targets.agg(F.sum("target")).first()[0] or 0
        shards = 1 << max(0, math.ceil(math.log2(max(words / SHARD_WORDS, 1))))
    runs = split_quotas(quotas, shards, seed)
    # One row per source with the runs of its shards in order: a document finds its shard by itself.
    ranges = runs.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("first", "last", "shard"))).alias("runs"))
    plan = (
        laid.join(inside, F.col("source").eqNullSafe(F.col("of")), "left")
        .drop("of")
        .join(ranges.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
        .drop("of")
    )
    # A block's shard in every pass it may take part in.
    def shard_of(nth):
        hit = F.filter("runs", lambda r: (r["first"] <= nth) & (nth < r["last"]))
        return F.element_at(F.transform(hit, lambda r: r["shard"]), 1)

    in_pass = [
        F.when(F.col("full") > p, shard_of(F.col("nth") + p * F.col("n_blocks"))) for p in range(passes)
    ]
    # The part pass comes after the full ones; its blocks are numbered on.
    partly = F.when(F.col("share") != "none", shard_of(F.col("nth") + F.col("full") * F.col("n_blocks")))
    plan = cut_lineage(
        plan.select(
            F.col("source").alias("of"), F.col("block").alias("at"), "source_size", "target", "share", "cut",
            F.array(*in_pass).alias("whole"), partly.alias("partly"), "full",
        )
    )
    drawn_again = (F.col("share") == "all") | ((F.col("share") == "some") & (F.col("place") <= F.col("cut")))
    copy = lambda shard, p: F.when(
        shard.isNotNull(),
        F.struct(shard.alias("shard"), p.cast("int").alias("pass"), F.xxhash64("place", p.cast("int"), shard).alias("position")),
    )
    copies = [copy(F.col("whole")[p], F.lit(p)) for p in range(passes)]
    copies.append(F.when(drawn_again, copy(F.col("partly"), F.col("full"))))
    out = sized.withColumn("block", block).join(
        plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "inner"
    )
    return out.withColumn("draws", F.filter(F.array(*copies), lambda c: c.isNotNull())).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        (F.col("size") * F.size("draws")).alias("taken"), "draws",
    )
