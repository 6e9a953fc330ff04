"""Ranks, row numbers, running sums and minima, and exact quantiles without a window over the data or a group.

The scans rest on one layout: rows are laid out by range in slabs of a set size, sorted inside, and stored with what
they add up to inside their slab. The totals of the slabs, a few numbers each, then give every slab its offset. A
group that holds most of the rows is simply spread over many slabs. Quantiles need no order at all: a sketch brackets
each of them, and only the values inside the bracket are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.hotkeys import same_keys
from tidewright.session import cut_lineage

SLAB = "_slab"
# Rows of a slab; there are never fewer slabs than shuffle partitions would give.
SLAB_ROWS = 4_000_000
# The sketch that brackets a quantile errs by 1/ACCURACY of the ranks; the bracket is twice as wide on either side.
ACCURACY = 10_000
# Distinct values of a bracket that one task sorts; more are laid out in slabs.
BRACKET = 1_000_000

_SCANS = {"sum": (np.cumsum, sum), "min": (np.minimum.accumulate, min)}


def _ordering(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def running(df: DataFrame, order: Sequence[str | Column], value: str, name: str, kind: str = "sum") -> DataFrame:
    """Add ``name``: the sum (or minimum) of ``value`` over all rows up to this one, itself included.

    ``order`` should identify rows, otherwise tied rows share an arbitrary order. ``value`` is a whole number or a
    double without nulls, for sums not below zero. The input is stored first: its size sets the number of slabs, and the sampling of the
    range layout does not compute it again. The rows are shuffled once; what reaches the driver is one number a slab.
    """
    step, total = _SCANS[kind]
    spark = df.sparkSession
    stored = cut_lineage(df)
    slabs = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // SLAB_ROWS))
    keys = _ordering(order)
    whole = df.schema[value].dataType.typeName() not in ("double", "float")
    kept, given = stored.columns, F.col(value).cast("long" if whole else "double").alias("_scanned")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, so_far = TaskContext.get().partitionId(), None
        for batch in batches:
            if not len(batch):
                continue
            values = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            values = step(values if so_far is None else np.concatenate([[so_far], values]))
            values = values if so_far is None else values[1:]
            so_far = values[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(values), pa.array(np.full(len(batch), slab, dtype=np.int32))],
                names=[*kept, "_inside", SLAB],
            )

    sorted_slabs = stored.select(*kept, given).repartitionByRange(slabs, *keys).sortWithinPartitions(*keys)
    schema = stored.schema.add("_inside", "long" if whole else "double").add(SLAB, "integer")
    laid = cut_lineage(sorted_slabs.mapInArrow(scan, schema))
    best = F.max("_inside") if kind == "sum" else F.min("_inside")
    ends = sorted(laid.groupBy(SLAB).agg(best.alias("end")).collect())
    before = [None, *accumulate((r["end"] for r in ends), lambda a, b: total((a, b)))][: len(ends)]
    offsets = spark.createDataFrame([(r[SLAB], b) for r, b in zip(ends, before)], f"_at int, _before {'long' if whole else 'double'}")
    joined = laid.join(F.broadcast(offsets), F.col(SLAB) == F.col("_at"))
    together = F.coalesce("_before", F.lit(0)) + F.col("_inside") if kind == "sum" else F.least("_before", "_inside")
    return joined.select(*kept, together.alias(name))


def prefix_sum(
    df: DataFrame, order: Sequence[str | Column], weight: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``before`` (weight of the earlier rows of the group) and ``total`` (weight of the group).

    ``weight`` is a whole number. ``order`` should identify rows within a group, otherwise tied rows share an
    arbitrary order. A group's weight before its first row is what all groups before it weigh.
    """
    by = list(by)
    summed = running(df, [*by, *order], weight, "_upto").withColumn("before", F.col("_upto") - F.col(weight)).drop("_upto")
    if not by:
        return summed.withColumn("total", F.lit(_total(summed, weight)).cast("long"))
    groups = summed.groupBy(*by).agg(F.min("before").alias("_start"), F.sum(weight).alias("total"))
    groups = cut_lineage(groups.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_start", "total"))
    joined = summed.join(groups, same_keys(by))
    return joined.withColumn("before", F.col("before") - F.col("_start")).drop("_start", *[f"_by_{c}" for c in by])


def _total(df: DataFrame, weight: str) -> int:
    return df.agg(F.sum(weight)).first()[0]


def row_numbers(
    df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), name: str = "row_number"
) -> DataFrame:
    """1-based row number per group, plus ``total`` rows of the group."""
    out = prefix_sum(df.withColumn("_one", F.lit(1)), order, "_one", by)
    return out.withColumn(name, F.col("before") + 1).drop("_one", "before")


def clean_numbers(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number: drops null and NaN, as the statistics skip both."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).withColumn(value, v)


def value_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their multiplicity ``n``, ``before`` and ``total`` per group."""
    counts = clean_numbers(df, value).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return prefix_sum(counts, [value], "n", by)


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Average rank of every distinct value (ties share the mean of their positions)."""
    return value_histogram(df, value, by).withColumn(
        "avg_rank", F.col("before") + (F.col("n") + 1) / 2
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, and ``n_values``; null and NaN are skipped.

    One pass gives every group its size and, by a sketch, a bracket around each quantile; a second counts the values
    below a bracket and, one by one, those inside. Rows are not shuffled or sorted. If a bracket holds too many distinct
    values for one task, or the sketch missed, the values inside (all values) are laid out in slabs.
    """
    by, names = list(by), list(probs)
    data = clean_numbers(df, value).select(*by, F.col(value).alias("_value"))
    spots = [min(max(p + way * 2 / ACCURACY, 0.0), 1.0) for p in probs.values() for way in (-1, 1)]
    sketch = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_values"), F.percentile_approx("_value", spots, ACCURACY).alias("_spots")
    )
    bounds = cut_lineage(sketch.select(*[F.col(c).alias(f"_by_{c}") for c in by], "n_values", "_spots"))
    # Per quantile a value below its bracket counts as null, one above not at all.
    seen = F.array(*[
        F.when(F.col("_value") <= F.col("_spots")[2 * i + 1], F.struct(F.lit(i).alias("i"), F.when(F.col("_value") >= F.col("_spots")[2 * i], F.col("_value")).alias("v")))
        for i in range(len(names))
    ])
    if by:
        met = data.join(bounds, same_keys(by))
    else:
        only = bounds.select(F.struct("n_values", "_spots")).scalar()
        met = data.withColumns({"n_values": only["n_values"], "_spots": only["_spots"]})
    cells = met.select(*by, "n_values", F.explode(F.filter(seen, lambda s: s.isNotNull())).alias("_s"))
    cells = cut_lineage(cells.groupBy(*by, "n_values", F.col("_s.i").alias("_i"), F.col("_s.v").alias("_v")).agg(F.count(F.lit(1)).alias("n")))
    place = reduce(lambda made, i: F.when(F.col("_i") == i, F.lit(probs[names[i]])).otherwise(made), range(len(names)), F.lit(0.0)) * (F.col("n_values") - 1)
    low, high = F.floor(place), F.least(F.floor(place) + 1, F.col("n_values") - 1)
    group = [*by, "n_values", "_i"]
    sizes = cells.groupBy(*group).agg(
        F.count("_v").alias("kinds"), F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("n"))), F.lit(0)).alias("below"), F.sum("n").alias("upto")
    )
    check = sizes.agg(F.max("kinds").alias("kinds"), F.count_if((low < F.col("below")) | (high >= F.col("upto"))).alias("missed")).first()
    if check["missed"]:
        return _quantiles_of(value_histogram(data, "_value", by).withColumnRenamed("total", "n_values"), probs, by)
    if (check["kinds"] or 0) > BRACKET:
        laid = prefix_sum(cells, [F.col("_v").asc_nulls_first()], "n", group)
    else:
        earlier = Window.partitionBy(*group).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        laid = cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return _quantiles_of(laid.withColumnRenamed("_v", "_value"), probs, by)


def _quantiles_of(counts: DataFrame, probs: dict[str, float], by: Sequence[str]) -> DataFrame:
    """Quantiles from values with their count ``n``, the count ``before`` them and that of the group; with a column
    ``_i`` a row speaks for one quantile only."""
    columns = []
    for i, (name, p) in enumerate(probs.items()):
        mine = F.col("_i") == i if "_i" in counts.columns else F.lit(True)
        place = F.lit(p) * (F.col("n_values") - 1)
        low = F.floor(place)
        high = F.least(low + 1, F.col("n_values") - 1)

        def at(position: Column) -> Column:
            inside = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
            return F.max(F.when(mine & inside, F.col("_value")))

        columns.append((at(low) + (at(high) - at(low)) * (F.max(place) - F.max(low))).alias(name))
    return counts.groupBy(*by).agg(F.max("n_values").alias("n_values"), *columns)
