"""Centroid clustering by Lloyd's rounds over shards of the dimensions.

The vectors become whole numbers and are stored as column blocks: one row per chunk of vectors and block of
components. A round joins every block with its slice of the centroids, which gives partial squared distances;
these are added by chunk, and the least sum decides. Then every block takes the assignments of its chunk, adds up
its components per cluster, and the shard of that block renews its slice of the centroids. No task holds whole
vectors or whole centroids, and all numbers are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidewright.llm.common import byte_values, per_batch
from tidewright.session import cut_lineage

SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
# Components of one column block.
BLOCK = 16
# Below this size of the components all sums of squares are exact in double precision; larger ones are
# worked out in Python's whole numbers.
EXACT = 2**20

SLICES = "chunk long, block int, cells binary"
CENTROIDS = "block int, cells binary"


def pack(m: np.ndarray) -> bytes:
    """Whole numbers as 4 or 8 bytes each, or as text if they need more."""
    if m.dtype != object:
        peak = int(np.abs(m).max(initial=0))
        return b"4" + m.astype("<i4").tobytes() if peak < 2**31 else b"8" + m.astype("<i8").tobytes()
    return b"t" + " ".join(map(str, m.ravel().tolist())).encode()


def unpack(packed, width: int) -> np.ndarray:
    """Rows of ``width`` numbers."""
    kind = bytes(packed[:1])
    if kind == b"t":
        flat = np.array([int(v) for v in bytes(packed[1:]).split()], dtype=object)
    else:
        flat = np.frombuffer(bytes(packed[1:]), dtype="<i" + kind.decode()).astype(np.int64)
    return flat.reshape(-1, width) if width else flat


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly, for finite numbers."""
    if np.abs(x).max(initial=0.0) * scale < 2**53:
        return np.floor(x * scale).astype(np.int64)
    flat = [math.floor(v * scale) if abs(v) < 2**53 else int(v) * scale for v in x.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(x.shape)


def partial_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` to every centre, within these components."""
    peak = max((int(np.abs(m).max()) for m in (x, centres) if m.size), default=0)
    kind = np.float64 if peak < EXACT and x.shape[1] <= 1024 else object
    x, centres = x.astype(kind), centres.astype(kind)
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)[None]
    return d.astype(np.int64) if kind is np.float64 else d


def _wide(m: np.ndarray, rows: int = 1) -> np.ndarray:
    """For sums of so many rows: whole numbers of Python where 8 bytes might not do."""
    return m if m.dtype != object and int(np.abs(m).max(initial=0)) * rows < 2**62 else m.astype(object)


def column_blocks(vectors: DataFrame, key: str, vector: str, width: int, scale: int, block: int) -> DataFrame:
    """One row per chunk of vectors and block of components; the first block carries the keys. Stored, so that
    chunks stay what they are when executors are lost."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("x"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not len(batch):
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            cells = whole(flat.reshape(len(batch), width), scale)
            keys = batch.column(0).to_pylist()
            parts = [cells[:, a : a + block] for a in range(0, width, block)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()),
                    pa.array([pack(p) for p in parts], pa.binary()),
                    pa.array([keys] + [None] * (len(parts) - 1), pa.list_(batch.schema.field(0).type)),
                ],
                names=["chunk", "block", "cells", "keys"],
            )
            chunk += 1

    schema = StructType().add("chunk", "long").add("block", "integer").add("cells", "binary")
    return cut_lineage(rows.mapInArrow(split, schema.add("keys", ArrayType(rows.schema["key"].dataType))))


def assign(slices: DataFrame, centroids: DataFrame, widths: dict[int, int], k: int) -> DataFrame:
    """(chunk, cluster, distance): the nearest centroid of every vector of a chunk, of equal ones the first.

    ``centroids`` has one row per block, k x width numbers, so it is broadcast; what moves is one matrix of partial
    distances per chunk and block.
    """

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunk, block, cells, centre = batch.columns
        parts = zip(block.to_pylist(), byte_values(cells), byte_values(centre))
        far = [pack(partial_distances(unpack(x, widths[b]), unpack(c, widths[b]))) for b, x, c in parts]
        return pa.RecordBatch.from_arrays([chunk, pa.array(far, pa.binary())], names=["chunk", "partial"])

    def add(rows: pa.Table) -> pa.Table:
        total = 0
        for part in rows.column("partial").to_pylist():
            total = _wide(total + _wide(unpack(part, k)))
        nearest = np.argmin(total, axis=1)
        least = total[np.arange(len(total)), nearest]
        return pa.table(
            {"chunk": rows.column("chunk")[:1], "cluster": [pack(nearest.astype(np.int64))], "distance": [pack(least)]},
            schema=pa.schema([("chunk", pa.int64()), ("cluster", pa.binary()), ("distance", pa.binary())]),
        )

    slice_of = centroids.select("block", F.col("cells").alias("centre"))
    partial = slices.select("chunk", "block", "cells").join(F.broadcast(slice_of), "block")
    partial = partial.select("chunk", "block", "cells", "centre").mapInArrow(per_batch(measure), "chunk long, partial binary")
    return cut_lineage(partial.groupBy("chunk").applyInArrow(add, "chunk long, cluster binary, distance binary"))


def renew(slices: DataFrame, assigned: DataFrame, centroids: DataFrame, widths: dict[int, int], k: int) -> DataFrame:
    """The centroids' slices after a round: floor of the mean per component; clusters without vectors stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, cells, cluster in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), byte_values(batch.column(2))):
                x, of = unpack(cells, widths[b]), unpack(cluster, 0)
                x = _wide(x, len(x))
                # The last column counts the vectors.
                own = np.zeros((k, widths[b] + 1), dtype=x.dtype)
                np.add.at(own, of, np.column_stack([x, np.ones(len(x), dtype=x.dtype)]))
                sums[b] = _wide(sums.get(b, 0) + _wide(own))
        yield _rows(sums)

    def renewed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        old: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, cells, is_old in zip(batch.column(0).to_pylist(), byte_values(batch.column(1)), batch.column(2).to_pylist()):
                if is_old:
                    old[b] = unpack(cells, widths[b])
                else:
                    sums[b] = _wide(sums.get(b, 0) + _wide(unpack(cells, widths[b] + 1)))
        for b, total in sums.items():
            n, kept = total[:, -1:], old[b]
            mean = np.where(n > 0, total[:, :-1] // np.where(n > 0, n, 1), kept)
            sums[b] = mean if mean.dtype != object or any(abs(v) >= 2**62 for v in mean.ravel()) else mean.astype(np.int64)
        yield _rows(sums)

    parts = slices.join(assigned.select("chunk", "cluster"), "chunk").select("block", "cells", "cluster").mapInArrow(add, CENTROIDS)
    # One row per task and block, met by the shard of that block, which holds k x width numbers at a time.
    both = parts.withColumn("is_old", F.lit(False)).unionByName(centroids.withColumn("is_old", F.lit(True)))
    return cut_lineage(both.repartition(len(widths), "block").mapInArrow(renewed, CENTROIDS))


def _rows(cells: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(cells), pa.int32()), pa.array([pack(m) for m in cells.values()], pa.binary())], names=["block", "cells"]
    )


def usable(vector: str, width: int):
    """Whether a vector has ``width`` components, all finite."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == width) & F.forall(vector, finite), F.lit(False))


def cluster_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = 64, k: int = CLUSTERS, rounds: int = ROUNDS,
    scale: int = SCALE, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """One row per vector of ``width`` finite components: ``key``, ``cluster``, ``distance``, ``cluster_inertia``,
    ``inertia`` and ``centroid``, the components of its final centroid.

    Components are floor(scale * x). The k vectors with the least SHA-256 of ``<seed>:<key>`` are the first
    centroids, in that order (repeated keys by their components; a null key counts as empty text); fewer
    vectors give fewer clusters. Other vectors (null, of another length, with null or non-finite components) have no
    row; repeated keys and vectors keep their rows; ties go to the smaller cluster number; an empty table gives an
    empty result; other columns are not read. A squared distance or a sum that a long cannot hold is null.
    """
    kept = vectors.where(usable(vector, width)).select(F.col(key).alias("key"), F.col(vector).alias("x"))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.select(name.alias("name"), F.col("x").cast("array<double>").alias("x")).orderBy("name", "x").limit(k).collect()
    spark = vectors.sparkSession
    slices = column_blocks(kept, "key", "x", width, scale, block)
    widths = {b: min(block, width - a) for b, a in enumerate(range(0, width, block))}
    seeds = whole(np.array([r["x"] for r in first], dtype=np.float64).reshape(len(first), width), scale)
    cells = [(b, bytearray(pack(seeds[:, b * block : b * block + w]))) for b, w in widths.items()]
    centroids = spark.createDataFrame(cells, CENTROIDS)
    n = len(first)
    for _ in range(rounds if n else 0):
        centroids = renew(slices, assign(slices, centroids, widths, n), centroids, widths, n)
    return _labelled(slices, assign(slices, centroids, widths, n), centroids, widths, key)


def _labelled(slices: DataFrame, assigned: DataFrame, centroids: DataFrame, widths: dict[int, int], key: str) -> DataFrame:
    kind = slices.schema["keys"].dataType.elementType
    members = slices.where("block = 0").select("chunk", "keys").join(assigned, "chunk").select("keys", "cluster", "distance")

    def spell(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        for i, (of, far) in enumerate(zip(byte_values(batch.column(1)), byte_values(batch.column(2)))):
            longs = [v if v < 2**63 else None for v in unpack(far, 0).tolist()]
            columns = [batch.column(0)[i].values, pa.array(unpack(of, 0), pa.int32()), pa.array(longs, pa.int64())]
            out.append(pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "distance"]))
        return out

    def text(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        for b, cells in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
            said = [[str(v) for v in row] for row in unpack(cells, widths[b]).tolist()]
            columns = [pa.array([b] * len(said), pa.int32()), pa.array(range(len(said)), pa.int32()), pa.array(said, pa.list_(pa.string()))]
            out.append(pa.RecordBatch.from_arrays(columns, names=["block", "cluster", "cells"]))
        return out

    schema = StructType().add("key", kind).add("cluster", "integer").add("distance", "long")
    rows = cut_lineage(members.mapInArrow(per_batch(spell), schema))
    # One row per cluster, of a set number of components.
    spelled = centroids.mapInArrow(per_batch(text), "block int, cluster int, cells array<string>").groupBy("cluster").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "cells"))), lambda s: s["cells"])).alias("centroid")
    )
    complete = F.count("distance") == F.count(F.lit(1))
    total = F.when(complete, F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = rows.groupBy("cluster").agg(total.alias("own"))
    whole_sum = sums.agg(F.when(F.count("own") == F.count(F.lit(1)), F.sum("own"))).scalar()
    told = sums.join(spelled, "cluster").select(
        "cluster", F.col("own").try_cast("long").alias("cluster_inertia"), whole_sum.try_cast("long").alias("inertia"), "centroid"
    )
    return rows.join(F.broadcast(told), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
