"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint pair that differs in at most r of 64 bits collides in at least one of 2^(r+1) - 1 tables:
every bit position gets a random vector of r + 1 bits, and table v keeps the positions whose vector is
not orthogonal to v (over GF(2)). The vectors of the differing positions span at most r dimensions, so some
v is orthogonal to all of them, and that table keeps none of the differing positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import byte_values, fresh, per_batch, text_bytes
from tidewright.llm.graph import components
from tidewright.session import cut_lineage

RADIUS = 2
SHINGLE = 3
HASH_SEED = 42
MASK_SEED = 20240917
# Fingerprints of one bucket that are compared directly; larger buckets are dealt out again by masks
# of their remaining bits.
BUCKET = 2000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text (0 for a text without words)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], HASH_SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    octets = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(octets), 1 << 16):
        ones += np.unpackbits(octets[start : start + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(
    docs: DataFrame, text: str, keep: list[str], shingle: int = SHINGLE, name: str = "fingerprint"
) -> DataFrame:
    """The columns ``keep`` plus the fingerprint as a signed long (null texts count as empty)."""
    if name in keep:
        raise ValueError(f"the documents already have a column {name}")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(bytes(v), shingle) for v in byte_values(batch.column(batch.num_columns - 1))]
        prints = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], prints], names=[*batch.schema.names[:-1], name])

    rows = docs.select(*keep)
    given = docs.select(*keep, text_bytes(text).alias(fresh(rows, "_raw")))
    return given.mapInArrow(per_batch(work), rows.schema.add(name, "long"))


def covering_masks(positions: np.ndarray, radius: int = RADIUS, seed: int = MASK_SEED) -> np.ndarray:
    """The 2^(radius + 1) - 1 masks over the given bit positions, as unsigned 64-bit words."""
    vectors = np.random.default_rng(seed).integers(1, 2 ** (radius + 1), size=64)
    parity = np.array([bin(i).count("1") & 1 for i in range(2 ** (radius + 1))])
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        kept = [int(p) for p in positions if parity[vectors[p] & v] == 1]
        masks.append(sum(1 << p for p in kept))
    return np.array(masks, dtype=np.uint64)


def _dealt(prints: DataFrame, masks: list[int], key: str | None = None) -> DataFrame:
    """One row per fingerprint and table: the table, the kept bits and the fingerprint."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.explode(
        F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k")) for i, m in enumerate(signed)])
    )
    own = [key] if key else []
    return prints.select("fp", *own, tables.alias("d")).select(*own, "d.t", "d.k", "fp")


def _local_links(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A forest of links that joins what is within the radius inside one bucket, not all pairs."""
    root = np.arange(len(fps))
    a, b = [], []
    for start in range(0, len(fps), 256):
        near = np.bitwise_count(fps[start : start + 256, None] ^ fps[None, :]) <= radius
        left, right = np.nonzero(near)
        left += start
        later = right > left
        for i, j in zip(left[later].tolist(), right[later].tolist()):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            while root[j] != j:
                root[j] = root[root[j]]
                j = root[j]
            if i != j:
                root[max(i, j)] = min(i, j)
                a.append(i)
                b.append(j)
    return a, b


def _bucket_links(radius: int):
    """For ``mapInArrow`` over whole, sorted buckets: links of each bucket with two or more members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.any(rows[1:, :-1] != rows[:-1, :-1], axis=1)) + 1
            bounds = np.concatenate(([0], edges, [len(rows)]))
            sizes = np.diff(bounds)
            fps = rows[:, -1].view(np.uint64)
            a, b = [], []
            for s, n in zip(bounds[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                i, j = _local_links(np.ascontiguousarray(fps[s : s + n]), radius)
                a.extend(fps[s + x] for x in i)
                b.extend(fps[s + x] for x in j)
            pair = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
            return pa.RecordBatch.from_arrays(pair, names=["a", "b"])

        for batch in batches:
            rows = np.column_stack([np.asarray(c, dtype=np.int64) for c in batch.columns])
            if not len(rows):
                continue
            held.append(rows)
            rows = np.concatenate(held)
            # The last bucket may go on in the next batch.
            whole = np.flatnonzero(np.any(rows[:, :-1] != rows[-1, :-1], axis=1))
            cut = int(whole[-1]) + 1 if len(whole) else 0
            held = [rows[cut:]]
            if cut:
                yield links(rows[:cut])
        if held and len(held[0]):
            yield links(held[0])

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, no repeats) that connect exactly what
    is connected by differences of at most ``radius`` bits.

    A bucket of more than ``bucket`` fingerprints is dealt out again by covering masks of the bits its
    table leaves free, so pairs inside it still meet, and no task compares one large bucket.
    """
    masks = [int(m) for m in covering_masks(np.arange(64), radius)]
    dealt = _dealt(prints.select("fp"), masks)
    sizes = cut_lineage(dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = dealt.join(sizes, ["t", "k"])

    def linked(rows: DataFrame, by: list[str]) -> DataFrame:
        packed = rows.select(*by, "fp").repartition(*by).sortWithinPartitions(*by, "fp")
        return packed.mapInArrow(_bucket_links(radius), "a long, b long")

    out = linked(members.where(F.col("n") <= bucket), ["t", "k"])
    if not sizes.where(F.col("n") > bucket).isEmpty():
        large = members.where(F.col("n") > bucket)
        for t, m in enumerate(masks):
            free = np.array([p for p in range(64) if not m >> p & 1])
            inner = [int(x) | m for x in covering_masks(free, radius, MASK_SEED + 1)]
            again = _dealt(large.where(F.col("t") == t).select("fp"), inner)
            out = out.unionByName(linked(again, ["t", "k"]))
    return out


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 lowercase hex digits), ``component_id``.

    Documents are linked when their fingerprints differ in at most ``radius`` bits; ``component_id`` is
    the smallest key reachable. Copies meet once, as one fingerprint. Null and empty texts share the
    fingerprint zero and link like any other; a null key never becomes a component id unless all keys
    of its component are null; repeated rows stay repeated. An empty table gives an empty result.
    Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    prints = cut_lineage(with_fingerprint(rows, "text", ["key"], shingle, "fp"))
    least = cut_lineage(prints.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(near_links(least, radius))
    named = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = cut_lineage(named.join(of_root, "root").select("fp", "component_id"))
    return prints.join(of_print, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """One document of each group of near-duplicates, with all columns: the one with the smallest key
    (of several rows with that key and fingerprint, any one; a null key only where the group has no other).

    Each text moves once, to the others with its key; the hot fingerprint is one row by then.
    """
    mark = fresh(docs, "_print")
    marked = with_fingerprint(docs, text, docs.columns, shingle, mark)
    prints = cut_lineage(marked.select(F.col(key).alias("key"), F.col(mark).alias("fp")))
    least = cut_lineage(prints.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(near_links(least, radius))
    named = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # Of the prints in a group, the one that holds the smallest key (the smaller print on a tie).
    order = F.struct(F.col("least").isNull(), F.col("least"), F.col("fp"))
    kept = named.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.least").alias(fresh(docs, "_least")), F.col("k.fp").alias(fresh(docs, "_kept"))
    )
    kept_key, kept_print = kept.columns
    joined = marked.join(cut_lineage(kept), F.col(key).eqNullSafe(F.col(kept_key)) & (F.col(mark) == F.col(kept_print)), "left_semi")
    return joined.dropDuplicates([key, mark]).select(*docs.columns)
