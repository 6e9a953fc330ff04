"""Removal of repeated byte strings with sparse suffix sorting by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes covers it that also starts in a document with a smaller id.
Sorting every suffix of a corpus would move each byte ``length`` times, so only suffixes that can have a
partner are sorted:

1.  Every window of ``length`` bytes names one of its q-grams, the one with the smallest hash (its
    anchor). Equal windows name equal anchors, so strings that repeat meet at a repeated anchor.
2.  Hashes of the anchors, dealt by hash, tell each chunk of documents which of its anchors occur again.
3.  The bytes around these anchors, once per chunk and content with the smallest document id, are dealt
    by anchor. In each bucket the suffixes of what differs there are sorted to depth ``length`` by
    bucket-pointer refinement: q-gram buckets first, then refined by the bucket pointers of later
    offsets. The smallest document of each final bucket decides, on the bytes themselves.
4.  The answers go back to the chunks, which cover, cut and digest their texts.

Only packed arrays move, with one row per chunk and bucket.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import byte_values, mix64, per_batch, text_bytes
from tidewright.session import cut_lineage

LENGTH = 50
GRAM = 24
# Bytes of text in a chunk (a longer document is a chunk of its own) and per bucket of anchors.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
# Stands for a null id: it is no smaller than any.
NO_ID = np.iinfo(np.int64).max


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    out, have = x, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the q-grams that some window of ``length`` bytes names."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.ndarray((n - 7,), dtype="<u8", buffer=data, strides=(1,))
    count = n - gram + 1
    h = words[:count] * np.uint64(0x9E3779B97F4A7C15)
    for j in (8, 16):
        h ^= h >> np.uint64(29)
        h += words[j : j + count]
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)
    # A gram is named if the largest of the minima around it is its own hash.
    edge = np.zeros(width - 1, dtype=np.uint64)
    named = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h)
    return named, mix64(h[named])


def refined_buckets(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket pointer of every position after sorting its suffix to depth ``length``: equal pointers mean
    equal strings, smaller ones smaller strings. Positions nearer than that to the end are not defined.

    The first buckets are 8-grams. A bucket is refined by sorting its suffixes on the pointers at an
    offset as deep as these are; what is alone in its bucket is not touched again.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    grams = np.ndarray((n,), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)
    pointer = _ranks(grams)
    depth = min(8, length)
    while depth < length:
        step = min(depth, length - depth)
        sizes = np.bincount(pointer, minlength=n)
        crowd = np.flatnonzero(sizes[pointer] > 1)
        if not len(crowd):
            break
        later = np.concatenate([pointer, np.zeros(length, np.int64)])[crowd + step]
        own = pointer[crowd]
        order = np.lexsort((later, own))
        o, l = own[order], later[order]
        new_bucket = np.concatenate(([True], o[1:] != o[:-1]))
        new_run = new_bucket | np.concatenate(([True], l[1:] != l[:-1]))
        index = np.arange(len(o))
        first = np.maximum.accumulate(np.where(new_bucket, index, 0))
        run = np.maximum.accumulate(np.where(new_run, index, 0))
        # Pointers are the places of the buckets' first suffixes, so refining moves only those behind.
        pointer = pointer.copy()
        pointer[crowd[order]] = o + run - first
        depth += step
    return pointer


def _ranks(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values, kind="stable")
    sorted_ = values[order]
    start = np.concatenate(([True], sorted_[1:] != sorted_[:-1])) if len(values) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(start, np.arange(len(values)), 0)) if len(values) else np.zeros(0, np.int64)
    out = np.empty(len(values), dtype=np.int64)
    out[order] = first
    return out


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    head = np.array([len(parts), *map(len, parts)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, count, 8).tolist()
    out, at = [], 8 * (1 + count)
    for s in sizes:
        out.append(raw[at : at + s])
        at += s
    return out


class Chunk:
    """Documents of a chunk, smallest id first."""

    def __init__(self, blob: bytes):
        ids, lengths, data = _unpack(blob)
        self.ids = np.frombuffer(ids, np.int64)
        ends = np.cumsum(np.frombuffer(lengths, np.int64))
        self.texts = [data[e - n : e] for e, n in zip(ends.tolist(), np.frombuffer(lengths, np.int64).tolist())]

    def anchors(self, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [anchors(t, length) for t in self.texts]


def _chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(chunk, raw_bytes, blob), written once: chunks keep their documents whatever happens later."""

    def pack(held: list[tuple[int, memoryview]]) -> dict:
        held.sort(key=lambda x: x[0])
        ids = np.array([i for i, _ in held], dtype=np.int64)
        lengths = np.array([len(t) for _, t in held], dtype=np.int64)
        return {"chunk": uuid.uuid4().hex, "raw_bytes": int(lengths.sum()), "blob": _pack(ids, lengths, b"".join(t for _, t in held))}

    def work(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out, held, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
            if held and size + len(t) > CHUNK_BYTES:
                out.append(pack(held))
                held, size = [], 0
            held.append((NO_ID if i is None else i, t))
            size += len(t)
        if held:
            out.append(pack(held))
        schema = pa.schema([("chunk", pa.string()), ("raw_bytes", pa.int64()), ("blob", pa.binary())])
        return [pa.RecordBatch.from_pylist([row], schema=schema) for row in out]

    rows = docs.select(F.col(key).cast("long").alias("key"), text_bytes(text).alias("raw"))
    return cut_lineage(rows.mapInArrow(per_batch(work), "chunk string, raw_bytes long, blob binary"))


def _hashes_by_bucket(found, buckets: int) -> dict[int, np.ndarray]:
    """Sorted distinct anchor hashes of a chunk, by bucket. The high bits choose the bucket."""
    hashes = np.unique(np.concatenate([h for _, h in found])) if found else np.zeros(0, np.uint64)
    which = (hashes >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(which, kind="stable")
    hashes, which = hashes[order], which[order]
    cuts = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))) if len(which) else np.zeros(0, int)
    return {int(which[s]): hashes[s:e] for s, e in zip(cuts, [*cuts[1:], len(which)])}


def _repeated(found, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """Sorted hashes that occur again: elsewhere by the answers, or in this chunk."""
    out = []
    for bucket, hashes in _hashes_by_bucket(found, buckets).items():
        if bucket in answers:
            bits = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=len(hashes)).astype(bool)
            out.append(hashes[bits])
    every = np.sort(np.concatenate([h for _, h in found])) if found else np.zeros(0, np.uint64)
    out.append(every[1:][every[1:] == every[:-1]])
    return np.unique(np.concatenate(out))


def _contexts(chunk: Chunk, found, again: np.ndarray, buckets: int, length: int):
    """Per bucket the distinct (left bytes, context) with the first, smallest, id; and every occurrence
    as (document, position, bucket, number in the bucket)."""
    width = length - GRAM + 1
    kept: dict[int, dict[tuple[int, bytes], int]] = {}
    owners: dict[int, list[int]] = {}
    met = []
    for d, (text, (places, hashes)) in enumerate(zip(chunk.texts, found)):
        if not len(places) or not len(again):
            continue
        hit = again[np.minimum(np.searchsorted(again, hashes), len(again) - 1)] == hashes
        which = ((hashes[hit] >> np.uint64(32)) % np.uint64(buckets)).tolist()
        for p, b in zip(places[hit].tolist(), which):
            left = min(width - 1, p)
            context = (left, text[p - left : p + length])
            own = kept.setdefault(b, {})
            number = own.get(context)
            if number is None:
                number = own[context] = len(own)
                owners.setdefault(b, []).append(int(chunk.ids[d]))
            met.append((d, p, b, number))
    return kept, owners, met


def _covered(rows: list[tuple[int, np.ndarray, list[bytes]]], length: int) -> list[np.ndarray]:
    """For one bucket: per chunk and context a mask of the windows (by distance from the anchor) that
    also start in a document with a smaller id. ``rows`` has (left sizes, ids, contexts) per chunk."""
    numbers: dict[tuple[int, bytes], int] = {}
    placed = [np.array([numbers.setdefault((l, c), len(numbers)) for l, c in zip(lefts, contexts)], dtype=np.int64) for lefts, _, contexts in rows]
    least = np.full(len(numbers), NO_ID)
    for at, (_, ids, _) in zip(placed, rows):
        np.minimum.at(least, at, ids)
    # Contexts of an anchor that has no others have nothing more to compare.
    by_gram: dict[bytes, list[int]] = {}
    for (l, c), i in numbers.items():
        by_gram.setdefault(c[l : l + GRAM], []).append(i)
    known = list(numbers)
    compared = [i for group in by_gram.values() if len(group) > 1 for i in group]
    masks = np.zeros(len(numbers), dtype=np.uint32)
    if compared:
        data = np.frombuffer(b"".join(known[i][1] for i in compared), dtype=np.uint8)
        sizes = np.array([len(known[i][1]) for i in compared])
        starts = np.cumsum(sizes) - sizes
        lefts = np.array([known[i][0] for i in compared])
        windows = np.minimum(lefts, sizes - length) + 1
        owner = np.repeat(np.arange(len(compared)), np.maximum(windows, 0))
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(windows, 0)) - np.maximum(windows, 0), np.maximum(windows, 0))
        pointer = refined_buckets(data, length)[starts[owner] + offset]
        ids = least[np.array(compared)][owner]
        smallest = np.full(len(data), NO_ID)
        np.minimum.at(smallest, pointer, ids)
        hit = smallest[pointer] < ids
        bits = np.uint32(1) << (lefts[owner] - offset).astype(np.uint32)
        np.bitwise_or.at(masks, np.array(compared)[owner[hit]], bits[hit])
    return [np.where(ids > least[at], np.uint32(0xFFFFFFFF), masks[at]) for at, (_, ids, _) in zip(placed, rows)]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``
    (the remaining bytes).

    Null texts count as empty. A null key is no smaller than any key, so such a text removes nothing
    elsewhere but loses what others hold; rows with the same key remove nothing from each other. Texts
    shorter than ``length`` stay whole. An empty table gives an empty result; other columns are not read.
    """
    if not GRAM < length <= GRAM + 31:
        raise ValueError(f"length must be above {GRAM} and at most {GRAM + 31}")
    chunks = _chunks(docs, key, text)
    total = chunks.agg(F.sum("raw_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    packed = pa.schema([("bucket", pa.int64()), ("chunk", pa.string()), ("blob", pa.binary())])
    kind = "bucket long, chunk string, blob binary"

    def tell(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        out = []
        for name, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = Chunk(blob.as_buffer()).anchors(length)
            rows = [
                {"bucket": b, "chunk": name, "blob": (h & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()}
                for b, h in _hashes_by_bucket(found, buckets).items()
            ]
            out.append(pa.RecordBatch.from_pylist(rows, schema=packed))
        return out

    def count(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(b, np.uint32) for b in table.column("blob").to_pylist()]
        values = np.concatenate(arrays)
        order = np.argsort(values)
        same = values[order[1:]] == values[order[:-1]]
        again = np.zeros(len(values), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        bits = [np.packbits(x).tobytes() for x in np.split(again, np.cumsum([len(a) for a in arrays])[:-1])]
        return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"), "blob": pa.array(bits, pa.binary())}, schema=packed)

    texts = chunks.select("chunk", "blob")
    told = cut_lineage(texts.mapInArrow(per_batch(tell), kind).groupBy("bucket").applyInArrow(count, kind))

    def context(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for name, blob in zip(left.column("chunk").to_pylist(), left.column("blob")):
            chunk = Chunk(blob.as_buffer())
            found = chunk.anchors(length)
            answers = dict(zip(right.column("bucket").to_pylist(), right.column("blob").to_pylist()))
            kept, owners, _ = _contexts(chunk, found, _repeated(found, answers, buckets), buckets, length)
            for b, own in kept.items():
                lefts = np.array([l for l, _ in own], dtype=np.uint8)
                sizes = np.array([len(c) for _, c in own], dtype=np.uint8)
                rows.append({"bucket": b, "chunk": name, "blob": _pack(lefts, sizes, np.array(owners[b], np.int64), b"".join(c for _, c in own))})
        return pa.Table.from_pylist(rows, schema=packed)

    def judge(table: pa.Table) -> pa.Table:
        rows = []
        for blob in table.column("blob").to_pylist():
            lefts, sizes, ids, data = _unpack(blob)
            ends = np.cumsum(np.frombuffer(sizes, np.uint8).astype(np.int64)).tolist()
            contexts = [data[s:e] for s, e in zip([0, *ends[:-1]], ends)]
            rows.append((list(lefts), np.frombuffer(ids, np.int64), contexts))
        masks = [_pack(m) for m in _covered(rows, length)]
        return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"), "blob": pa.array(masks, pa.binary())}, schema=packed)

    judged = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(context, kind).groupBy("bucket").applyInArrow(judge, kind)
    answers = told.withColumn("masks", F.lit(False)).unionByName(judged.withColumn("masks", F.lit(True)))
    result = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        flags, masks = {}, {}
        for b, blob, is_mask in zip(*(right.column(c).to_pylist() for c in ("bucket", "blob", "masks"))):
            if is_mask:
                masks[b] = np.frombuffer(_unpack(blob)[0], np.uint32)
            else:
                flags[b] = blob
        for blob in left.column("blob"):
            chunk = Chunk(blob.as_buffer())
            found = chunk.anchors(length)
            _, owners, met = _contexts(chunk, found, _repeated(found, flags, buckets), buckets, length)
            # Covered from and up to, per document.
            covers: list[tuple[list[int], list[int]]] = [([], []) for _ in chunk.texts]
            width = length - GRAM + 1
            for d, p, b, number in met:
                mask = 0xFFFFFFFF if chunk.ids[d] > owners[b][number] else int(masks[b][number])
                if mask:
                    first, last = max(0, p - width + 1), min(p, len(chunk.texts[d]) - length)
                    lows, highs = covers[d]
                    if mask == 0xFFFFFFFF:
                        lows.append(first)
                        highs.append(last + length)
                    else:
                        own = [i for i in range(first, last + 1) if mask >> (p - i) & 1]
                        lows += own
                        highs += [i + length for i in own]
            for i, text_, (lows, highs) in zip(chunk.ids.tolist(), chunk.texts, covers):
                kept, removed, spans = text_, 0, 0
                if lows:
                    edge = np.bincount(lows, minlength=len(text_) + 1) - np.bincount(highs, minlength=len(text_) + 1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                    kept = np.frombuffer(text_, np.uint8)[~gone].tobytes()
                rows.append((None if i == NO_ID else i, len(text_), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, result)], schema=result)

    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return out.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
