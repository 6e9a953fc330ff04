"""Near-duplicate vectors by an inverted multi-index.

Two codebooks quantise the halves of the unit vectors; a cell is a pair of centroids. A vector lies in
one cell and looks for its neighbours in others, nearest first: the multi-sequence order is that of
a_k^2 + b_l^2, where a_k is how far the first half would have to move before centroid k is its nearest
(the distance to the bisecting plane), and b_l likewise. It ends where the target recall is reached:
sample vectors are moved by the largest distance of a link in random directions, and the traversal goes
as far as the target share of them needs. What it meets is verified in double precision. Vectors of another
length have codebooks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewright.llm.common import per_batch
from tidewright.llm.graph import components
from tidewright.session import cut_lineage

COSINE = 0.98
# Vectors the codebooks are fitted on, and the most centroids of one codebook.
FIT_ROWS = 4096
CENTROIDS = 32
RECALL = 0.999
# Lengths that get codebooks of their own, the commonest first; each other length is one cell per label.
LENGTHS = 8
# Vectors of one cell that are compared as a block; a larger cell is dealt to several tasks.
BLOCK = 512
ROUNDS = 8


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have a direction at all."""
    with np.errstate(all="ignore"):
        peak = np.abs(vectors).max(axis=1, initial=0.0)
        ok = np.isfinite(peak) & (peak > 0)
        scaled = vectors / np.where(ok, peak, 1.0)[:, None]
        norm = np.sqrt((scaled * scaled).sum(axis=1))
        return np.where(ok[:, None], scaled / np.where(ok, norm, 1.0)[:, None], 0.0), ok


def fit_codebook(half: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's iterations from a seeded choice of distinct rows."""
    distinct = np.unique(half, axis=0)
    draw = np.random.default_rng(seed)
    centres = distinct[draw.permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        nearest = _squared(half, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, half)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None], 0)


def _moves(half: np.ndarray, centres: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """Squared distance of every row to the bisecting plane between its own centroid and each other."""
    d = _squared(half, centres)
    own = d[np.arange(len(half)), nearest][:, None]
    gap = np.sqrt(_squared(centres, centres))[nearest]
    with np.errstate(all="ignore"):
        away = np.where(gap > 0, (d - own) / (2 * gap), 0.0)
    return np.maximum(away, 0.0) ** 2


class Index:
    """Codebooks for the halves; cells are numbered k * (centroids of the second book) + l."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS, seed: int = 11):
        self.cut = sample.shape[1] // 2
        k = int(max(1, min(centroids, len(sample) // 8)))
        self.books = [fit_codebook(h, k, seed + i) if h.shape[1] and len(h) else np.zeros((1, h.shape[1])) for i, h in enumerate(self.halves(sample))]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_squared(h, b).argmin(axis=1) for h, b in zip(self.halves(x), self.books))

    def reach(self, sample: np.ndarray, radius: float, recall: float, seed: int = 12) -> float:
        """How far the traversal goes so that ``recall`` of the sample, moved by ``radius``, is met."""
        draw = np.random.default_rng(seed)
        step = draw.normal(size=(8, *sample.shape))
        moved = sample[None] + radius * step / np.linalg.norm(step, axis=2, keepdims=True)
        own, rows = self.cells(sample), np.arange(len(sample))
        moves = [_moves(h, b, o) for h, b, o in zip(self.halves(sample), self.books, own)]
        needed = []
        for m in moved:
            k, l = self.cells(unit(m)[0])
            needed.append(moves[0][rows, k] + moves[1][rows, l])
        return float(np.sqrt(np.quantile(np.concatenate(needed), recall)))

    def visits(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for all cells a row looks into, nearest first."""
        own = self.cells(x)
        moves = [_moves(h, b, o) for h, b, o in zip(self.halves(x), self.books, own)]
        bound = radius**2 + 1e-9
        rows, cells, order = [], [], []
        for i in range(len(x)):
            ks = np.flatnonzero(moves[0][i] <= bound)
            ls = np.flatnonzero(moves[1][i] <= bound)
            total = moves[0][i][ks][:, None] + moves[1][i][ls][None]
            a, b = np.nonzero(total <= bound)
            near = np.argsort(total[a, b], kind="stable")
            rows.append(np.full(len(near), i))
            cells.append(ks[a[near]] * len(self.books[1]) + ls[b[near]])
        return np.concatenate(rows) if rows else np.zeros(0, int), np.concatenate(cells) if cells else np.zeros(0, int)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def _by_width(widths: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Each length in a batch with the places of its rows."""
    given = np.asarray(widths)
    for width in np.unique(given).tolist():
        yield width, np.flatnonzero(given == width)


def _links_in_cells(cosine: float):
    """For ``mapInArrow`` over rows (label, width, cell, part, asks, id, copies, x) sorted so: within a cell the stored
    vectors come first, then those that ask. Per asking vector the number of links and a forest of them."""

    def answer(cell: list[tuple]) -> list[tuple[int, int, int]]:
        ids = np.concatenate([c[0] for c in cell])
        asks = np.concatenate([c[1] for c in cell])
        copies = np.concatenate([c[2] for c in cell])
        x = np.concatenate([c[3] for c in cell])
        stored, own, weight = x[~asks], ids[~asks], copies[~asks]
        out = []
        if not len(own):
            return out
        root: dict[int, int] = {}

        def find(i: int) -> int:
            while root.setdefault(i, i) != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        q, who = x[asks], ids[asks]
        for s in range(0, len(who), 256):
            near = (q[s : s + 256] @ stored.T >= cosine) & (who[s : s + 256, None] != own[None])
            n = near @ weight
            for i in np.flatnonzero(n).tolist():
                me = int(who[s + i])
                out.append((me, int(n[i]), me))
                partners = own[near[i]]
                for j in partners.tolist():
                    a, b = find(me), find(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((me, 0, j))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush():
            rows = answer(held)
            columns = list(zip(*rows)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "n", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # Labels of any type, as numbers inside the batch and by their text across batches.
            coded = batch.column(0).dictionary_encode()
            names = [repr(v) for v in coded.dictionary.to_pylist()]
            keys = np.column_stack([np.asarray(c, dtype=np.int64) for c in (coded.indices, *batch.columns[1:4])])
            bounds = np.concatenate(([0], np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1, [len(keys)]))
            asks = np.asarray(batch.column(4).to_numpy(zero_copy_only=False), dtype=bool)
            ids, copies, x = np.asarray(batch.column(5)), np.asarray(batch.column(6)), batch.column(7)
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                mine = (names[keys[s, 0]], *keys[s, 1:].tolist())
                if key is not None and mine != key:
                    yield flush()
                    held = []
                key = mine
                held.append((ids[s:e], asks[s:e], copies[s:e], unit(_matrix(x.slice(s, e - s), key[1]))[0]))
        if held:
            yield flush()

    return run


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
    cosine: float = COSINE, recall: float = RECALL, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per vector: ``key``, ``n_links`` (other vectors linked directly), ``component_id`` (the
    smallest key reachable by links) and ``kept`` (it is its own component id).

    Only vectors with the same label (of any type that can be grouped by), not null, and of the same length are compared. Equal vectors of a label are found as one
    and counted by their number. A vector that is null, empty, zero, holds a null or a non-finite
    component links with nothing; so does one with a null key, whose row stays
    (component null, kept false). Repeated rows are vectors of their own that link with each other; different
    vectors under one key share its component. An empty table gives an empty result; other columns are not read.
    """
    kind = vectors.schema[embedding].dataType
    x = F.col(embedding) if kind == ArrayType(FloatType(), kind.containsNull) else F.col(embedding).cast("array<double>")
    given = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), x.alias("x"))
    sized = F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("x", lambda v: v != 0)
    usable = given.where(sized & F.col("label").isNotNull() & F.col("key").isNotNull())
    # Equal vectors of a label are one class, named by its smallest key.
    classes = cut_lineage(
        usable.groupBy("label", "x").agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("copies")).withColumn("width", F.size("x"))
    )
    common = classes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").limit(LENGTHS).collect()
    if not common:
        return vectors.select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.col(key).isNotNull().alias("kept"))
    indexes = {}
    for width, _ in common:
        sample = classes.where(F.col("width") == width).orderBy(F.xxhash64("x"), "id").limit(fit_rows).select("x").toArrow().column(0).to_pylist()
        index_sample = unit(np.array(sample, dtype=np.float64))[0]
        index = Index(index_sample)
        indexes[width] = index, index.reach(index_sample, float(np.sqrt(max(0.0, 2 - 2 * cosine))), recall)
    schema = classes.select("label", "width").schema.add("cell", "long").add("asks", "boolean")
    schema = schema.add(classes.schema["id"]).add(classes.schema["copies"]).add(classes.schema["x"])

    def cells(index: Index, x: np.ndarray) -> np.ndarray:
        k, l = index.cells(x)
        return (k * len(index.books[1]) + l).astype(np.int64)

    def deal(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        """Every vector once in its own cell and, asking, once in each cell it looks into."""
        out = []
        for width, at in _by_width(batch.column(1)):
            part = batch.take(pa.array(at))
            own = rows = np.arange(len(at))
            cell = np.zeros(2 * len(at), dtype=np.int64)
            if width in indexes:
                index, reach = indexes[width]
                x, _ = unit(_matrix(part.column(4), width))
                rows, asked = index.visits(x, reach)
                cell = np.concatenate([cells(index, x), asked]).astype(np.int64)
            taken = part.take(pa.array(np.concatenate([own, rows])))
            asks = np.concatenate([np.zeros(len(own), bool), np.ones(len(rows), bool)])
            out.append(pa.RecordBatch.from_arrays([*taken.columns[:2], pa.array(cell), pa.array(asks), *taken.columns[2:]], names=schema.names))
        return out

    def stored(batch: pa.RecordBatch) -> pa.RecordBatch:
        cell = np.zeros(batch.num_rows, dtype=np.int64)
        for width, at in _by_width(batch.column(1)):
            if width in indexes:
                cell[at] = cells(indexes[width][0], unit(_matrix(batch.column(2).take(pa.array(at)), width))[0])
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(cell)], names=["label", "width", "cell"])

    # A crowded cell is stored in parts of about BLOCK vectors, and whoever asks asks every part.
    parts = cut_lineage(
        classes.select("label", "width", "x").mapInArrow(per_batch(stored), classes.select("label", "width").schema.add("cell", "long"))
        .groupBy("label", "width", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    )
    dealt = classes.select("label", "width", "id", "copies", "x").mapInArrow(per_batch(deal), schema)
    met = dealt.join(parts, ["label", "width", "cell"])
    spread = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    )
    rows = met.select("label", "width", "cell", F.explode(spread).alias("part"), "asks", "id", "copies", "x")
    by = ["label", "width", "cell", "part"]
    found = cut_lineage(
        rows.repartition(*by).sortWithinPartitions(*by, "asks").mapInArrow(_links_in_cells(cosine), "a long, n long, b long")
    )
    roots = components(found.where("a <> b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = (
        classes.join(counts, classes.id == counts.a, "left")
        .join(roots, classes.id == roots.node, "left")
        .select("label", "x", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("of"))
    )
    component = F.coalesce("of", "key")
    # A row without a key meets no class.
    asked = given.withColumn("label", F.when(F.col("key").isNotNull(), F.col("label")))
    return asked.join(named, ["label", "x"], "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
