import math

from decimal import Decimal

import numpy as np
import pytest

from tests.llm.brute import roots
from tidewright.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    def usable(x, label, key):
        return key is not None and label is not None and x and len(x) == 8 and all(v is not None and math.isfinite(v) for v in x) and any(x)

    n = len(rows)
    unit = [np.array(x, float) / np.linalg.norm(np.array(x, float)) if usable(x, label, k) else None for k, x, label in rows]
    near = [(i, j) for i in range(n) for j in range(n) if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98]
    root = roots(range(n), near)
    out = []
    for i, (key, _, _) in enumerate(rows):
        component = min((rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None), default=None)
        out.append((key, sum(a == i for a, _ in near), component, key is not None and key == component))
    return sorted(out, key=repr)


def sample():
    draw = np.random.default_rng(6)
    rows = []
    for i in range(300):
        base = draw.normal(size=8) if i % 3 or not rows else np.array(rows[draw.integers(len(rows))][1]) + draw.normal(size=8) * 0.12
        rows.append((i, [float(np.float32(v)) for v in base], int(draw.integers(3))))
    hot = [float(np.float32(v)) for v in draw.normal(size=8)]
    rows += [(400 + i, hot if i % 2 else [float(np.float32(v + 0.001 * i)) for v in hot], 1) for i in range(60)]
    rows += [(500, None, 1), (501, [0.0] * 8, 1), (502, [1.0] * 7 + [None], 1), (503, [float("nan")] + [1.0] * 7, 1), (504, hot, None),
             (505, [float("inf")] + [1.0] * 7, 1), (None, hot, 1), (1, rows[1][1], rows[1][2]), (506, [1.0, 2.0], 1), (507, [], 2)]
    return rows


@pytest.mark.parametrize("block", [16, 512])
def test_links_match_all_pairs(spark, write, rows, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors.Index, "reach", lambda self, sample, radius, recall: radius)  # exact
    given = sample()
    frame = spark.createDataFrame(given, SCHEMA).selectExpr("*", "'x' cell", "1 parts", "2 id", "3 x")
    assert rows(queries.op7_vectors(spark, write(embeddings=frame))) == expected(given)


def test_empty_and_unusable(spark, write, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(queries.op7_vectors(spark, write(embeddings=empty))) == []
    odd = spark.createDataFrame([(1, None, 1), (2, [0.0], 1), (None, [1.0], 1)], SCHEMA)
    assert rows(queries.op7_vectors(spark, write(embeddings=odd))) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False)]


def test_recall_on_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in given], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([r.label for r in given])
    near = (x @ x.T >= 0.98) & (same[:, None] == same[None]) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r.n_links for r in queries.op7_vectors(spark, folder).collect()}
    assert got == {r.vec_id: int(n) for r, n in zip(given, near.sum(axis=1))}


@pytest.mark.parametrize("lengths", [1, 8])
def test_an_odd_row_first_hides_no_other_length(spark, rows, monkeypatch, lengths):
    """Every length is linked on its own, whichever row comes first."""
    monkeypatch.setattr(vectors, "LENGTHS", lengths)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    given = [r for r in sample() if r[0] != 506]
    pairs = [(600, [1.0, 2.0], 1), (601, [1.01, 2.0], 1), (602, [2.0, -1.0], 1)] + [(610 + i, [1.0, 0.0, 0.001 * i], 2) for i in range(40)]
    frame = spark.createDataFrame([pairs[0], *given, *pairs[1:]], SCHEMA).coalesce(1)
    monkeypatch.setattr(vectors.Index, "reach", lambda self, sample, radius, recall: radius)  # exact
    want = expected(given) + [(600, 1, 600, True), (601, 1, 600, False), (602, 0, 602, True)] + [(610 + i, 39, 610, i == 0) for i in range(40)]
    assert rows(vectors.near_vectors(frame)) == sorted(want, key=repr)


@pytest.mark.parametrize("kind, one, two", [("double", 1.2, 1.7), ("string", "a", "b"), ("long", 2**40, 2**40 + 1), ("decimal(5,2)", Decimal("1.20"), Decimal("1.70"))])
def test_labels_of_any_type(spark, rows, monkeypatch, kind, one, two):
    """Only equal labels link, whatever their type; a null label links with nothing."""
    monkeypatch.setattr(vectors.Index, "reach", lambda self, sample, radius, recall: radius)  # exact
    data = [(i, [1.0, 0.001 * i, 0.0], (one, two)[i % 2]) for i in range(40)] + [(90, [1.0, 0.0, 0.0], None)]
    got = vectors.near_vectors(spark.createDataFrame(data, f"vec_id long, embedding array<float>, label {kind}"))
    assert rows(got) == sorted([(i, 19, i % 2, i < 2) for i in range(40)] + [(90, 0, 90, True)], key=repr)
