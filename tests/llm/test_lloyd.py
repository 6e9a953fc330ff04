import hashlib
import math

import numpy as np
import pytest

from tidewright.llm import lloyd, queries

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(rows, k=40, rounds=5, width=64, scale=256, seed=2):
    """Lloyd's rounds in Python's whole numbers."""
    kept = [(i, [math.floor(v * scale) if abs(v) < 2**53 else int(v) * scale for v in x]) for i, x in rows
            if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x)]
    named = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    centres = [x for _, x in named[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            own = [x for (_, x), c in zip(kept, of) if c == j]
            if own:
                centres[j] = [sum(column) // len(own) for column in zip(*own)]
    last = [nearest(x) for _, x in kept]
    short = lambda v: v if v < 2**63 else None
    inertia = short(sum(d for d, _ in last))
    return [
        (i, j, short(d), short(sum(e for e, c in last if c == j)), inertia, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, last)
    ]


def frame(spark, rows, kind="float"):
    data = [(i, x, 1, "taken", "taken") for i, x in rows]
    return spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int, cluster string, chunk string").repartition(3)


def vectors(n, spread=1.0, seed=4):
    draw = np.random.default_rng(seed)
    mid = draw.normal(size=(6, 64))
    return [(i, [float(np.float32(v)) for v in mid[i % 6] * spread + draw.normal(size=64) * 0.3]) for i in range(n)]


def test_query_equals_the_plain_version(spark, write, rows):
    given = vectors(300)
    # Every awkward vector, repeated rows, ties, and a third of all vectors alike.
    given += [(300 + i, given[0][1]) for i in range(150)]
    given += [(5, given[5][1]), (5, given[6][1]), (None, given[7][1]), (900, None), (901, []), (902, given[0][1][:63]),
              (903, [None] + given[0][1][1:]), (904, [math.nan] + given[0][1][1:]), (905, [math.inf] + given[0][1][1:]), (906, [0.0] * 64)]
    got = queries.op11_clusters(spark, write(embeddings=frame(spark, given)))
    assert got.columns[:6] == COLUMNS
    assert rows(got, *COLUMNS) == sorted(plain(given), key=repr)


@pytest.mark.parametrize("n", [0, 1, 7])
def test_fewer_vectors_than_clusters(spark, write, rows, n):
    given = vectors(n) + [(99, None)]
    got = queries.op11_clusters(spark, write(embeddings=frame(spark, given)))
    assert rows(got, *COLUMNS) == sorted(plain(given), key=repr)


@pytest.mark.parametrize("kind, big", [("float", 3e7), ("float", 3e38), ("double", 1e300)])
def test_numbers_beyond_a_long_stay_exact(spark, write, rows, kind, big):
    given = vectors(60)
    given += [(100 + i, [float(np.float32(big)) if kind == "float" else big] * (i + 1) + given[i][1][i + 1 :]) for i in range(5)]
    got = queries.op11_clusters(spark, write(embeddings=frame(spark, given, kind)))
    assert rows(got, *COLUMNS) == sorted(plain(given), key=repr)


def test_blocks_of_any_width_give_the_same(spark, rows):
    data = frame(spark, [(i, x[:10]) for i, x in vectors(80)])
    one, two = (lloyd.cluster_vectors(data, width=10, k=5, rounds=3, block=b) for b in (4, 10))
    assert rows(one) == rows(two) and one.count() == 80


def test_no_task_holds_whole_vectors(spark):
    data = frame(spark, vectors(40)).select("vec_id", "embedding")
    stored = lloyd.column_blocks(data, "vec_id", "embedding", 64, 256, 16)
    assert {len(r.cells) for r in stored.collect()} <= {1 + 4 * 16 * n for n in range(1, 41)}
