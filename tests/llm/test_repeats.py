import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCS, prose
from tidewright.llm import queries, repeats


def expected(rows):
    first = {}
    for key, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            s = data[i : i + 50]
            if key is not None:
                first[s] = min(first.get(s, key), key)
    out = []
    for key, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            low = first.get(data[i : i + 50])
            if low is not None and (key is None or low < key):
                gone[i : i + 50] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((key, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    draw = random.Random(8)
    shared = [prose(draw, n) for n in (9, 15, 30, 60)] + ["a" * 120, "é日本" * 20, "ab" * 60]
    rows = [(i, " ".join(draw.choice([prose(draw, draw.randint(0, 20)), draw.choice(shared), draw.choice(shared)[7:-3]]) for _ in range(draw.randint(0, 6))), "en", "s", 1) for i in range(150)]
    return rows + [(200 + i, rows[3][1] + prose(draw, 3), "en", "s", 1) for i in range(20)]


def test_query_matches_brute_force(spark, write, awkward, clashing, empty, rows, monkeypatch):
    from tests.llm.conftest import awkward_rows

    monkeypatch.setattr(repeats, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    given = passages()
    frame = spark.createDataFrame(given, DOCS).repartition(5)
    assert rows(queries.op2_repeats(spark, write(documents=frame))) == expected(given)
    want = expected(awkward_rows())
    for docs, wanted in ((clashing, want), (empty, [])):
        assert rows(queries.op2_repeats(spark, write(documents=docs))) == wanted


def test_whole_sample_against_brute_force(spark, rows):
    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows(queries.op2_repeats(spark, folder)) == expected(given)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=60, max_size=300).map(lambda b: bytes(x % 3 for x in b)))
def test_refined_buckets_sort_suffixes(data):
    for length in (8, 13, 50):
        pointer = repeats.refined_buckets(np.frombuffer(data, np.uint8), length)
        n = len(data) - length + 1
        order = sorted(range(n), key=lambda i: data[i : i + length])
        for a, b in zip(order, order[1:]):
            same = data[a : a + length] == data[b : b + length]
            assert (pointer[a] == pointer[b]) if same else (pointer[a] < pointer[b])


@given(st.binary(min_size=50, max_size=200))
@settings(max_examples=100, deadline=None)
def test_every_window_names_an_anchor(data):
    places, hashes = repeats.anchors(data)
    for i in range(len(data) - 49):
        assert ((places >= i) & (places <= i + 26)).any()
    again, other = repeats.anchors(b"xyz" + data)
    assert set(hashes.tolist()) <= set(other.tolist()) | set(hashes.tolist())
