import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from tests.llm.conftest import DOCS, awkward_rows, prose
from tidewright.llm import queries, runs


def plain_runs(w):
    """Every lag, every place, by comparing words."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = any(all(w[x] == w[x - r] for x in range(start + r, start + length)) for r in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.add((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_query(doc_id, text):
    """The contract of the query, word by word."""
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = plain_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_equal_a_plain_search():
    draw = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(draw.randint(1, 4)):
            w = [draw.randrange(draw.choice([1, 2, 3, 6])) for _ in range(draw.randint(0, 40))]
            for _ in range(draw.randint(0, 2)):
                root = [draw.randrange(4) for _ in range(draw.randint(1, 9))]
                at = draw.randint(0, len(w))
                w[at:at] = (root * 9)[: draw.randint(1, 6 * len(root))]
            texts.append(w)
        sizes = np.array([len(t) for t in texts])
        got = runs.find_runs(np.array([x for t in texts for x in t], dtype=np.int64), sizes)
        begins = np.cumsum([0, *sizes])
        assert list(zip(*(g.tolist() for g in got))) == [(s + b, n, q) for b, t in zip(begins, texts) for s, n, q in plain_runs(t)]


@pytest.mark.parametrize("root", [["x"], ["a", "a", "b", "b"], [str(i) for i in range(997)]])
def test_a_long_text_of_one_period_costs_little(root):
    """Every word of it occurs very often; each is met once a level, not once per earlier occurrence."""
    words = np.array([sorted(set(root)).index(r) for r in root] * (600_000 // len(root)))
    began = time.process_time()
    start, length, period = runs.find_runs(words, np.array([len(words)]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [len(words)], [len(root)])
    assert time.process_time() - began < 20


def planted(n=250):
    draw = random.Random(8)
    rows = []
    for i in range(n):
        words = prose(draw, draw.randint(1, 60)).split()
        for _ in range(draw.randint(0, 2)):
            at, root = draw.randint(0, len(words)), prose(draw, draw.randint(1, 5)).split()
            words[at:at] = root * draw.randint(2, 8)
        rows.append((i, draw.choice([" ", "\n", " \t"]).join(words), "en", "src0", 1))
    return rows


def test_query_equals_the_plain_version(spark, write, rows):
    docs = planted()
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in docs) > 10
    got = queries.op13_runs(spark, write(documents=spark.createDataFrame(docs, DOCS).repartition(3)))
    assert got.columns[:8] == COLUMNS
    assert rows(got, *COLUMNS) == sorted((plain_query(r[0], r[1]) for r in docs), key=repr)


def test_awkward_tables(spark, write, rows, awkward, clashing, empty):
    # The long texts of the fixture hold no run; their plain version would take minutes.
    short = [r for r in awkward_rows() if len(r[1] or "") < 5000]
    expected = sorted((plain_query(r[0], r[1]) for r in short), key=repr)
    for docs in (awkward, clashing):
        got = queries.op13_runs(spark, write(documents=docs))
        assert got.count() == len(awkward_rows())
        assert [r for r in rows(got, *COLUMNS) if r in set(expected)] == expected
    assert queries.op13_runs(spark, write(documents=empty)).count() == 0


def test_operator_gives_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "a b " + "x y z " * 4 + "end end end end end end")], "doc_id long, text string")
    got = runs.periodic_runs(docs).first()
    assert [tuple(r) for r in got.runs] == [(2, 12, 3), (14, 6, 1)]
    assert tuple(got.best) == (14, 6, 1) and got.collapsed == "a b x y z end"
