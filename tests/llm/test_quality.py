import random
import zlib

import numpy as np

from tests.llm.conftest import DOCS, prose
from tidewright.llm import boosting, quality, queries

LABELS = "doc_id long, quality int, toxic int"


def test_trees_learn_and_flat_traversal_equals_the_walk():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert np.mean((model.score(x[2000:]) > 0.5) == y[2000:]) > 0.97

    def walk(row):
        total = model.base
        for f, t, v in zip(model.feature, model.threshold, model.leaf):
            i = 0
            while i < f.shape[0]:
                i = 2 * i + 1 + int(row[f[i]] > t[i])
            total += v[i - f.shape[0]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x[:50]), [walk(r) for r in x[:50]])
    assert boosting.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert boosting.fit(x[:9], np.ones(9)).score(x[:2]).min() > 0.8


def test_held_out_accuracy_and_no_leak_of_held_out_labels(spark, write):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(500):
        words = prose(draw, draw.randint(3, 90)).split()
        good = draw.random() < 0.7
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w + draw.choice(["$$", "%%", "|"]) for w in words]
        docs.append((i, " ".join(words), "en", "src0", 1))
        labels.append((i, int(good), 0))
    frame = spark.createDataFrame(docs, DOCS)
    got = queries.op10_quality(spark, write(documents=frame, labels=spark.createDataFrame(labels, LABELS))).collect()
    truth = {k: q for k, q, _ in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [r for r in got if r.held_out]
    assert len(unseen) > 60 and np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.97
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, 0) for k, q, _ in labels]
    again = queries.op10_quality(spark, write(documents=frame, labels=spark.createDataFrame(turned, LABELS))).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in got}


def test_awkward_tables(spark, write, awkward, clashing, empty):
    from tests.llm.conftest import awkward_rows

    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, 1), (4, 0, 0), (5, 7, 0)], LABELS)
    for docs, n in ((awkward, len(awkward_rows())), (clashing, len(awkward_rows())), (empty, 0)):
        got = queries.op10_quality(spark, write(documents=docs, labels=labels)).collect()
        assert len(got) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    none = queries.op10_quality(spark, write(documents=awkward, labels=labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert len(quality.statistics(b"")) == len(quality.FEATURES)
