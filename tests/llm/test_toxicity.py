import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, prose
from tidewright.llm import queries, toxicity

INSULTS = ["idiot", "scum", "lowei", "trash"]


def toxic_corpus(n=600, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(draw, draw.randint(5, 80)).split()
        toxic, junk = draw.random() < 0.2, draw.random() < 0.2
        for _ in range(draw.randint(1, 3) if toxic else 0):
            words.insert(draw.randint(0, len(words)), draw.choice(INSULTS) + draw.choice(["", "ther", "onand"]))
        if junk:
            words += ["click", "here"] * 3
        docs.append((i, " ".join(words), "en", "src0", 1))
        if i % 2 == 0:
            labels.append((i, int(not junk), int(toxic)))
        else:
            labels.append((-i - 1, int(not junk), int(toxic)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_documents_are_judged_right(spark):
    docs, labels = toxic_corpus()
    truth = {abs(k + 1) if k < 0 else k: t for k, _, t in labels}
    got = toxicity.classify_toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    unseen = [(r.toxic, bool(truth[r.doc_id])) for r in got if r.doc_id % 2]
    assert np.mean([a == b for a, b in unseen]) > 0.97
    assert not any(a and not b for a, b in unseen)


def test_later_models_see_earlier_probabilities():
    """A category that copies the one before it is learned from that one's probability alone."""
    draw = np.random.default_rng(0)
    found = [{"mark"} if m else {"plain"} for m in draw.random(300) < 0.4]
    y = np.array([[float("mark" in f)] * 2 for f in found])
    words = {"mark": 0, "plain": 1}
    chain = toxicity.fit_chain(*toxicity._incidence(found, words), y, ["a", "b"], words, np.arange(300) % toxicity.FOLDS)
    assert len(chain.weights[0]) == 3 and len(chain.weights[1]) == 4
    assert chain.weights[1][1] > 0.3
    p = chain.probabilities(["mark", "plain", None])
    assert p[0].min() > 0.9 and p[1].max() < 0.1 and p.shape == (3, 2)


def test_out_of_fold_probabilities_do_not_leak():
    """With words that tell nothing, out-of-fold predictions carry nothing about the row's own label."""
    draw = np.random.default_rng(1)
    found = [{f"w{i}"} for i in range(200)]
    first = (draw.random(200) < 0.5).astype(float)
    y = np.column_stack([first, first])
    vocabulary = {f"w{i}": i for i in range(200)}
    chain = toxicity.fit_chain(*toxicity._incidence(found, vocabulary), y, ["a", "b"], vocabulary, np.arange(200) % toxicity.FOLDS)
    assert chain.weights[1][1] < 0.3


def test_awkward_tables(spark, write, awkward, clashing, empty):
    from tests.llm.conftest import awkward_rows

    labels = [(0, 1, 0), (1, 0, 1), (1, 1, 0), (None, 1, 1), (2, None, 1), (3, 1, None), (4, 1, 0)]
    frame = spark.createDataFrame(labels, LABELS)
    for docs, n in ((awkward, len(awkward_rows())), (clashing, len(awkward_rows())), (empty, 0)):
        got = queries.op3_toxicity(spark, write(documents=docs, labels=frame)).collect()
        assert len(got) == n and all(0 <= r.p_toxic <= 1 for r in got)
        assert sorted((r.doc_id for r in got), key=repr) == sorted((r.doc_id for r in docs.collect()), key=repr)
    none = queries.op3_toxicity(spark, write(documents=awkward, labels=frame.limit(0))).collect()
    assert {(r.p_junk, r.p_toxic, r.toxic) for r in none} == {(0.5, 0.5, False)}


@pytest.mark.parametrize("rows", [50, 20_000])
def test_sample_bound_is_kept(spark, rows):
    docs, labels = toxic_corpus(200)
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), rows=rows)
    assert len(model.vocabulary) <= toxicity.VOCABULARY


def test_a_crowd_of_junk_words_leaves_the_toxic_words_their_places(spark):
    """More words tell junk than any fixed vocabulary holds, and better than the toxic ones do."""
    spam = ["zq" + "".join(chr(97 + i // 26**p % 26) for p in (2, 1, 0)) for i in range(700)]
    docs, labels = [], []
    for i in range(300):
        junk, toxic = i % 3 == 0, i % 4 == 1
        words = prose(random.Random(i), 20).split() + (spam if junk else []) + (["grutnak"] if toxic and i % 8 == 1 else [])
        docs.append((i, " ".join(words), "en", "src0", 1))
        labels.append((i, int(not junk), int(toxic)))
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert {*spam, "grutnak"} <= set(model.vocabulary)


def test_fit_ends_at_the_optimum():
    draw = np.random.default_rng(2)
    x = draw.random((400, 60)) < 0.15
    y = (draw.random(400) < 1 / (1 + np.exp(-(x[:, :8].sum(axis=1) * 2.0 - 3)))).astype(float)
    rows, cols = np.nonzero(x)
    earlier = draw.random((400, 1))
    w = toxicity.fit_linear(rows, cols, 60, earlier, y)
    wide = np.column_stack([np.ones(400), earlier, x])
    slope = wide.T @ (1 / (1 + np.exp(-wide @ w)) - y) + 0.3 * np.concatenate([[0.0], w[1:]])
    assert np.abs(slope).max() <= toxicity.SLOPE + 1e-6


def test_folds_start_elsewhere_and_end_alike():
    """A fold's fit from the weights of all rows ends where one from nothing does."""
    draw = np.random.default_rng(6)
    rows, cols = np.nonzero(draw.random((500, 80)) < 0.1)
    y = (draw.random(500) < 0.3).astype(float)
    hits, earlier = toxicity.Hits(rows, cols, 500, 80), draw.random((500, 1))
    every, inside = np.ones(500), (np.arange(500) % 5 != 2).astype(float)
    full = toxicity.fit_hits(hits, earlier, y, every)
    one, two = (toxicity.fit_hits(hits, earlier, y, inside, start) for start in (None, full))
    kept = inside.astype(bool)
    place = np.cumsum(kept) - 1
    alone = toxicity.fit_linear(place[rows[kept[rows]]], cols[kept[rows]], 80, earlier[kept], y[kept])
    assert np.abs(one - two).max() < 0.02 and np.abs(one - alone).max() < 0.02


def test_a_chain_at_the_bound_of_its_sample():
    """20,000 documents and thousands of words: the seven fits, one after the other, end within a minute."""
    draw = np.random.default_rng(7)
    n, words = toxicity.TRAIN_ROWS, 7500
    rows = np.repeat(np.arange(n), 150)
    cols = np.minimum((draw.pareto(0.6, len(rows)) * 20).astype(np.int64), words - 1)
    rows, cols = np.unique(np.column_stack([rows, cols]), axis=0).T
    score = np.bincount(rows, draw.normal(size=words)[cols], n)
    y = np.column_stack([score + draw.normal(size=n) > c for c in (2.0, 4.0)]).astype(float)
    began = time.perf_counter()
    chain = toxicity.fit_chain(rows, cols, y, ["a", "b"], {str(i): i for i in range(words)}, np.arange(n) % toxicity.FOLDS)
    assert time.perf_counter() - began < 60
    earlier = np.zeros((n, 0))
    p = toxicity._probability(chain.weights[0], rows, cols, earlier)
    assert np.mean((p > 0.5) == y[:, 0]) > 0.9


def test_the_sample_stays_off_the_driver(spark):
    """The driver's Python holds less than one number per document and word of the training sample."""
    spam = " ".join("zq" + "".join(chr(97 + i // 26**p % 26) for p in (2, 1, 0)) for i in range(700))
    n = 3000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, spam).otherwise("the other and red").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    tracemalloc.start()
    try:
        model = toxicity.train(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.vocabulary) >= 700 and peak < 4 * 700 * n / 2


@pytest.mark.parametrize("rows", [150, 20_000])
def test_the_stored_sample_gives_the_plain_chain(spark, rows):
    """Read in several splits, with repeated keys, at and below its bound, the sample is fitted in the order of the hash."""
    docs, labels = toxic_corpus(400)
    docs = [(k - 1 if k % 4 == 1 else k, *rest) for k, *rest in docs]
    labels = [(-k - 1 if k < 0 and k % 4 else k, *marks) for k, *marks in labels]
    given, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        model = toxicity.train(given, marks, rows=rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    marked = {r.doc_id: [r.junk, r.toxic] for r in marks.selectExpr("doc_id", "1 - quality as junk", "toxic").orderBy(F.xxhash64("doc_id")).limit(rows).collect()}
    place = model.vocabulary
    drawn = [(k, sorted(place[w] for w in toxicity.words_of(t) if w in place)) for k, t, *_ in docs if k in marked]
    at = {r.id: i for i, r in enumerate(spark.createDataFrame([(k,) for k in marked], "id long").orderBy(F.xxhash64("id")).collect())}
    drawn = sorted(drawn, key=lambda d: (at[d[0]], d[1]))[:rows]
    pairs = np.array([(i, c) for i, (_, hits) in enumerate(drawn) for c in hits])
    y = np.array([marked[k] for k, _ in drawn], dtype=float)
    plain = toxicity.fit_chain(pairs[:, 0], pairs[:, 1], y, model.names, place, np.arange(len(y)) % toxicity.FOLDS)
    assert len(place) and all(np.abs(a - b).max() < 1e-9 for a, b in zip(model.weights, plain.weights))
