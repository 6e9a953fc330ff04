import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCS, awkward_rows, prose
from tidewright.llm import bitmix, lm, queries
from tidewright.session import cut_lineage

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]


def plain(rows):
    """The contract but for the model's score."""
    texts = [(i, (t or "").encode().lower().split(), i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    counts = Counter(w for _, ws, held in texts if not held for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*ws, None])
    return [((i, held, len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), n), base(ws)) for i, ws, held in texts]


def corpus(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(draw, draw.randint(1, 150)).split()
        words = [w.title() if draw.random() < 0.1 else w for w in words]
        rows.append((i, " \n".join(words), "en", "src0", 1))
    return rows


def check(got, rows):
    want = sorted(plain((r[0], r[1]) for r in rows), key=repr)
    have = sorted(((tuple(r[c] for c in COLUMNS), r.base_score) for r in got.collect()), key=repr)
    assert [w for w, _ in want] == [h for h, _ in have]
    assert [h for _, h in have] == pytest.approx([w for _, w in want], rel=1e-9)


def test_counts_and_base_score_equal_the_plain_version(spark, write):
    rows = corpus(400)
    got = queries.op12_scores(spark, write(documents=spark.createDataFrame(rows, DOCS).repartition(5)))
    assert got.columns[:7] == [*COLUMNS[:5], "base_score", "score"]
    check(got, rows)


def test_awkward_tables(spark, write, awkward, clashing, empty):
    for docs in (awkward, clashing):
        got = queries.op12_scores(spark, write(documents=docs))
        check(got, awkward_rows())
        assert all(r.score < 0 for r in got.collect())
    assert queries.op12_scores(spark, write(documents=empty)).count() == 0


def test_nothing_to_learn_from(spark, write):
    keys = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, "a b c", "en", "src0", 1) for i in keys]
    got = queries.op12_scores(spark, write(documents=spark.createDataFrame(rows, DOCS)))
    check(got, rows)
    assert {r.train_tokens for r in got.collect()} == {0}


def test_held_out_texts_cost_less_than_by_word_counts(spark, write):
    """Two languages, in blocks of texts: the words before tell which one is read."""
    draw = random.Random(2)
    rows = []
    for i in range(600):
        parts = (["th", "er", "on", "an"], ["ke", "lo", "mi", "su"])[i % 2]
        small = (["the", "of", "and"], ["der", "und", "ein"])[i % 2]
        words = [draw.choice(small) if draw.random() < 0.4 else "".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(100)]
        rows.append((i, " ".join(words), "en", "src0", 1))
    got = queries.op12_scores(spark, write(documents=spark.createDataFrame(rows, DOCS).repartition(3))).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)
    assert np.mean([r.score > r.base_score for r in held]) > 0.95
    assert all(0 < r.bits_per_byte < 8 for r in held)


def small_model(seed=3):
    """A model over three frequent words, with tables that were filled from random texts."""
    draw = random.Random(seed)
    words = [b"a", b"ab", b"b", b"c", b"ca", b"bbb"]
    vocabulary = bitmix.Vocabulary(words[:3], [50, 30, 20], 10, 5)
    texts = [[draw.choice(words) for _ in range(draw.randint(0, 9))] for _ in range(40)]
    tables = np.zeros((bitmix.PREDICTORS, 2 << 10), dtype=np.int32)
    bitmix.count_bits(tables, series_of(vocabulary, texts), vocabulary.code, 22)
    odds = np.array([bitmix.odds_of(t[0::2], t[1::2]) for t in tables])
    model = bitmix.Model(vocabulary.code, odds, bitmix.Mixer.plain(), 22)
    model.learn(series_of(vocabulary, texts))
    return vocabulary, bitmix.Model(vocabulary.code, odds, model.mixer, 22)


def series_of(vocabulary, texts):
    known: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts])
    tokens = np.array([known.setdefault(w, len(known)) for t in texts for w in t], dtype=np.int64)
    return bitmix.text_series(tokens, sizes, pa.array(list(known), pa.binary()), vocabulary)


def test_probabilities_are_a_distribution():
    """The two outcomes of a bit add up to one, so the texts of all symbols up to a length stay below one, and
    closer to it the longer they are."""
    vocabulary, model = small_model()
    for code in (vocabulary.code, bitmix.Code([1] * 256)):
        assert sum(2.0 ** -float(n) for n in code.sizes) == pytest.approx(1)
    words, level, texts, sums = [b"a", b"ab", b"b", b"?"], [[]], [[]], []
    for _ in range(6):
        sums.append(np.exp(model.score(series_of(vocabulary, texts))).sum())
        level = [t + [w] for t in level for w in words]
        texts = texts + level
    assert sums == sorted(sums) and 0.5 < sums[-1] < 1


def test_a_score_depends_on_nothing_after_or_beside_it():
    vocabulary, model = small_model()
    draw = random.Random(9)
    texts = [[draw.choice([b"a", b"ab", b"b", b"c", b"zz"]) for _ in range(n)] for n in (0, 1, 400, 40_000, 130, 128, 127)]
    together = model.score(series_of(vocabulary, texts))
    assert together == pytest.approx([model.score(series_of(vocabulary, [t]))[0] for t in texts], rel=1e-5)
    begun = [model.score(series_of(vocabulary, [texts[3][:n]]))[0] for n in (200, 2000, 40_000)]
    assert begun[0] > begun[1] > begun[2]


def test_a_text_teaches_its_own_weights():
    """The same odd words again and again cost less in the second half of a text than in the first."""
    vocabulary, model = small_model()
    text = [b"b", b"ab", b"c"] * 9000
    half, whole = (model.score(series_of(vocabulary, [t]))[0] for t in (text[:13_500], text))
    assert whole - half > half


def test_letters_learn_what_words_are_made_of():
    draw = random.Random(4)
    words = sorted({"".join(draw.choice(["ke", "lo", "mi"]) for _ in range(draw.randint(1, 5))).encode() for _ in range(200)})
    code = bitmix.Code([1] * 256)
    tables = np.zeros((bitmix.PREDICTORS, 2 << 14), dtype=np.int32)
    bitmix.count_bits(tables, bitmix.letter_series(words[::2]), code, 18, np.full(len(words[::2]), 3))
    odds = np.array([bitmix.odds_of(t[0::2], t[1::2]) for t in tables])
    model = bitmix.Model(code, odds, bitmix.Mixer.plain(), 18)
    model.learn(bitmix.letter_series(words[1::2]))
    own, odd = (model.score(bitmix.letter_series(w)).mean() for w in (words[1::2], [b"xqzvw", b"rrttpp"]))
    assert own > odd / 2


def test_packed_counts_come_back():
    counts = np.array([0, 1, 254, 255, 256, 10**12, 3])
    assert lm._unpack(lm._pack(counts), len(counts)).tolist() == counts.tolist()


def test_huffman_codes_are_prefix_free():
    paths = bitmix.huffman([5, 1, 1, 9, 3])
    said = ["".join(str(b) for _, b in p) for p in paths]
    assert sum(2.0 ** -len(s) for s in said) == 1 and len(set(said)) == 5 and len(said[3]) == min(map(len, said))


def test_words_are_split_as_bytes_are():
    draw = random.Random(6)
    texts = [b"", b" ", b"One", b"\t\n\x0b\x0c\r one\x1c\x85 TWO\xc2\xa0x ", "É\u00c0A\u2003b".encode(), b"\xff\xfe A\x00b", b""]
    texts += [bytes(draw.choice(b"aB \n\x08\x0e\x1f!\xc3") for _ in range(draw.randint(0, 40))) for _ in range(200)]
    for some in (texts, texts[:2], [b""], texts[2:3], texts[-1:]):
        words, sizes = lm.split_words(some)
        assert words.to_pylist() == [w for t in some for w in t.lower().split()]
        assert sizes.tolist() == [len(t.split()) for t in some]


def test_chunks_hold_their_words_packed(spark):
    """A list of words, one cell each, costs the JVM several times as much at every reading."""
    rows = [(1, "b A\nc a"), (None, None), (2, ""), (3, "\tB b "), (1, "d"), (4, "ünï c")]
    coded = lm.code_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text")
    assert not [f for f in coded.schema if "array<binary>" in f.dataType.simpleString()]
    table = coded.toArrow().combine_chunks()
    batch = table.to_batches()[0]
    got = []
    for row in range(len(batch)):
        chunk = lm.Chunk(batch, row)
        parts = np.split(chunk.tokens, np.cumsum(chunk.sizes)[:-1])
        got += [(k, chunk.held, n, chunk.words.take(pa.array(t)).to_pylist()) for k, n, t in zip(chunk.keys.to_pylist(), chunk.n_bytes.to_pylist(), parts)]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    want = [(k, held(k), len((t or "").encode()), (t or "").encode().lower().split()) for k, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_scores_do_not_depend_on_how_much_is_done_at_once(monkeypatch):
    vocabulary, model = small_model()
    draw = random.Random(10)
    texts = [[draw.choice([b"a", b"ab", b"b", b"c", b"zz"]) for _ in range(n)] for n in (0, 3, 300, 1500, 256, 255, 257)]
    series = series_of(vocabulary, texts)
    said, tables = [], []
    for stretch in (bitmix.BLOCK, 4 * bitmix.BLOCK, bitmix.STRETCH):
        monkeypatch.setattr(bitmix, "STRETCH", stretch)
        said.append(model.score(series))
        tables.append(np.zeros((bitmix.PREDICTORS, 2 << 10), dtype=np.int32))
        bitmix.count_bits(tables[-1], series, vocabulary.code, 22, np.arange(1, 8))
    assert said[1] == pytest.approx(said[0], rel=1e-6) and said[2] == pytest.approx(said[0], rel=1e-6)
    assert (tables[0] == tables[1]).all() and (tables[0] == tables[2]).all()
    assert tables[0][0].sum() == sum(k * int(vocabulary.code.sizes[s].sum()) for k, s in enumerate(np.split(series.symbols, np.cumsum(series.sizes)[:-1]), 1))


def test_a_cut_takes_options_of_the_writer(spark):
    assert not any("uncompressed" in f or "snappy" in f for f in cut_lineage(spark.range(3), compression="uncompressed").inputFiles())
    assert all("snappy" in f for f in cut_lineage(spark.range(3)).inputFiles())
    assert cut_lineage(spark.range(3), **lm.LARGE_CELLS).count() == 3


def test_bits_of_a_stretch_equal_a_walk_along_the_paths():
    """Slots stay in 32 bits: numpy's own indices move twice the memory in every pass over all bits."""
    draw = np.random.default_rng(11)
    code = bitmix.Code([int(c) for c in draw.integers(1, 1000, 40)])
    paths = [code.steps[a : a + n].tolist() for a, n in zip(code.begins, code.sizes)]
    symbols = draw.integers(0, 40, 500).astype(np.int32)
    contexts = [draw.integers(0, 1 << 32, 500, dtype=np.uint32) for _ in range(bitmix.PREDICTORS)]
    widths, bit, slots = bitmix.coded_bits(symbols, contexts, code, 20)
    assert widths.tolist() == [len(paths[s]) for s in symbols]
    assert bit.tolist() == [step & 1 for s in symbols for step in paths[s]]
    assert slots.dtype == np.uint32
    whole = 1 << 32
    for own, context, mix in zip(slots, contexts, map(int, bitmix._MIX)):
        want = []
        for s, c in zip(symbols, map(int, context)):
            for step in paths[s]:
                h = ((((c ^ (c >> 15)) * mix % whole) ^ ((step >> 1) * int(bitmix._STEP) % whole)) * int(bitmix._STEP)) % whole
                want.append((h ^ (h >> 15)) * mix % whole >> 20)
        assert own.tolist() == want
    none = bitmix.coded_bits(symbols[:0], [c[:0] for c in contexts], code, 20)
    assert [v.size for v in none] == [0, 0, 0]


def test_inputs_and_gates_follow_from_the_stored_bytes():
    _, model = small_model()
    odds = np.arange(8, 249, dtype=np.uint8)
    three = bitmix.Model(model.code, np.array([odds, odds, odds[::-1]]), model.mixer, 22)
    x, gate = three.inputs(np.tile(np.arange(len(odds), dtype=np.uint32), (3, 1)))
    want = (odds.astype(np.float32) - np.float32(128)) * np.float32(0.1)
    level = lambda v: (np.abs(v) >= 0.5).astype(int) + (np.abs(v) >= 2)
    assert (x[0] == want).all() and (x[1] == want).all() and (x[2] == want[::-1]).all() and (x[3] == np.float32(0.3)).all()
    assert gate.tolist() == (bitmix.LEVELS * level(want[::-1]) + level(want)).tolist()


def test_texts_have_one_number_each(spark, monkeypatch):
    """Rare words meet their text by a single number, over all chunks and tasks, empty texts and repeated keys included."""
    monkeypatch.setattr(lm, "CHUNK", 40)
    rows = [(None if i % 9 == 0 else i % 50, "word " * (i % 7)) for i in range(300)]
    batches = lm.code_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text").toArrow().to_batches()
    chunks = [lm.Chunk(b, r) for b in batches for r in range(len(b))]
    numbers = [chunk.first + i for chunk in chunks for i in range(len(chunk.keys))]
    assert len(chunks) > 9 and len(numbers) == len(set(numbers)) == len(rows)
