import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewright.llm import queries, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = list(" \n\t\u00a0\u3000ab'sédé1.!<|") + ["<|endoftext|>", "  ", "日本", "\U0001f600", "\x1c", "\x85"]
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12), max_size=3))
def test_counts_equal_the_library(texts):
    texts = ["".join(t) for t in texts]
    assert tokens.batch_counts(texts, tokens.load(PATH), {}) == [plain(t) for t in texts]


def test_query(spark, write, awkward, clashing, empty, rows):
    from tests.llm.conftest import awkward_rows

    want = [(k, len((t or "").encode()), plain(t), plain(t) > 512) for k, t, *_ in awkward_rows()]
    for docs, expected in ((awkward, want), (clashing, want), (empty, [])):
        assert rows(queries.op4_tokens(spark, write(documents=docs))) == sorted(expected, key=repr)


def test_known_counts_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 10)
    known = {}
    texts = [" ".join(f"w{i}{j}" for i in range(8)) for j in range(6)]
    for t in texts:
        assert tokens.batch_counts([t, ""], tokens.load(PATH), known) == [plain(t), 0]
        assert len(known) <= 10


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_models_count_whole_texts(name):
    path = public_tokenizers.path(name)
    texts = ["Hello  World's end", "", "ünï 日本"]
    if name.endswith("json"):
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    assert tokens.batch_counts(texts, tokens.load(path), {}) == want
