"""Token counts of whole texts, without materialising a text's ids.

A text is cut into pre-tokens; each distinct pre-token's pieces are counted once; the counts are joined
to the pre-token frequencies of every document and summed. The join stays inside the Arrow batch: the
(document, pre-token) pairs of a corpus are about as large as its text, and shuffling them by pre-token
would move all of it and meet " the" in every document. Counts are kept from batch to batch in a table
of bounded size; leaving it only means counting again.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import per_batch

LIMIT = 512
# Distinct pre-tokens whose counts a task keeps between batches.
KEPT = 400_000
# A lone space between two other characters always begins a pre-token of a byte-level model.
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class ByteLevel:
    """Byte-level BPE: words with the space before them (one or more pre-tokens) are counted apart."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def units(self, text: str) -> list[str]:
        parts = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            parts = _LONE_SPACE.split(text)
        return parts

    def count(self, units: list[str], first: bool) -> list[int]:
        given = units if first else [f" {u}" for u in units]
        return [len(e) for e in self.tokenizer.encode_batch(given, add_special_tokens=False)]


class WholeText:
    """Models whose pieces may depend on more than a word: the text itself is the unit."""

    def __init__(self, count):
        self.of = count

    def units(self, text: str) -> list[str]:
        return [text]

    def count(self, units: list[str], first: bool) -> list[int]:
        return self.of(units)


@lru_cache(maxsize=4)
def load(path: str):
    """The counter for a tokenizer file: ``.json`` (tokenizers) or ``.model`` (sentencepiece)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return WholeText(lambda texts: [len(x) for x in model.encode(texts, num_threads=1)])
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    said = json.loads(tokenizer.to_str())
    first = said["pre_tokenizer"] or {}
    by_word = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
    # Added tokens with white space, or that take it from their sides, could reach over a cut.
    reach = any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in said["added_tokens"])
    if by_word and said["normalizer"] is None and not reach:
        return ByteLevel(tokenizer)
    return WholeText(lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)])


def batch_counts(texts: list[str], model, known: dict[str, int]) -> list[int]:
    """Tokens of every text; ``known`` has the counts of pre-tokens met before."""
    totals, frequencies = [], []
    heads = [model.units(t) for t in texts]
    firsts = [u[0] for u in heads]
    for total in model.count(firsts, True) if texts else []:
        totals.append(total)
    for units in heads:
        frequencies.append(Counter(units[1:]))
    new = list({u for f in frequencies for u in f if u not in known})
    if len(known) + len(new) > KEPT:
        known.clear()
        new = list({u for f in frequencies for u in f})
    known.update(zip(new, model.count(new, False) if new else []))
    return [t + sum(n * known[u] for u, n in f.items()) for t, f in zip(totals, frequencies)]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: ``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Counts are those of the library's encoding of the whole text without added special tokens, without
    truncation or padding. Null texts count as empty (0 tokens); rows are never combined, so null and
    repeated keys keep their rows; nothing is shuffled; an empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        known: dict[str, int] = {}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = batch_counts(batch.column(1).to_pylist(), load(path), known)
            sizes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64())], names=["key", "n_bytes", "n_tokens"])

        yield from per_batch(work)(batches)

    schema = rows.select("key").schema.add("n_bytes", "long").add("n_tokens", "long")
    return rows.mapInArrow(run, schema).select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
