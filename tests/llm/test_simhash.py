import itertools
import re

import numpy as np
import pytest
import xxhash

from tidewright.llm import simhash
from tidewright.llm.graph import components
from tests.llm.brute import roots


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = [plain_fingerprint(text) for _, text, *_ in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    root = roots(range(len(rows)), near)
    out = []
    for i, (key, *_) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((key, f"{prints[i]:016x}", min(keys, default=None)))
    return sorted(out, key=repr)


def test_near_duplicates_match_all_pairs(awkward, clashing, empty, rows):
    from tests.llm.conftest import awkward_rows

    want = expected(awkward_rows())
    assert rows(simhash.near_duplicates(awkward)) == want
    assert rows(simhash.near_duplicates(clashing)) == want
    assert rows(simhash.near_duplicates(empty)) == []


def test_masks_cover_every_pair_within_the_radius():
    for positions in (np.arange(64), np.arange(3, 60, 2)):
        masks = [int(m) for m in simhash.covering_masks(positions)]
        assert len(masks) == 7
        for a, b in itertools.combinations(positions.tolist(), 2):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


@pytest.mark.parametrize("bucket", [2, 2000])
def test_links_of_crowded_buckets(spark, bucket):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, size=5, dtype=np.uint64)
    prints = {int(b) ^ sum(1 << int(x) for x in draw.choice(64, size=draw.integers(0, 5), replace=False)) for b in base for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), bucket=bucket)
    got = {r.node: r.root for r in components(links).collect()}
    near = [(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    want = roots(signed, near)
    assert {p: got.get(p, p) for p in signed} == want


def test_components_of_chains_and_repeats(spark):
    chain = [(i, i + 1) for i in range(40)] + [(0, 1), (7, 7), (None, 3), (100, 90), (95, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
