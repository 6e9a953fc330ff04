from collections import defaultdict

import pytest

from tidewright.llm import mixing, queries


def plain_targets(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    wanted, stopped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        if not free:
            return stopped
        level = (wanted - sum(stopped.values())) / sum(weight[s] for s in free)
        above = {s: 2.0 * sizes[s] for s in free if level * weight[s] >= 2 * sizes[s]}
        if not above:
            return stopped | {s: level * weight[s] for s in free}
        stopped |= above


def check(got, given):
    sizes, largest, taken, count = defaultdict(int), defaultdict(int), defaultdict(int), len(given)
    import re

    for _, text, _, source, _ in given:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want = plain_targets(sizes)
    assert len(got) == count
    by_key = defaultdict(list)
    for key, text, _, source, _ in given:
        by_key[key].append((len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), source))
    for r in got:
        assert any(r.size == n and r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for n, s in by_key[r.doc_id])
        assert r.taken in (0, r.size, 2 * r.size)
        source = next(s for n, s in by_key[r.doc_id] if n == r.size)
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_targets_and_quotas(spark, write, awkward, clashing, empty):
    from tests.llm.conftest import awkward_rows

    for docs, given in ((awkward, awkward_rows()), (clashing, awkward_rows()), (empty, [])):
        folder = write(documents=docs)
        got = queries.op1_mixing(spark, folder).collect()
        check(got, given)
        again = queries.op1_mixing(spark, write(documents=docs.repartition(7))).collect()
        assert sorted(got, key=repr) == sorted(again, key=repr)


def test_whole_sample_is_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    check(queries.op1_mixing(spark, "/root/testdata/sf0.001").collect(), given)


def test_tree_hands_out_every_block_once(spark):
    quotas = {"a": 700, "b": 33, "c": 1, None: 250}
    frame = spark.createDataFrame(list(quotas.items()), "source string, blocks long")
    leaves = mixing.split_quotas(frame, 8).collect()
    per_shard = defaultdict(int)
    for source, n in quotas.items():
        runs = sorted((r.first, r.last) for r in leaves if r.source == source)
        assert runs[0][0] == 0 and runs[-1][1] == n
        assert all(x[1] == y[0] for x, y in zip(runs, runs[1:]))
    for r in leaves:
        per_shard[r.shard] += r.last - r.first
    assert max(per_shard.values()) - min(per_shard.values()) <= 3


def test_shards_mix_like_the_whole(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "'w w w' text", "if(id % 4 = 0, 'a', 'b') source")
    plan = mixing.mix_sources(docs, weights=(1, 1), share=1.0, shards=4)
    seen = defaultdict(lambda: defaultdict(int))
    for r in plan.selectExpr("source", "explode(draws) d").selectExpr("source", "d.shard shard").collect():
        seen[r.shard][r.source] += 1
    assert set(seen) == {0, 1, 2, 3}
    assert all(abs(v["a"] - 500) < 120 and abs(v["b"] - 500) < 120 for v in seen.values())
