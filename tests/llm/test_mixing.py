import brute
import numpy as np
import pytest

from isobar.llm.mixing import mix, shard_rows, split_quotas


def level(sizes, weights, share=1.5, limit=2.0):
    """Targets by raising a common level until the shares are spent."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, held = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in held)
        free = [s for s in order if s not in held]
        target = {s: limit * sizes[s] if s in held else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > limit * sizes[s]}
        if not over:
            return target
        held |= over


def test_contract(spark):
    rows = [(r[0], r[1], r[3]) for r in brute.sample(spark, 200)]
    rows += [(None, None, None), (7000, "a b\x0bc", None), (7000, "a b\x0bc", None), (7001, "", "é"), (7002, "w " * 40, "Z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.selectExpr("*", "1 AS size", "2 AS target", "3 AS row", "4 AS block")
    got = mix(df, block_words=6000, blocks_per_shard=4).collect()
    again = mix(df, block_words=6000, blocks_per_shard=4).collect()
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.taken, tuple(r.shards))
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.WORD.findall(text or ""))
    want = level(sizes, (3, 1, 2))
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.size * len(r.shards) and len(r.shards) <= 2 and (r.size or not r.shards)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, target in want.items():
        times = int(target // max(sizes[s], 1))
        drawn = [r.size for r in got if r.source == s and len(r.shards) > times]
        left = [r.size for r in got if r.source == s and r.size and len(r.shards) == times]
        # The last document drawn, or the smallest that is left, would not bring it nearer.
        assert abs(target - taken[s]) <= max([*left[:1], *drawn, 0]) / 2 + 1e-6 or abs(target - taken[s]) <= min(left) / 2 + 1e-6


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(0, 37), (1, 5), (2, 0), (3, 200)], "number long, quota long")
    rows = split_quotas(quotas, 21, 3).collect()
    by_shard, by_source = {}, {}
    for r in rows:
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.quota
        by_source.setdefault(r.number, []).append((r.shard, r.first, r.quota))
    assert set(by_shard) == set(range(21)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for number, quota in ((0, 37), (1, 5), (3, 200)):
        at = 0
        for _, first, n in sorted(by_source[number]):
            assert first == at
            at += n
        assert at == quota


def test_tree_is_not_biased(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 40)], "number long, quota long")
    counts = [[r.quota for r in split_quotas(quotas, 2, seed).filter("number = 0 AND shard = 0").collect()] for seed in range(12)]
    mean = np.mean([c[0] if c else 0 for c in counts])
    assert 17 < mean < 23


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_shards_are_shuffled_inside(spark):
    """Places tell nothing about blocks, and the sources of a shard lie mixed."""
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(6000)]
    mixed = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=500, blocks_per_shard=200)
    spot = {r.doc_id: r.spot for r in mixed.collect()}
    shards = {}
    for r in shard_rows(mixed, 4).collect():
        shards.setdefault(r.shard, []).append((r.place, r.doc_id, r.source))
    assert len(shards) > 1 and sum(map(len, shards.values())) == sum(len(r.shards) for r in mixed.collect())
    for copies in shards.values():
        assert copies == sorted(copies)
        assert abs(np.corrcoef(np.arange(len(copies)), [spot[d] for _, d, _ in copies])[0, 1]) < 0.1
        half = len(copies) // 2
        for source in ("s0", "s1", "s2"):
            first = sum(s == source for *_, s in copies[:half])
            both = sum(s == source for *_, s in copies)
            assert abs(first - both / 2) < 5 * (both / 4) ** 0.5 + 1


def test_many_equal_rows(spark):
    rows = [(1, "same text here", "a")] * 3000 + [(2 + i, "other words in it", "b") for i in range(300)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=100, blocks_per_shard=8).collect()
    assert len(got) == 3300 and all(len(r.shards) == len(r.places) <= 2 for r in got)
    for source, target in {(r.source, r.target) for r in got}:
        assert abs(sum(r.taken for r in got if r.source == source) - target) <= 4
