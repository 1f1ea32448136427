import itertools
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import lsh_forest
from isobar.llm.components import components
from isobar.llm.lsh_forest import NARROW, _shared_paths, chance, jaccard_groups, measured_recall, one_per_group, similar_classes


def groups_of(rows):
    """Smallest id of each text's group, its links, and one text that stands for the group; by comparing all pairs."""
    sets = {t: frozenset(brute.shingles(t)) for _, t in rows}
    texts = sorted(sets)
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    links = {t: 0 for t in texts}
    by_set = {}
    for t in texts:
        if sets[t]:
            parent[find(t)] = find(by_set.setdefault(sets[t], t))
    seen = list(by_set.items())
    for (s, a), (z, b) in itertools.combinations(seen, 2):
        if len(s & z) >= 0.8 * len(s | z):
            parent[find(a)] = find(b)
            links[a] += 1
            links[b] += 1
    least = {}
    for i, t in rows:
        if i is not None:
            root = find(t)
            least[root] = min(i, least.get(root, i))
    return {t: least.get(find(t)) for t in texts}, {t: links[by_set[sets[t]]] if sets[t] else 0 for t in texts}, {t: find(t) for t in texts}


def near_copies(words, number, edits, seed):
    draw = random.Random(seed)
    base = [f"w{seed}x{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(number):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"e{draw.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


def test_equals_all_pairs(spark):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 200)]
    for k, t in enumerate(near_copies(150, 12, 4, 1) + near_copies(80, 9, 3, 2) + ["short one", "Short, one!", "a b c"]):
        texts.append((5000 + k, t))
    df = brute.awkward(spark, texts)
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    want, links, _ = groups_of(rows)
    keys = df.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS t1").collect()
    text_of = {r.t1: r.text for r in keys}
    got = jaccard_groups(df, block=5).collect()
    assert len(got) == len(rows)
    for r in got:
        text = text_of[r.t1]
        assert r.group_id == want[text], (r, text[:60])
        assert r.n_links == links[text]


@pytest.mark.parametrize("pivots", [1, 3])
def test_crowded_buckets_lose_no_group(spark, pivots):
    rows = []
    for seed in range(4):
        rows += near_copies(120, 60, 5, 10 + seed)
    # A chain: each is near the next one only.
    base = [f"c{k}" for k in range(400)]
    rows += [" ".join(base[k * 6 : k * 6 + 120]) for k in range(20)]
    rows = [(k, t) for k, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _, _ = groups_of(rows)
    got = {r.doc_id: r.group_id for r in jaccard_groups(df, block=7, crowd=25, pivots=pivots, trees=24).collect()}
    wrong = [i for i, t in rows if got[i] != want[t]]
    assert not wrong


def test_crowded_buckets_count_all_links(spark):
    texts = list(dict.fromkeys(near_copies(120, 90, 4, 21) + near_copies(90, 40, 3, 22)))
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, links, _ = groups_of(rows)
    # So many trees that no link is missed; block and crowd only deal out the work.
    for block, crowd in ((384, 2048), (7, 25)):
        got = {r.doc_id: r.n_links for r in jaccard_groups(df, block=block, crowd=crowd, trees=48).collect()}
        assert got == {k: links[t] for k, t in rows}
    assert max(links.values()) > 25


@pytest.mark.parametrize("pivots", [1, 3])
def test_one_per_group_of_crowded_buckets(spark, pivots):
    texts = near_copies(120, 60, 5, 31) + near_copies(120, 60, 5, 32)
    rows = [(k, t) for k, t in enumerate(texts)]
    want, _, _ = groups_of(rows)
    kept = one_per_group(spark.createDataFrame(rows, "doc_id long, text string"), block=7, crowd=25, pivots=pivots, trees=24)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_rounds_of_a_crowd_that_hardly_links(spark, monkeypatch):
    """Copies with so many edits that few are linked: a round takes little from a node, and there are few rounds all the same."""
    texts = near_copies(120, 90, 9, 41) + near_copies(120, 60, 3, 42)
    rows = [(k, t) for k, t in enumerate(texts)]
    want, _, _ = groups_of(rows)
    assert len(set(want.values())) > 20
    begun, staged = [], lsh_forest.staged
    monkeypatch.setattr(lsh_forest, "staged", lambda df, name="stage": begun.append(name) or staged(df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = one_per_group(df, block=7, crowd=10, pivots=1, depth=3, shortest=2, recall=1.0, trees=48)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    # At most two depths, of nodes of at most 150 classes.
    assert 1 <= begun.count("pivots") <= 2 * 4


def test_links_are_exact_similarities(spark):
    rows = [(k, t) for k, t in enumerate(near_copies(60, 10, 3, 5))]
    documents, links, _, _ = similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    of = {r.cid: r.doc_id for r in documents.collect()}
    sets = {i: brute.shingles(t) for i, t in rows}
    found = {(of[r.a], of[r.b]): r.similarity for r in links.collect()}
    assert found
    for (a, b), s in found.items():
        assert s == pytest.approx(len(sets[a] & sets[b]) / len(sets[a] | sets[b])) and s >= 0.8 - 1e-9


def test_one_per_group(spark):
    texts = [(k, t) for k, t in enumerate(near_copies(100, 6, 2, 3))] + [(100, "x y z"), (101, "x y z"), (7, None), (8, None)]
    df = brute.awkward(spark, texts)
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    _, _, root = groups_of(rows)
    kept = one_per_group(df)
    assert kept.columns == df.columns
    out = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(root[t] for _, t in out) == sorted(set(root.values()))
    for i, t in out:
        ids = [j for j, u in rows if root[u] == root[t] and j is not None]
        assert i == (min(ids) if ids else None)


def test_recall_is_told_from_links():
    none = np.zeros(NARROW)
    # Without links the threshold itself counts.
    assert measured_recall(none, 0.8, 8, 16) == pytest.approx(chance(0.8, 8, 16))
    low, high = none.copy(), none.copy()
    low[0], high[-1] = 1e6, 1e6
    assert measured_recall(low, 0.8, 6, 16) == pytest.approx(chance(0.8, 6, 16), abs=1e-6)
    # The worst band decides, not the mean.
    assert measured_recall(low + 100 * high, 0.8, 6, 16) == pytest.approx(chance(0.8, 6, 16), abs=1e-6)
    assert measured_recall(low, 0.8, 5, 16) > measured_recall(low, 0.8, 6, 16)


def test_paths_of_shared_nodes():
    draw = np.random.default_rng(6)
    rows = sorted((int(t), draw.integers(0, 3, 4).astype(">u4").tobytes(), k) for k, t in enumerate(draw.integers(0, 3, 120)))
    batches = [rows[:1], rows[1:2], [], rows[2:50], rows[50:]]
    names = {"tree": pa.int32(), "path": pa.binary(), "cid": pa.int64()}
    packed = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*b), names.values())], list(names)) for b in batches if b]
    for shortest in (2, 3, 4):
        got = [r["cid"] for b in _shared_paths(4, shortest)(iter(packed)) for r in b.to_pylist()]
        of = lambda r: (r[0], r[1][: 4 * shortest])
        want = [r[2] for k, r in enumerate(rows) if sum(of(r) == of(x) for x in rows) > 1 or k in (0, len(rows) - 1)]
        assert got == want


@pytest.mark.parametrize("words, edits, deeper", [(300, 1, True), (90, 8, False)])
def test_the_walk_ends_where_the_links_let_it(spark, words, edits, deeper):
    """Links far above the threshold need no short prefixes; links near it do."""
    texts = [t for seed in range(8) for t in near_copies(words, 20, edits, 60 + seed)]
    rows = [(k, t) for k, t in enumerate(dict.fromkeys(texts))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_groups(df).collect()
    _, links, _ = groups_of(rows)
    found, there = sum(r.n_links for r in got), sum(links[t] for _, t in rows)
    assert got[0].measured_recall >= 0.998 and found >= 0.995 * there
    assert (got[0].matched_depth > 6) == deeper


def test_recall_against_brute_force(spark):
    """Every document whose id is divisible by 100 against all rows: the links of all sets by an exact search."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: frozenset(brute.shingles(r.text or "")) for r in docs.collect()}
    class_of = {}
    for i in sorted(sets):
        class_of.setdefault(sets[i], i)
    holders = {}
    for s in class_of:
        for g in s:
            holders.setdefault(g, []).append(s)
    want = {}
    for i in sets:
        if i % 100 == 0 and sets[i]:
            near = {z for g in sets[i] for z in holders[g] if z != sets[i]}
            want[i] = sum(len(sets[i] & z) >= 0.8 * len(sets[i] | z) for z in near)
    got = {r.doc_id: r.n_links for r in jaccard_groups(docs).filter("doc_id % 100 = 0").collect()}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got[i] for i in want) >= 0.99 * sum(want.values())


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(64)]
    parent = {v: v for e in edges for v in e}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {v for v in parent if all(a == b for a, b in edges if v in (a, b))}
    assert got == {v: find(v) for v in parent if v not in alone}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_groups(empty).count() == 0 and one_per_group(empty).count() == 0
