import random
from itertools import combinations

import brute
import numpy as np
import pyarrow as pa

from isobar.llm.spaced_seeds import MASKS, index_items, overlaps, short_runs, with_hits, without_overlaps
from isobar.llm.textarrays import NORMAL_WORDS, words


def best(text, item, overlap=13, same=0.8):
    """Whether some alignment has a stretch of `overlap` tokens that agrees well enough."""
    t, w = brute.normal(text), brute.normal(item)
    n = min(overlap, len(w))
    for shift in range(-len(w) + 1, len(t)):
        equal = [0 <= shift + k < len(t) and t[shift + k] == w[k] for k in range(len(w))]
        if any(sum(equal[k : k + n]) >= same * n - 1e-9 for k in range(len(w) - n + 1)):
            return True
    return False


def test_equals_brute_force(spark):
    items = [(r[0], r[1]) for r in brute.sample(spark, 12, "benchmark")] + [(500, None), (501, ""), (502, "two words"), (503, "six tokens are in this item"), (None, "no id item with eight words in it today")]
    draw, texts = random.Random(3), [(r[0], r[1]) for r in brute.sample(spark, 25)]
    filler = [w for _, t in texts[:5] for w in t.split()]
    for k in range(60):
        w = (items[k % 12][1]).split()
        for _ in range(k % 7):
            w[draw.randrange(len(w))] = f"swap{draw.randrange(999)}"
        a, b = draw.randrange(len(filler) - 20), draw.randrange(len(w))
        if k % 3 == 0:
            w = w[b // 2 :]
        if k % 5 == 0:
            w = "six tokens are in that item".split() if k % 2 else "here are two words".split()
        texts.append((9000 + k, " ".join([*filler[a : a + 9], *w, *filler[a + 9 : a + 15]]).upper() if k % 2 else " ".join(w)))
    df = brute.awkward(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = with_hits(df, bench, name="found").select("doc_id", "text", "found").collect()
    assert len(got) == df.count()
    checked = 0
    for r in got:
        if r.text and len(r.text) < 4000:
            hit = {h.item for h in r.found}
            for i, t in items:
                if t:
                    want = best(r.text, t)
                    assert (i in hit) == want, (r.doc_id, i)
                    checked += want
    assert checked > 30
    assert not any(r.found for r in got if not r.text)


def test_blocks_give_the_same(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    key = lambda df: sorted((r.doc_id, h.item, h.start, h.end) for r in df.collect() for h in r.hits)
    whole = key(with_hits(docs, bench))
    assert whole and whole == key(with_hits(docs, bench, block_tokens=400))


def test_places_and_recall_with_replaced_tokens():
    draw = random.Random(8)
    item = [f"t{k}" for k in range(40)]
    index = index_items([1], pa.array([" ".join(item)]), MASKS)
    found = 0
    for _ in range(200):
        text = list(item)
        for k in draw.sample(range(40), 4):
            text[k] = "other"
        w = next(words(pa.array(["é é " + " ".join(text)]), NORMAL_WORDS))
        found += len(overlaps(w, index, 13, 0.8)) > 0
    assert found >= 195


def test_empty_tables_and_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    df = brute.awkward(spark, [(1, "some text")])
    clean = without_overlaps(df, bench)
    assert clean.columns == df.columns and clean.count() == df.count()
    assert with_hits(df.limit(0), spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string"), name="x").count() == 0
    assert np.all([len(m.replace("0", "")) == 6 for m in MASKS])


def test_no_allowed_replacement_hides_an_item():
    """Every set of replaced tokens that the rule accepts, for items of 1 to 14 tokens."""
    for n in range(1, 15):
        item = [f"t{k}" for k in range(n)]
        index = index_items([1], pa.array([" ".join(item)]), MASKS)
        window = min(n, 13)
        for gone in combinations(range(n), window - int(np.ceil(0.8 * window - 1e-9))):
            text = " ".join("other" if k in gone else t for k, t in enumerate(item))
            w = next(words(pa.array([f"a b {text} c d"]), NORMAL_WORDS))
            assert len(overlaps(w, index, 13, 0.8)), (n, gone)


def test_runs_of_short_items():
    assert [short_runs(n, 0.8) for n in (1, 4, 5, 12)] == [[(0, 1)], [(0, 4)], [(0, 2), (2, 3)], [(0, 4), (4, 4), (8, 4)]]


def test_repeated_seeds():
    """All places of a seed count: the passage repeats itself, and only its second half is in the text."""
    item = "x y z u v w " * 6 + "one two three four five six seven eight nine ten eleven"
    index = index_items([1], pa.array([item]), MASKS)
    w = next(words(pa.array(["begin " + " ".join(item.split()[24:])]), NORMAL_WORDS))
    rows = overlaps(w, index, 13, 0.8)
    assert max(rows[:, 4]) == 23
    long = next(words(pa.array(["a " * 20_000]), NORMAL_WORDS))
    assert len(overlaps(long, index_items([1], pa.array(["a " * 300]), MASKS), 13, 0.8)) > 19_000


def test_clashing_column(spark):
    df = spark.createDataFrame([(1, "some words", "old")], "doc_id long, text string, hits string")
    assert with_hits(df, spark.createDataFrame([(1, "words")], "item_id long, text string")).first().hits[0].item == 1
