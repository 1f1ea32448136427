import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import kneser_ney, ordinal, sparse_logistic, toxicity
from isobar.llm.features import split_by_crc
from isobar.llm.queries import QUERIES
from isobar.llm.textarrays import mix

DATA = "/root/testdata/sf0.1"


def test_split_is_crc32_of_the_id_as_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 1, 2, 77, -5, 10**12)] + [(None,)], "doc_id long")
    for r in rows.select("doc_id", split_by_crc(F.col("doc_id"), 7, 2).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)


def test_toxicity_on_held_out_labels(spark):
    scored = QUERIES["op7_toxicity"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.95 and hits / sum(r.toxic for r in rows) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_label_model_finds_accuracies_and_correlations():
    draw = np.random.default_rng(2)
    y = draw.random(6000) < 0.3
    votes = [np.where(y, draw.random(6000) < a, draw.random(6000) < 1 - a) for a in (0.9, 0.8, 0.7)]
    votes += [votes[2].copy(), votes[2].copy()]
    model = toxicity.fit_label_model(np.stack(votes, 1).astype(float), votes[0], [])
    assert abs(model.prior - 0.3) < 0.08 and model.share[0] > 0.8 and max(model.share[2:]) < 0.5
    right = (model.posterior(np.stack(votes, 1).astype(float)) > 0.5) == y
    assert right.mean() > 0.85


def test_toxicity_of_awkward_rows(spark):
    df = brute.awkward(spark, [(1, "you are a stupid worthless idiot, pathetic scum"), (2, "nice day")])
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.fit_toxicity(df, empty)
    rows = df.select("doc_id", "text", toxicity.score_column(model, df.text).alias("s")).collect()
    assert len(rows) == df.count() and all(0 <= r.s <= 1 for r in rows)
    score = {r.doc_id: r.s for r in rows if r.doc_id in (1, 2)}
    assert score[1] > 0.9 and score[2] < 0.2
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (2, None, 0), (None, 1, 1), (1_000_004, 0, 0)], "doc_id long, toxic int, quality int")
    toxicity.fit_toxicity(df, labels)


def test_quality_on_held_out_labels(spark):
    rated = QUERIES["op6_ordinal_quality"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = rated.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.selected == r.quality for r in rows]) > 0.93
    assert np.mean([r.selected for r in rows if r.quality]) > 0.97
    for r in rows:
        assert 0 <= r.tail_clean <= r.tail_good <= 1 and r.expected_grade == pytest.approx(r.tail_good + r.tail_clean)


def test_cumulative_links_recover_ordered_grades():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4000, 3)).astype(np.float32)
    hidden = x @ np.array([1.5, -1.0, 0.0]) + draw.logistic(size=4000)
    grade = np.digitize(hidden, [-1.0, 0.5, 2.0])
    weights, thresholds = ordinal.fit_cumulative(x, grade, 4, 1e-4, 400)
    assert np.allclose(weights, [1.5, -1.0, 0.0], atol=0.15) and np.allclose(thresholds, [-1.0, 0.5, 2.0], atol=0.2)


def test_ratings_of_awkward_rows(spark):
    df = brute.awkward(spark, [(1, "good text here"), (2, "bad")])
    model = ordinal.fit_ordinal(df, spark.createDataFrame([], "doc_id long, g int"), F.col("g"), 3)
    rows = df.select(ordinal.rating_column(model, df.text).alias("r")).collect()
    assert all(r.r == pytest.approx([1.0, 2 / 3, 1 / 3]) for r in rows)
    some = spark.createDataFrame([(1, 2), (2, 0), (2, None), (None, 1)], "doc_id long, g int")
    model = ordinal.fit_ordinal(df, some, F.col("g"), 3, support=1)
    assert all(0 <= r.r[2] <= r.r[1] <= 1 for r in df.select(ordinal.rating_column(model, df.text).alias("r")).collect())


def discounts(counts):
    n = [0, *(sum(v == k for v in counts) for k in (1, 2, 3, 4))]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
    return [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) if n[k] and n[k + 1] else k / 2 for k in (1, 2, 3))]


def plain_model(texts):
    tokens = [[*brute.words(t), None] for t in texts]
    count = Counter(w for t in tokens for w in t)
    pair = Counter(p for t in tokens for p in zip(["begin", *t[:-1]], t, strict=True))
    follows = Counter(v for _, v in pair)
    context, total = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (u, _), c in pair.items():
        context[u][min(c, 3)] += 1
        total[u] += c
    d2, d1 = discounts(pair.values()), discounts(follows.values())
    types, n, v = sum(follows.values()), sum(count.values()), len(count)
    rest = sum(d1[min(c, 3)] for c in follows.values()) / types if types else 1

    def one(w):
        c = follows.get(w, 0)
        return max(c - d1[min(c, 3)], 0) / max(types, 1) + rest / (v + 1)

    def two(u, w):
        if u not in total:
            return one(w)
        c = pair.get((u, w), 0)
        return (max(c - d2[min(c, 3)], 0) + sum(d2[k] * context[u][k] for k in (1, 2, 3)) * one(w)) / total[u]

    def score(text):
        t = [*brute.words(text), None]
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in t)
        return len(t), sum(w in count for w in t), base, sum(math.log10(two(u, w)) for u, w in zip(["begin", *t[:-1]], t, strict=True))

    assert not texts or sum(map(one, count)) + one("unknown word") == pytest.approx(1)
    return score, n, v


@pytest.mark.parametrize("size", [0, 1, 60])
def test_language_model_equals_its_formula(spark, size):
    texts = [(r[0], r[1]) for r in brute.sample(spark, 80)]
    df = brute.awkward(spark, texts)
    train = df.filter(F.col("doc_id") < size) if size < 60 else df.filter("doc_id IS NULL OR doc_id != 3")
    model = kneser_ney.train(train, least_bits=2)
    score, n, v = plain_model([r.text for r in train.collect()])
    assert (model.n_tokens, model.n_words) == (n, v)
    rows = df.select("text", kneser_ney.score_column(model, df.text).alias("s")).select("text", "s.*").collect()
    for r in rows:
        want = score(r.text)
        assert (r.n_tokens, r.n_known) == want[:2]
        assert (r.base_score, r.score) == pytest.approx(want[2:], rel=1e-6)


def test_model_helpers():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (kneser_ney.unmix(mix(x)) == x).all()
    keys, count = np.unique(x, return_counts=True)
    back = kneser_ney.unpack(kneser_ney.pack(keys, [count * 1000]))
    assert (back[0] == keys).all() and (back[1] == count * 1000).all()
    with pytest.raises(ValueError):
        kneser_ney.local_path("hdfs://host/folder")


def test_words_of_arrow_slices():
    from isobar.llm.textarrays import PLAIN_WORDS, words

    texts = pa.array(["skip", "Ab  c\x0bd", None, "", " x\n", "é" * 3]).slice(1)
    w = list(words(texts, PLAIN_WORDS))
    assert [x.n for x in w] == [5] and w[0].counts.tolist() == [3, 0, 0, 1, 1]
    again = next(words(pa.array(["aB", "x"]), PLAIN_WORDS))
    assert again.hash[0] == w[0].hash[0] and again.hash[1] == w[0].hash[3]


def test_label_model_on_counts_equals_single_documents():
    """Patterns with counts and known classes give what one row per document gives, by plain expectation and maximization."""
    draw = np.random.default_rng(5)
    y = draw.random(3000) < 0.25
    votes = np.stack([np.where(y, draw.random(3000) < a, draw.random(3000) < b) for a, b in ((0.9, 0.1), (0.8, 0.05), (0.6, 0.3))], 1).astype(float)
    known = draw.random(3000) < 0.4
    start = np.where(known, y, 0.3).astype(float)
    rows, back, count = np.unique(np.column_stack((votes, start, known)), axis=0, return_inverse=True, return_counts=True)
    packed = toxicity.fit_label_model(rows[:, :3], rows[:, 3], [], count=count, known=rows[:, 4] > 0)
    belief, prior = start.copy(), 0.5
    for _ in range(25):
        fires = [[(w @ votes[:, k] + 0.5) / (w.sum() + 1) for k in range(3)] for w in (1 - belief, belief)]
        prior = belief.mean()
        left = votes - np.outer(belief, fires[1]) - np.outer(1 - belief, fires[0])
        spread = left.T @ left
        related = spread / np.sqrt(np.outer(np.diag(spread), np.diag(spread)))
        related = np.where(related < 0.05, 0, related) - np.diag(np.diag(related))
        share = 1 / (1 + np.maximum(related, 0).sum(1))
        odds = math.log(prior / (1 - prior)) + sum(
            share[k] * np.where(votes[:, k] > 0, math.log(fires[1][k] / fires[0][k]), math.log((1 - fires[1][k]) / (1 - fires[0][k]))) for k in range(3)
        )
        belief = np.where(known, start, 1 / (1 + np.exp(-odds)))
    assert np.allclose(packed.fires, fires, atol=1e-6) and np.allclose(packed.share, share, atol=1e-6) and packed.prior == pytest.approx(prior, abs=1e-6)
    assert np.allclose(packed.posterior(votes)[~known], belief[~known], atol=1e-6)
    assert ((belief > 0.5) == y).mean() > 0.93


def test_votes_of_all_documents_are_counted(spark):
    """Patterns over labelled and unlabelled documents, against a loop over the texts."""
    groups = {f"list:{n}": toxicity.list_dims(n) for n in toxicity.LISTS}
    panel = toxicity.Voters(groups, groups["list:insult"])
    texts = ["you idiot", "You are a MORON!! idiot, stupid", "kill the filth", "a nice day", "", None, "IDIOT SHOUT LOUD NOW", "clown " * 400]
    df = spark.createDataFrame([(i % 6 if i < 12 else None, texts[i % 8]) for i in range(16)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (3, 0), (None, 1)], "doc_id long, label int")
    vote, label, n = toxicity.count_patterns(df, labels, panel)
    want = Counter()
    for r in df.collect():
        words = set(brute.normal(r.text))
        bits = [bool(words & set(toxicity.LISTS[k].split())) for k in toxicity.LISTS]
        times = [brute.normal(r.text).count(x) for x in toxicity.LISTS["insult"].split()]
        found = sum(t > 0 for t in times)
        bits += [found >= 2, found >= 4, sum(map(math.log1p, times)) > math.log(12)]
        bits += toxicity._patterns(pa.array([r.text or ""]))[0].astype(bool).tolist()
        want[sum(b << k for k, b in enumerate(bits)), {0: 1, 3: 0}.get(r.doc_id, -1)] += 1
    assert {(v, k): c for v, k, c in zip(vote.tolist(), label.tolist(), n.tolist(), strict=True)} == dict(want)
    assert panel.matrix(vote).shape == (len(vote), len(panel))


def test_toxicity_is_learned_from_every_labelled_row(spark):
    """A toxic word of few documents, which come last of 9,000 in the order of a hash of the id."""
    ids = spark.range(9000).orderBy(F.xxhash64(F.lit(7), "id"), "id").collect()
    rows = [(r.id, f"plain text number {k % 7}" + " zorpy" * (k >= 8960), int(k >= 8960)) for k, r in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    clean, toxic = model.score(pa.array(["plain text number 3", "plain text number 3 zorpy"])).to_pylist()
    assert clean < 0.1 and toxic > 0.9


def test_classifier_has_a_row_of_every_training_document(spark):
    """One of each id, of the first text in order; documents without an id or a label count by their posterior."""
    groups = {f"list:{n}": toxicity.list_dims(n) for n in toxicity.LISTS}
    panel, dims = toxicity.Voters(groups, groups["list:insult"]), np.unique(np.concatenate(list(groups.values())))
    rows = [(1, "you idiot idiot"), (1, "a nice day"), (2, "kill the filth"), (3, ""), (None, "clown"), (None, "clown"), (4, "scum scum")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by_id = toxicity.labels_by_id(spark.createDataFrame([(1, 1), (1, 0), (2, 0), (9, 1)], "doc_id long, label int"))
    voted = toxicity._votes_and_features(df, toxicity.repeated_ids(df), panel, dims)
    model = toxicity.LabelModel(np.full((2, len(panel)), 0.5), np.ones(len(panel)), 0.3)
    blocks = toxicity._classifier_rows(voted, by_id, model, panel, 0.05)
    found = []
    for start, place, value, target, worth in sparse_logistic._blocks(iter(blocks.toArrow().to_batches())):
        for k in range(len(target)):
            own = slice(start[k], start[k + 1])
            found.append((round(target[k], 6), worth[k], len(place[own]), round(float(value[own].sum()), 3)))
    n = {w: len({d for _, dim in toxicity.key_dims(next(toxicity.normal_words(pa.array([w])))) for d in dim} & set(dims.tolist())) for w in ("clown", "kill", "filth", "scum")}
    one, two = math.log(2), math.log(3)
    want = [(1, 1.0, 0, 0.0), (0, 1.0, n["kill"] + n["filth"], round((n["kill"] + n["filth"]) * one, 3)), (0.3, 0.05, 0, 0.0)]
    want += [(0.3, 0.05, n["clown"], round(n["clown"] * one, 3))] * 2 + [(0.3, 0.05, n["scum"], round(n["scum"] * two, 3))]
    assert sorted(found) == sorted(want)


def test_sparse_logistic_equals_newton(spark):
    """Rows in many blocks and tasks, against Newton steps on the whole matrix."""
    draw = np.random.default_rng(3)
    count = draw.integers(0, 3, (600, 12)) * (draw.random((600, 12)) < 0.5)
    x, worth = np.log1p(count), draw.choice([1.0, 0.05], 600)
    target = 1 / (1 + np.exp(-(x @ draw.normal(size=12) * 2 - 0.5)))
    found = [np.column_stack((np.flatnonzero(c), c[c > 0])).astype(np.int32).tobytes() for c in count]
    df = spark.createDataFrame([(f, float(t), float(w)) for f, t, w in zip(found, target, worth, strict=True)], "found binary, target double, worth double")

    def run(batches):
        for b in batches:
            yield from sparse_logistic.pack(b.column(0).to_pylist(), b.column(1).to_numpy(), b.column(2).to_numpy())

    blocks = sparse_logistic.packed(df.repartition(7), run)
    weight, bias = sparse_logistic.fit_logistic(blocks, 12, 1e-3, left=1e-9)
    both, want, ridge = np.column_stack((x, np.ones(600))), np.zeros(13), np.diag([1e-3] * 12 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-both @ want))
        slope = both.T @ (worth * (p - target)) / worth.sum() + ridge @ want
        want -= np.linalg.solve((both * (worth * p * (1 - p))[:, None]).T @ both / worth.sum() + ridge, slope)
    assert np.allclose([*weight, bias], want, atol=1e-3)
    assert sparse_logistic.fit_logistic(blocks.limit(0), 12, 1e-3)[1] == 0
