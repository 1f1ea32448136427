"""Toxicity by weak supervision.

Many voters look at a text: word lists, words and beginnings of words that the labelled training rows brought out, and
patterns of layout and address. All training documents are voted on, labelled or not; Spark counts how many have each pattern
of votes. A generative model says how often each voter fires given the hidden class. It is fitted to these counts by expectation
and maximization; the class of a labelled document is its label. Voters that still agree once the class is known are correlated;
each counts only by its share, one over one plus its correlations with the others. A linear classifier over hashed words and
prefixes of words is trained on labels and, for documents without one, on posterior labels, which count `unlabelled_worth` each;
it scores whole texts.

The voters are learned from all labelled training documents, the label model and the classifier from all training documents, and
every text is scored. A training text is read twice before, for the counts of its features if it has a label, and for its votes and
features; the rows of the classifier stay with the workers. There are at most 2 to the power of the voters' number of patterns; texts
that hardly any voter fires on share few of them.

Defined results: null and empty texts get the score of a text without features; without any labelled rows of both classes the
voters of the fixed lists alone decide; equal texts get equal scores; a label that occurs several times counts as its largest; of
several texts with one id all vote, and the first in order is learned from; a document without an id has no label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.features import (
    BITS,
    counted,
    feature_counts,
    first_texts,
    found_features,
    key_dims,
    linear,
    normal_words,
    places,
    repeated_ids,
    split_by_crc,
    telling_features,
)
from isobar.llm.sparse_logistic import BLOCK_ROWS, fit_logistic, pack, packed
from isobar.llm.staging import small_or_not, staged

# Words of insult, of contempt and of threat.
LISTS = {
    "insult": "idiot moron stupid dumb fool loser clown imbecile cretin dimwit jerk",
    "contempt": "worthless pathetic disgusting trash garbage scum filth vermin useless vile",
    "threat": "kill hurt destroy beat burn die hate",
}
_ADDRESS = re.compile(r"\b(?:you(?:'re| are)?|your)\s+(?:a |an |all |so |such )?\w+", re.IGNORECASE)
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")


def _patterns(texts: pa.Array) -> np.ndarray:
    """Votes of the pattern voters: second-person address, shouting, exclamations."""
    out = []
    for text in texts.to_pylist():
        n = text.count(" ") + 1
        out.append((len(_ADDRESS.findall(text)) > 0, len(_SHOUT.findall(text)) > 0.2 * n, text.count("!") > 0.2 * n))
    return np.array(out, np.float64).reshape(len(out), 3)


def list_dims(name: str) -> np.ndarray:
    """Feature numbers of the words of a fixed list."""
    return np.unique(np.concatenate([next(key_dims(w))[1] for w in normal_words(pa.array(LISTS[name].split()))]))


@dataclass
class LabelModel:
    """Chance that a voter fires, by class; the voters' shares; the chance of the class."""

    fires: np.ndarray
    share: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        p = np.clip(self.fires, 1e-4, 1 - 1e-4)
        on, off = np.log(p[1] / p[0]), np.log((1 - p[1]) / (1 - p[0]))
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (self.share * on) + (1 - votes) @ (self.share * off)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(
    votes: np.ndarray, start: np.ndarray, trusted: list[int], rounds: int = 25, count: np.ndarray | None = None, known: np.ndarray | None = None
) -> LabelModel:
    """Fits accuracies and correlations of voters (columns, 0 or 1) from a first guess of the class.

    A row stands for `count` documents. Where `known`, the guess is the class and stays. `trusted` columns keep their full
    share: annotators, whose agreement with the others is no shared rule.
    """
    belief, n = start.astype(float), votes.shape[1]
    count = np.ones(len(votes)) if count is None else count.astype(float)
    model = LabelModel(np.full((2, n), 0.5), np.ones(n), 0.5)
    for _ in range(rounds):
        weight = np.stack([1 - belief, belief]) * count
        total = weight.sum(1, keepdims=True)
        fires = (weight @ votes + 0.5) / (total + 1.0)
        left = votes - belief[:, None] * fires[1] - (1 - belief[:, None]) * fires[0]
        spread = (left * count[:, None]).T @ left / count.sum()
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        related = np.maximum(spread / scale / scale[:, None], 0)
        np.fill_diagonal(related, 0)
        related[related < 0.05] = 0
        share = 1 / (1 + related.sum(1))
        share[trusted] = 1.0
        model = LabelModel(fires, share, float(np.clip((belief * count).sum() / count.sum(), 0.01, 0.99)))
        belief = model.posterior(votes) if known is None else np.where(known, start, model.posterior(votes))
    return model


class Voters:
    """Named voters; the votes on a text are the bits of one number.

    `groups` has the features of each voter that fires on any of them, `strong` those that the counting voters count.
    """

    COUNTING = ("learned:at least 2", "learned:at least 4", "learned:often")
    PATTERNS = ("pattern:address", "pattern:shout", "pattern:exclaim")

    def __init__(self, groups: dict[str, np.ndarray], strong: np.ndarray):
        self.names = [*groups, *self.COUNTING, *self.PATTERNS]
        self.bits = np.zeros(1 << BITS, np.int64)
        for k, dims in enumerate(groups.values()):
            self.bits[dims] |= 1 << k
        self.strong = np.zeros(1 << BITS, bool)
        self.strong[strong] = True
        self.chosen = (self.bits > 0) | self.strong

    def __len__(self) -> int:
        return len(self.names)

    def votes(self, texts: pa.Array) -> np.ndarray:
        """One number per text; null is empty."""
        texts, out = texts.fill_null(""), []
        first = len(self) - len(self.COUNTING) - len(self.PATTERNS)
        for w in normal_words(texts):
            doc, dim, n = counted(w, self.chosen)
            vote = np.zeros(w.n, np.int64)
            np.bitwise_or.at(vote, doc, self.bits[dim])
            strong = self.strong[dim]
            found = np.bincount(doc, strong, minlength=w.n)
            often = np.bincount(doc, strong * np.log1p(n), minlength=w.n)
            for k, fires in enumerate((found >= 2, found >= 4, often > np.log(12))):
                vote |= fires.astype(np.int64) << (first + k)
            out.append(vote)
        vote = np.concatenate([*out, np.zeros(0, np.int64)])
        for k, fires in enumerate(_patterns(texts).astype(np.int64).T):
            vote |= fires << (first + len(self.COUNTING) + k)
        return vote

    def matrix(self, votes: np.ndarray) -> np.ndarray:
        return ((votes[:, None] >> np.arange(len(self))) & 1).astype(float)


def count_patterns(documents: DataFrame, labels: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(votes, label or -1, documents) of every pattern that occurs; `labels` has (doc_id, label), `documents` (doc_id, text)."""

    @F.arrow_udf("bigint")
    def votes(texts: pa.Array) -> pa.Array:
        return pa.array(voters.votes(texts))

    return _counted_votes(documents.select("doc_id", votes("text").alias("vote")), labels_by_id(labels))


def labels_by_id(labels: DataFrame) -> DataFrame:
    """(doc_id, label): the largest label of each id."""
    return labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))


def _counted_votes(voted: DataFrame, by_id: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    labelled = voted.select("doc_id", "vote").join(by_id, "doc_id", "left")
    counts = labelled.groupBy("vote", F.coalesce("label", F.lit(-1)).alias("label")).agg(F.count("*").alias("n"))
    found = counts.toArrow().sort_by([("vote", "ascending"), ("label", "ascending")])
    return tuple(found[c].to_numpy() for c in ("vote", "label", "n"))


def _votes_and_features(documents: DataFrame, twice: DataFrame, voters: Voters, dims: np.ndarray) -> DataFrame:
    """(doc_id, vote, found, text) of each row, written; the text only where its id has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places(dims)
        for batch in batches:
            texts = batch.column("text")
            again = pc.if_else(batch.column("again"), texts, None)
            columns = [batch.column("doc_id"), pa.array(voters.votes(texts)), pa.array(found_features(texts, place), pa.binary()), again]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "vote", "found", "text"])

    marked = documents.join(twice.withColumn("again", F.lit(True)), "doc_id", "left")
    marked = marked.select("doc_id", "text", F.coalesce("again", F.lit(False)).alias("again"))
    return staged(marked.mapInArrow(run, "doc_id long, vote long, found binary, text string"), "voted")


def _classifier_rows(voted: DataFrame, by_id: DataFrame, model: LabelModel, voters: Voters, unlabelled_worth: float) -> DataFrame:
    """Blocks of one row per training document: its features, and its label or else its posterior."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, label, vote = [], [], []

        def blocks() -> Iterator[pa.RecordBatch]:
            given, votes = np.array(label, np.int64), np.array(vote, np.int64)
            kinds, which = np.unique(votes, return_inverse=True)
            target = np.where(given >= 0, given, model.posterior(voters.matrix(kinds))[which])
            yield from pack(found, target, np.where(given >= 0, 1.0, unlabelled_worth))

        for batch in batches:
            found += batch.column("found").to_pylist()
            label += batch.column("label").to_pylist()
            vote += batch.column("vote").to_pylist()
            if len(found) >= BLOCK_ROWS:
                yield from blocks()
                found, label, vote = [], [], []
        if found:
            yield from blocks()

    first = voted.filter("text IS NOT NULL").groupBy("doc_id").agg(F.min_by(F.struct("vote", "found"), "text").alias("f"))
    rows = voted.filter("text IS NULL").select("doc_id", "vote", "found").unionByName(first.select("doc_id", "f.vote", "f.found"))
    rows = rows.join(by_id, "doc_id", "left").select("found", "vote", F.coalesce("label", F.lit(-1)).alias("label"))
    return packed(rows, run)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    voters: list[str]
    label_model: LabelModel

    def score(self, texts: pa.Array) -> pa.Array:
        parts = [linear(w, self.weights) + self.bias for w in normal_words(texts)]
        odds = np.concatenate([*parts, np.zeros(0)])
        return pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40))))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    train: Column | None = None,
    features: int = 2048,
    support: int = 4,
    voters: int = 12,
    least_errors: float = 6.0,
    ridge: float = 3e-5,
    unlabelled_worth: float = 0.05,
    text: str = "text",
    doc_id: str = "doc_id",
) -> ToxicityModel:
    """Fits voters on all labelled training documents, the label model and the classifier on all training documents.

    `train` is an expression of `doc_id`.
    """
    train = F.lit(True) if train is None else train
    bounded = F.least(F.greatest(F.col(label), F.lit(0)), F.lit(1))
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = texts.filter(train)
    marks = labels.select(F.col(doc_id).alias("doc_id"), bounded.cast("int").alias("label"))
    by_id = small_or_not(staged(labels_by_id(marks).filter(train), "labels"))
    twice = repeated_ids(training)
    labelled = first_texts(training, twice).join(by_id, "doc_id")
    counts = staged(feature_counts(labelled), "features")
    fixed = {f"list:{name}": list_dims(name) for name in LISTS}
    dims = np.unique(np.concatenate([telling_features(labelled, features, support, counts), *fixed.values()]))
    given = np.zeros(2, np.int64)
    for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect():
        given[r.label] = r.n
    groups, strong, learned = dict(fixed), np.zeros(0, np.int64), np.zeros(len(dims))
    if given.all():
        on = np.zeros((2, len(dims)))
        for r in counts.filter(F.col("dim").isin(dims.tolist())).collect():
            on[:, np.searchsorted(dims, r.dim)] = r.n - r.total, r.total
        rate = (on + 0.5) / (given + 1)[:, None]
        odds, both = np.log(rate[1] / rate[0]), np.clip(on.sum(0) / given.sum(), 1e-6, 1 - 1e-6)
        error = np.sqrt(both * (1 - both) * (1 / given).sum())
        strong = np.flatnonzero((odds > 1.5) & (rate[1] - rate[0] > least_errors * error))
        strong = strong[np.argsort(-odds[strong], kind="stable")]
        # Single features are dealt to the voters, so that each sees another part of the evidence.
        groups |= {f"learned:{k}": dims[strong[k::voters]] for k in range(voters)}
        panel = Voters(groups, dims[strong])
        voted = _votes_and_features(training, twice, panel, dims)
        vote, known, count = _counted_votes(voted, by_id)
        start = np.where(known >= 0, known, given[1] / given.sum())
        model = fit_label_model(panel.matrix(vote), start, [], count=count, known=known >= 0)
        rows = _classifier_rows(voted, by_id, model, panel, unlabelled_worth)
        learned, bias = fit_logistic(rows, len(dims), ridge)
    else:
        panel = Voters(groups, strong)
        model = LabelModel(np.full((2, len(panel)), 0.5), np.ones(len(panel)), 0.1)
        learned[np.isin(dims, np.concatenate([fixed["list:insult"], fixed["list:contempt"]]))] = 4.0
        bias = -2.2
    weights = np.zeros(1 << BITS, np.float32)
    weights[dims] = learned
    return ToxicityModel(weights, float(bias), panel.names, model)


def score_column(model: ToxicityModel, text: Column) -> Column:
    """Chance that a text is toxic."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return model.score(texts)

    return score(text)


def contract_split(doc_id: str = "doc_id") -> Column:
    return split_by_crc(F.col(doc_id), 3, 1)
