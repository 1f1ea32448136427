"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Spark counts the model. Each task counts its words, then its pairs of neighbouring words, and sends them as packed sorted runs
to shards of the hash space; each shard is merged by one task and written to the shared folder as a sorted array of hashes
beside its counts. Contexts and continuations are summed the same way. Workers map these files into memory and look up whole
batches of sorted keys, so that no model is ever held, collected or broadcast; shards grow in number with the corpus.

Words are runs without white space, A-Z in lower case; every text is followed by one end token, and starts from a begin
context. Unknown words share the last part of the unigram interpolation evenly with all words. Discounts are those of the
closed form from the counts of counts; where a count of counts is 0 they fall back to half the count.

The shared folder has to be a mounted path. The number of distinct words has to be below 2^32.

Defined results: null and empty texts are one end token; rows without an id are counted for training; an empty training set
gives every token an even chance; equal rows count each.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import staged
from isobar.llm.textarrays import PLAIN_WORDS, Words, mix, words
from isobar.session import shared_folder

_U = np.uint64
END = _U(0x00656E64)
BUFFER = 4_000_000


def unmix(x: np.ndarray) -> np.ndarray:
    """The number that `mix` made x of."""
    x = x.astype(np.uint64, copy=True)
    x ^= (x >> _U(31)) ^ (x >> _U(62))
    x *= _U(pow(0x94D049BB133111EB, -1, 1 << 64))
    x ^= (x >> _U(27)) ^ (x >> _U(54))
    x *= _U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x ^= (x >> _U(30)) ^ (x >> _U(60))
    return x


def local_path(folder: str) -> str:
    """The mounted path of a folder."""
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"workers map the model into memory and need a mounted folder, not {folder}")
    return path


# Packed runs: sorted keys as differences, and columns of counts, by bytes of one significance.


def pack(keys: np.ndarray, columns: list[np.ndarray]) -> bytes:
    parts = [np.array([len(keys), 1 + len(columns)], np.int64).tobytes()]
    for values in (np.diff(keys, prepend=_U(0)), *columns):
        values = values.astype(np.uint64)
        wide = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
        parts.append(bytes([wide]))
        parts += [((values >> _U(8 * k)) & _U(255)).astype(np.uint8).tobytes() for k in range(wide)]
    return b"".join(parts)


def unpack(raw: bytes) -> list[np.ndarray]:
    n, count = np.frombuffer(raw, np.int64, 2)
    at, out = 16, []
    for _ in range(count):
        values = np.zeros(n, np.uint64)
        for k in range(raw[at]):
            values |= np.frombuffer(raw, np.uint8, n, at + 1 + k * n).astype(np.uint64) << _U(8 * k)
        at += 1 + raw[at] * int(n)
        out.append(values)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def merge(runs: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One sorted run of distinct keys; the columns of equal keys are added."""
    keys = np.concatenate([r[0] for r in runs])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    rest = [np.concatenate([r[k] for r in runs])[order] for k in range(1, len(runs[0]))]
    return [keys[first], *(np.add.reduceat(x, first) if len(first) else x for x in rest)]


def _shards(run: list[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The packed parts of a sorted run; `edges` are the first keys of the shards."""
    cut = np.append(np.searchsorted(run[0], edges), len(run[0]))
    some = np.flatnonzero(np.diff(cut))
    if len(some):
        parts = [pack(run[0][cut[k] : cut[k + 1]], [c[cut[k] : cut[k + 1]] for c in run[1:]]) for k in some]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(parts, pa.binary())], ["shard", "run"])


def _hash_edges(bits: int) -> np.ndarray:
    return np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits) if bits else np.zeros(1, np.uint64)


def _counted(found: Iterator[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the numbers found, in packed runs of a bounded buffer."""
    held, size = [], 0
    for values in found:
        held.append(values)
        size += len(values)
        if size >= BUFFER:
            yield from _shards([x.astype(np.uint64) for x in np.unique(np.concatenate(held), return_counts=True)], edges)
            held, size = [], 0
    if size:
        yield from _shards([x.astype(np.uint64) for x in np.unique(np.concatenate(held), return_counts=True)], edges)


def with_ends(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, its text): the words of each text and one end."""
    ends = w.doc_start[1:]
    return np.insert(w.hash, ends, END), np.insert(w.doc, ends, np.arange(w.n))


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """Puts a file in place at once, so that a repeated task does no harm."""
    os.makedirs(folder, exist_ok=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    values.tofile(temporary)
    os.replace(temporary, f"{folder}/{name}")


@dataclass
class Arrays:
    """Sorted keys and columns of the shards of a folder, mapped into memory when they are first asked for."""

    folder: str
    bits: int
    sizes: dict[int, int]
    columns: dict[str, str]
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    def shard(self, k: int) -> dict[str, np.ndarray]:
        if k not in self._open:
            self._open[k] = {
                name: np.memmap(f"{self.folder}/{k}.{name}", kind, "r", shape=(self.sizes[k],)) for name, kind in self.columns.items()
            }
        return self._open[k]

    def find(self, keys: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(shard, place, columns) of sorted keys; place is -1 and columns are 0 for those not held."""
        cut = np.append(np.searchsorted(keys, _hash_edges(self.bits)), len(keys))
        shard, place = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int64)
        out = [np.zeros(len(keys), self.columns[name]) for name in names]
        for k in np.flatnonzero(np.diff(cut)):
            shard[cut[k] : cut[k + 1]] = k
            if not self.sizes.get(int(k)):
                continue
            held, own = self.shard(int(k)), keys[cut[k] : cut[k + 1]]
            at = np.minimum(np.searchsorted(held["key"], own), self.sizes[int(k)] - 1)
            hit = np.flatnonzero(held["key"][at] == own)
            place[cut[k] + hit] = at[hit]
            for values, name in zip(out, names, strict=True):
                values[cut[k] + hit] = held[name][at[hit]]
        return shard, place, out


@dataclass
class BigramModel:
    """Files of the model, and its few numbers."""

    words: Arrays
    base: np.ndarray
    n_words: int
    n_tokens: int
    once: Arrays | None = None
    more: Arrays | None = None
    n_texts: int = 0
    discount: np.ndarray = field(default_factory=lambda: np.zeros(4))
    start_counts: np.ndarray = field(default_factory=lambda: np.zeros(3))
    unigram_discount: np.ndarray = field(default_factory=lambda: np.zeros(4))
    n_types: int = 0
    unigram_rest: float = 1.0

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes' id or -1, their count, place of each hash among the distinct ones)."""
        distinct, back = np.unique(hashes, return_inverse=True)
        shard, place, (count,) = self.words.find(distinct, ["count"])
        return np.where(place >= 0, self.base[shard] + place, -1), count, back

    def pairs(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each token: its text, whether it is known, its count, its id and the id of the word before it."""
        hashes, doc = with_ends(w)
        number, count, back = self.ids(hashes)
        number, count = number[back], count[back]
        before = np.full(len(number), self.n_words, np.int64)
        before[1:][doc[1:] == doc[:-1]] = number[:-1][doc[1:] == doc[:-1]]
        return doc, number >= 0, count, number, before

    def key(self, before: np.ndarray, number: np.ndarray) -> np.ndarray:
        return mix(before.astype(np.uint64) * _U(self.n_words + 1) + number.astype(np.uint64))

    def score(self, texts: pa.Array) -> pa.Array:
        out = []
        for w in words(texts, PLAIN_WORDS):
            doc, known, count, number, before = self.pairs(w)
            chance = self._chances(known, number, before)
            base = np.log10((count + 1.0) / (self.n_tokens + self.n_words + 1.0))
            sums = [np.bincount(doc, x, minlength=w.n) for x in (known, base, np.log10(chance))]
            out.append(np.stack([np.bincount(doc, minlength=w.n), *sums], 1))
        rows = np.concatenate([*out, np.zeros((0, 4))])
        counts = [pa.array(rows[:, k].astype(np.int64)) for k in (0, 1)]
        return pa.StructArray.from_arrays([*counts, pa.array(rows[:, 2]), pa.array(rows[:, 3])], names=["n_tokens", "n_known", "base_score", "score"])

    def _of_ids(self, number: np.ndarray, names: list[str]) -> list[np.ndarray]:
        """Columns of distinct sorted ids."""
        out = [np.zeros(len(number), self.words.columns[name]) for name in names]
        cut = np.searchsorted(number, np.append(self.base, self.n_words))
        for k in np.flatnonzero(np.diff(cut)):
            held, at = self.words.shard(int(k)), number[cut[k] : cut[k + 1]] - self.base[k]
            for values, name in zip(out, names, strict=True):
                values[cut[k] : cut[k + 1]] = held[name][at]
        return out

    def _chances(self, known: np.ndarray, number: np.ndarray, before: np.ndarray) -> np.ndarray:
        even = 1.0 / (self.n_words + 1)
        lower = np.full(len(number), self.unigram_rest * even)
        distinct, back = np.unique(number[known], return_inverse=True)
        if len(distinct):
            (follows,) = self._of_ids(distinct, ["follows"])
            own = follows - self.unigram_discount[np.minimum(follows, 3)]
            lower[known] += (np.maximum(own, 0) / max(self.n_types, 1))[back]
        chance = lower.copy()
        inner = (before >= 0) & (before < self.n_words)
        distinct, back = np.unique(before[inner], return_inverse=True)
        total, kinds = np.zeros(len(number)), np.zeros((3, len(number)))
        if len(distinct):
            found = self._of_ids(distinct, ["count", "n1", "n2", "n3"])
            total[inner] = found[0][back]
            kinds[:, inner] = np.stack(found[1:])[:, back]
        first = before == self.n_words
        total[first], kinds[:, first] = self.n_texts, self.start_counts[:, None]
        context = total > 0
        rest = self.discount[1:] @ kinds
        times = np.zeros(len(number), np.int64)
        both = np.flatnonzero(known & context)
        key, back = np.unique(self.key(before[both], number[both]), return_inverse=True)
        _, single, _ = self.once.find(key, [])
        _, _, (several,) = self.more.find(key, ["count"])
        times[both] = np.where(single >= 0, 1, several.astype(np.int64))[back]
        seen = np.maximum(times - self.discount[np.minimum(times, 3)], 0)
        chance[context] = (seen + rest * lower)[context] / total[context]
        return chance


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2, and 3 or more, from the numbers of keys that occur one to four times."""
    n = [0, *map(float, counts)]
    out = [0.0]
    share = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * share * n[k + 1] / n[k] if n[k] and n[k + 1] else k / 2
        out.append(float(min(max(d, 0.0), k)))
    return np.array(out)


_RUNS = "shard long, run binary"
_NAMES = ("shard", "n", "total", "n1", "n2", "n3", "n4")
_SIZES = ", ".join(f"{name} long" for name in _NAMES)


def _runs_of(table: pa.Table) -> list[np.ndarray]:
    return merge([unpack(raw.as_py()) for raw in table["run"]])


def _sizes(shard: int, keys: np.ndarray, count: np.ndarray) -> pa.Table:
    kinds = [int((count == k).sum()) for k in (1, 2, 3, 4)]
    row = zip(_NAMES, [shard, len(keys), int(count.sum()), *kinds], strict=True)
    return pa.table({name: pa.array([x], pa.int64()) for name, x in row})


def train(documents: DataFrame, text: str = "text", shard_words: int = 2_000_000, least_bits: int = 4) -> BigramModel:
    """Counts all words and pairs of the texts and writes the model."""
    spark = documents.sparkSession
    folder = local_path(shared_folder(spark, "model"))
    texts = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    volume, n_texts = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    bits = max(least_bits, int(np.ceil(np.log2(max(1, volume / 6 / shard_words)))))
    edges = _hash_edges(bits)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted((with_ends(w)[0] for b in batches for w in words(b.column("text"), PLAIN_WORDS)), edges)

    def write_words(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, count = _runs_of(table)
        _write(folder + "/words", f"{shard}.key", keys)
        _write(folder + "/words", f"{shard}.count", count)
        return _sizes(shard, keys, count)

    rows = texts.mapInArrow(count_words, _RUNS).groupBy("shard").applyInArrow(write_words, _SIZES).collect()
    sizes = {r.shard: r.n for r in rows}
    base = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(1 << bits)])))[:-1]
    kinds = {"key": "<u8", "count": "<u8"}
    model = BigramModel(Arrays(folder + "/words", bits, sizes, kinds), base, sum(sizes.values()), sum(r.total for r in rows))
    if model.n_words >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys():
            for b in batches:
                for w in words(b.column("text"), PLAIN_WORDS):
                    _, _, _, number, before = model.pairs(w)
                    yield model.key(before, number)

        yield from _counted(keys(), edges)

    # Contexts and continuations are numbered by word; words below a power of two, the begin context last.
    n_words, blocks = model.n_words, 1 << bits
    block_edges = np.append(base, n_words).astype(np.uint64)

    def write_pairs(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, count = _runs_of(table)
        once = count == 1
        _write(folder + "/once", f"{shard}.key", keys[once])
        _write(folder + "/more", f"{shard}.key", keys[~once])
        _write(folder + "/more", f"{shard}.count", count[~once])
        pair = unmix(keys)
        before, number = pair // _U(n_words + 1), pair % _U(n_words + 1)
        one = np.ones(len(keys), np.uint64)
        left = merge([[before, *((count == k).astype(np.uint64) for k in (1, 2)), (count > 2).astype(np.uint64), 0 * one]])
        right = merge([[number, 0 * one, 0 * one, 0 * one, one]])
        sums = merge([left, right])
        out = pa.Table.from_batches(list(_shards(sums, block_edges)))
        # One more row tells the shard's own numbers, under the number -1 - shard.
        told = _sizes(-1 - shard, keys, count).append_column("run", pa.array([b""], pa.binary()))
        return pa.concat_tables([out, told], promote_options="default").select(["run", *_NAMES])

    shape = "run binary, " + _SIZES
    written = staged(texts.mapInArrow(count_pairs, _RUNS).groupBy("shard").applyInArrow(write_pairs, shape), "contexts")
    told = written.filter("shard < 0").select(*_NAMES).collect()
    pair_sizes = {-1 - r.shard: (r.n1, r.n - r.n1) for r in told}

    def write_contexts(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        number, n1, n2, n3, follows = _runs_of(table)
        if shard == blocks:
            row = dict(zip(_NAMES, [shard, 0, 0, int(n1.sum()), int(n2.sum()), int(n3.sum()), 0], strict=True))
            return pa.table({name: pa.array([x], pa.int64()) for name, x in row.items()})
        own = (number - _U(base[shard])).astype(np.int64)
        for name, values in (("n1", n1), ("n2", n2), ("n3", n3), ("follows", follows)):
            whole = np.zeros(sizes[shard], np.uint32)
            whole[own] = values
            _write(folder + "/words", f"{shard}.{name}", whole)
        return _sizes(shard, own, follows)

    rows = written.filter("shard >= 0").select("shard", "run").groupBy("shard").applyInArrow(write_contexts, _SIZES).collect()
    model.n_texts = n_texts
    model.words.columns = kinds | {name: "<u4" for name in ("n1", "n2", "n3", "follows")}
    model.once = Arrays(folder + "/once", bits, {k: v[0] for k, v in pair_sizes.items()}, {"key": "<u8"})
    model.more = Arrays(folder + "/more", bits, {k: v[1] for k, v in pair_sizes.items()}, kinds)
    model.discount = discounts(np.array([[r.n1, r.n2, r.n3, r.n4] for r in told]).reshape(-1, 4).sum(0))
    start = [r for r in rows if r.shard == blocks]
    model.start_counts = np.array([[r.n1, r.n2, r.n3] for r in start], float).reshape(-1, 3).sum(0)
    inner = [r for r in rows if r.shard < blocks]
    model.n_types = sum(r.total for r in inner)
    of = np.array([[r.n1, r.n2, r.n3, r.n4] for r in inner], float).reshape(-1, 4).sum(0)
    model.unigram_discount = discounts(of)
    if model.n_types:
        often = sum(r.n for r in inner) - of[0] - of[1]
        model.unigram_rest = float(model.unigram_discount[1:] @ [of[0], of[1], often]) / model.n_types
    return model


def score_column(model: BigramModel, text: Column) -> Column:
    """n_tokens, n_known, base_score (add-one unigrams) and score of a text, in log10."""
    @F.arrow_udf("struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double>")
    def score(texts: pa.Array) -> pa.Array:
        return model.score(texts)

    return score(text)
