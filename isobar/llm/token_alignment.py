"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the same bytes, a space and the text. Ends that they share cut a text into groups. The groups are found by
divide and conquer: in an interval between two shared ends, the ends of A are looked up among those of B by bisection, from the
middle outwards, until one is found that B has as well; both halves go on, and an interval without a shared end is a group. All
intervals of a slice of texts take the same step at once, as numpy arrays; the ends of texts are shared by definition and
open the first intervals.

Within a group, two tokens are linked where their bytes overlap. How many documents hold a pair of ids linked is counted in
Spark. The table of pairs is counted: up to `MOST_PAIRS` go to every task, and each document's links are looked up there; a
larger table is joined with the links, which are then summed per document. Both ways give the same rows.

A is a byte-level BPE vocabulary in a JSON file, whose merges are in the order of their ids; B a piece model with byte fallback.
Files are read by every worker; their paths are parameters. Special tokens' strings inside texts are plain text.

Defined results: null and empty texts, and texts whose tokens do not spell the same bytes (white space that a tokenizer
normalises), have no tokens: zeros and an empty text of groups; equal rows, and rows with equal or null ids, count each as a
document; an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import staged
from isobar.llm.textarrays import slices

TEXT_BYTES = 1 << 19
#: Most pairs of ids that travel to every task, 24 bytes each; a larger table is joined.
MOST_PAIRS = 2_000_000
#: The ids of a pair in one number.
SHIFT = 32


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokenizer:
    """Byte-level BPE; `spelled` has the bytes of every id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        letters = byte_letters()
        vocabulary = {bytes(letters[c] for c in word): k for word, k in model["model"]["vocab"].items() if word not in special}
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for word, k in vocabulary.items():
            self.spelled[k] = word
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(" " + text, disallowed_special=()) for text in texts]


class PieceTokenizer:
    """Pieces with byte fallback; the model itself adds the space."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = []
        for k in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(k)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(k) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode(texts, num_threads=1)]


class Vocabulary:
    """The bytes of ids as Arrow arrays, and their decimal forms with what may follow them in the text of groups."""

    def __init__(self, spelled: list[bytes], last: bytes):
        self.bytes = pa.array(spelled, pa.large_binary())
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.within = [b"%d," % k for k in range(len(spelled))]
        self.last = [b"%d%s" % (k, last) for k in range(len(spelled))]


@cache
def tokenizers(path_a: str, path_b: str) -> tuple:
    """Both tokenizers and their tables, made once per worker."""
    a, b = ByteTokenizer(path_a), PieceTokenizer(path_b)
    first, second = Vocabulary(a.spelled, b"|"), Vocabulary(b.spelled, b";")
    return a, b, first, second, pa.array(first.within + first.last + second.within + second.last, pa.large_binary())


def _taken(values: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the chosen values one after another."""
    chosen = values.take(pa.array(at))
    _, offsets, data = chosen.buffers()
    offset = np.frombuffer(offsets, np.int64)[chosen.offset : chosen.offset + len(chosen) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offset


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each run, one run after the other."""
    start = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(start - begin, size)


def shared_ends(a: np.ndarray, b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places in the rising array `a` of values that the rising array `b` has too, by divide and conquer.

    `bounds` are places in `a` of values known to be shared, the last one of `a` among them: they open the first intervals.
    """
    found = [bounds]
    low, high = np.concatenate(([0], bounds[:-1] + 1)), bounds  # ends low..high-1 lie inside an interval that ends at `high`
    while True:
        open_ = high > low
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(found))
        middle = (low + high - 1) >> 1
        cut = np.full(len(low), -1)
        todo, reach, width = np.arange(len(low)), 0, 1
        while len(todo):
            # Ends reach..reach+width-1 places from the middle, to both sides.
            near = middle[todo]
            up = np.stack((np.minimum(near + reach, high[todo]), np.minimum(near + reach + width, high[todo])))
            down = np.stack((np.maximum(near - reach - width + 1, low[todo]), np.maximum(near - reach + 1, low[todo])))
            begin, stop = np.concatenate((up[0], down[0])), np.concatenate((up[1], down[1]))
            owner = np.repeat(np.concatenate((todo, todo)), stop - begin)
            tried = _runs(begin, stop - begin)
            at = np.searchsorted(b, a[tried])
            hit = b[np.minimum(at, len(b) - 1)] == a[tried]
            owner, tried = owner[hit], tried[hit]
            # The hit nearest to the middle comes last and stays.
            order = np.argsort(-np.abs(tried - middle[owner]), kind="stable")
            cut[owner[order]] = tried[order]
            left = (cut[todo] < 0) & ((near + reach + width < high[todo]) | (near - reach - width >= low[todo]))
            todo = todo[left]
            reach, width = reach + width, 2 * width
        split = cut >= 0
        found.append(cut[split])
        low, high = np.concatenate((low[split], cut[split] + 1)), np.concatenate((cut[split], high[split]))


SHAPE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
)


def _spelling(ids: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, how many each text has, and the bytes each text's ids spell."""
    flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
    count = np.array([len(x) for x in ids], np.int64)
    edge = np.concatenate(([0], np.cumsum(vocabulary.size[flat])))
    return flat, count, np.diff(edge[np.concatenate(([0], np.cumsum(count)))])


def align(texts: list[str], paths: tuple[str, str]) -> dict[str, list]:
    """Columns of the alignment of each text: counts, the hash of its groups, its linked pairs and how often each occurs."""
    a, b, first, second, decimal = tokenizers(*paths)
    raw = [b" " + t.encode() for t in texts]
    want = np.array([len(r) for r in raw])
    ids_a, ids_b = a.encode(texts), b.encode(texts)
    good = want > 1
    for ids, vocabulary in ((ids_a, first), (ids_b, second)):
        good &= _spelling(ids, vocabulary)[2] == want
    empty = np.zeros(0, np.int64)
    for ids, vocabulary in ((ids_a, first), (ids_b, second)):
        kept = [x if ok else empty for x, ok in zip(ids, good, strict=True)]
        flat = _spelling(kept, vocabulary)[0]
        spelled = _taken(vocabulary.bytes, flat)[0]
        should = np.frombuffer(b"".join(r for r, ok in zip(raw, good, strict=True) if ok), np.uint8)
        if not np.array_equal(spelled, should):
            ends = np.cumsum(np.where(good, want, 0))
            for k in np.flatnonzero(good):
                good[k] = spelled[ends[k] - want[k] : ends[k]].tobytes() == raw[k]
    flat_a, n_a, _ = _spelling([x if ok else empty for x, ok in zip(ids_a, good, strict=True)], first)
    flat_b, n_b, _ = _spelling([x if ok else empty for x, ok in zip(ids_b, good, strict=True)], second)
    n = len(texts)
    out = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64), "groups_sha256": [""] * n}
    out |= {"pairs": [empty] * n, "times": [empty] * n}
    docs = np.flatnonzero(n_a)
    if not len(docs):
        return out
    end_a, end_b = np.cumsum(first.size[flat_a]), np.cumsum(second.size[flat_b])
    cuts = shared_ends(end_a, end_b, np.cumsum(n_a)[docs] - 1)
    reached = np.searchsorted(end_b, end_a)  # the token of B that holds the last byte of each token of A
    last_b = reached[cuts]  # place in B of every shared end
    doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    out["n_groups"] = np.bincount(doc_a[cuts], minlength=n)
    # The text of groups: A's ids of a group, then B's.
    group_a = np.repeat(np.arange(len(cuts)), np.diff(cuts, prepend=-1))
    group_b = np.repeat(np.arange(len(cuts)), np.diff(last_b, prepend=-1))
    before_b = np.concatenate(([0], last_b[:-1] + 1))
    size = (len(first.within), len(second.within))
    code = np.empty(len(flat_a) + len(flat_b), np.int64)
    word_a, word_b = flat_a.copy(), flat_b + 2 * size[0]
    word_a[cuts] += size[0]
    word_b[last_b] += size[1]
    code[np.arange(len(flat_a)) + before_b[group_a]] = word_a
    code[np.arange(len(flat_b)) + cuts[group_b] + 1] = word_b
    data, offset = _taken(decimal, code)
    edge = offset[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    for k in docs:
        out["groups_sha256"][k] = hashlib.sha256(data[edge[k] : edge[k + 1] - 1]).hexdigest()
    # Links: each token of A with the tokens of B from the one that holds its first byte to the one that holds its last.
    after = reached.copy()
    after[cuts] += 1
    low = np.concatenate(([0], after[:-1]))
    many = reached - low + 1
    pair = (np.repeat(flat_a, many) << SHIFT) | flat_b[_runs(low, many)]
    owner = np.repeat(doc_a, many)
    out["n_links"] = np.bincount(owner, minlength=n)
    order = np.lexsort((pair, owner))
    pair, owner = pair[order], owner[order]
    new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1]))))
    times, pair, owner = np.diff(np.append(new, len(pair))), pair[new], owner[new]
    edge = np.searchsorted(owner, np.arange(n + 1))
    out["pairs"] = [pair[edge[k] : edge[k + 1]] for k in range(n)]
    out["times"] = [times[edge[k] : edge[k + 1]] for k in range(n)]
    return out


def aligned(documents: DataFrame, paths: tuple[str, str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document with its counts, the hash of its groups, its distinct linked pairs and how often each is linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offset in slices(batch.column(1), TEXT_BYTES):
                texts = [raw[offset[k] : offset[k + 1]].tobytes().decode() for k in range(end - begin)]
                found = align(texts, paths)
                found = {"doc_id": batch.column(0).slice(begin, end - begin), **found}
                kinds = {"pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(name)) for name, c in found.items()], list(found))

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(rows, SHAPE)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold the pair, and whether no other pair of its A id is in more."""
    counts = staged(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    # At most one row per id of A.
    most = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("most"))
    joined = counts.join(F.broadcast(most), F.shiftright("pair", SHIFT) == F.col("a"))
    return staged(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _sums_column(keys: np.ndarray, n: np.ndarray, best: np.ndarray, pairs: Column, times: Column) -> Column:
    """(n_best, count_sum) of the links of a document; `keys` are all pairs, sorted."""

    @F.arrow_udf("struct<n_best: bigint, count_sum: bigint>")
    def sums(found: pa.Array, often: pa.Array) -> pa.Array:
        size = np.diff(found.offsets.to_numpy())
        pair, times = found.flatten().to_numpy(), often.flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(keys, pair)
        edge = np.concatenate(([0], np.cumsum(size)))
        total = [np.concatenate(([0], np.cumsum(times * value[at]))) for value in (best, n)]
        return pa.StructArray.from_arrays([pa.array(np.diff(t[edge])) for t in total], ["n_best", "count_sum"])

    return sums(pairs, times)


def align_tokenizers(
    documents: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id", most_pairs: int = MOST_PAIRS
) -> DataFrame:
    """Per document: tokens, groups and links; links that are the best of their A id; the sum of their counts; the groups' hash."""
    links = staged(aligned(documents, (path_a, path_b), text, doc_id).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = pair_counts(links)
    own = ("n_a", "n_b", "n_groups", "n_links")
    if 0 < counts.count() <= most_pairs:
        table = counts.toArrow()
        order = np.argsort(table["pair"].to_numpy())
        keys, n, best = (table[c].to_numpy()[order] for c in ("pair", "n", "best"))
        summed = links.withColumn("sums", _sums_column(keys, n, best.astype(np.int64), F.col("pairs"), F.col("times")))
    else:
        each = links.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair"}).join(counts, "pair")
        n_best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("n") * F.col("times"))
        per_row = each.groupBy("row").agg(F.struct(n_best.alias("n_best"), total.alias("count_sum")).alias("sums"))
        summed = links.drop("pairs", "times").join(per_row, "row", "left")
    sums = [F.coalesce(f"sums.{c}", F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return summed.select("doc_id", *own, *sums, "groups_sha256")
