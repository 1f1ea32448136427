"""Benchmark decontamination by spaced seeds.

A mask ignores some of the token positions it spans; the tokens it looks at are hashed together at every position of the test
items and of the documents. A document position whose hash is one of an item's is a hit, which lays the item along the
document. Around the hit the tokens are compared one by one: a stretch of `overlap` tokens of which at least `same` parts agree
is an overlap, so replaced tokens do not hide a passage. Items shorter than `overlap` must agree as much over their whole length.

No overlap of 13 tokens with two replaced is missed: one of the masks looks at none of any two positions. Shorter items are cut
into one more run of tokens than may be replaced; one run is whole then, and runs are seeds too. Both were counted out, and hold
for the default `overlap` and `same`; other values give longer overlaps less than this.

Tokens are runs of letters and digits in lower case. Test items go to the workers in blocks of at most about `block_tokens`
tokens; each block is one pass over the documents.

Defined results: null and empty texts have no hits; an empty benchmark gives none; items with equal tokens count once, as the
smallest id; an item of one token is found wherever the token is; all places of a seed that an item repeats count; equal
documents get equal hits; a column called as the new one is replaced, others stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.textarrays import NORMAL_WORDS, Words, lists, mix, words

#: Fixed masks of six tokens each; 0 is an ignored position.
MASKS = ("1110111", "11011011", "101101101", "1100101011", "11100111")
FILTER_BITS = 22
HIT = "array<struct<item: bigint, start: int, end: int, same: int, length: int>>"
_HIT = pa.struct([("item", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("same", pa.int32()), ("length", pa.int32())])
_CHUNK = 1 << 21


def seeds(w: Words, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the mask lies within a text, and the hashes of the tokens it looks at."""
    n, span = len(w.hash), len(mask)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n - span + 1, np.uint64(number), np.uint64)
    for j, looked in enumerate(mask):
        if looked == "1":
            total += w.hash[j : n - span + 1 + j] * np.uint64(2 * (0x5851F42D4C957F2D * (j + 1) & (1 << 62) - 1) + 1)
    whole = w.doc[: n - span + 1] == w.doc[span - 1 :]
    return np.flatnonzero(whole), total[whole]


@dataclass
class Items:
    """A block of test items: their tokens, and their seeds in order."""

    ids: list
    token: np.ndarray
    begin: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    near: np.ndarray
    masks: list[tuple[str, int]]


def short_runs(length: int, same: float) -> list[tuple[int, int]]:
    """(first token, tokens) of the runs a short item is cut into: one more than its tokens that may differ."""
    parts = length - int(np.ceil(same * length - 1e-9)) + 1
    edges = [k * length // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def index_items(ids: list, texts: pa.Array, masks: Sequence[str], overlap: int = 13, same: float = 0.8) -> Items:
    """Items with equal tokens must have been reduced to one."""
    runs: set[int] = set()
    tokens, sizes, found = [], [], []
    for w in words(texts, NORMAL_WORDS, wide=True):
        tokens.append(w.hash)
        sizes.append(w.counts)
        short = w.counts < overlap
        for number, mask in enumerate(masks):
            at, seed = seeds(w, mask, number)
            at, seed = at[~short[w.doc[at]]], seed[~short[w.doc[at]]]
            found.append((seed, w.first + w.doc[at], at - w.doc_start[w.doc[at]]))
        cut = {(int(w.doc_start[k]) + a, n) for k in np.flatnonzero(short & (w.counts > 0)) for a, n in short_runs(int(w.counts[k]), same)}
        for n in sorted({n for _, n in cut}):
            runs.add(n)
            at, seed = seeds(w, "1" * n, len(masks) + n)
            some = np.isin(at, [a for a, m in cut if m == n])
            found.append((seed[some], w.first + w.doc[at[some]], at[some] - w.doc_start[w.doc[at[some]]]))
    token = np.concatenate([*tokens, np.zeros(0, np.uint64)])
    begin = np.concatenate(([0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))))
    seed, item, place = (np.concatenate([np.zeros(0, kind), *(x[k] for x in found)]) for k, kind in enumerate((np.uint64, np.int64, np.int64)))
    order = np.lexsort((place, item, seed))
    seed, item, place = seed[order], item[order], place[order]
    near = np.zeros(1 << FILTER_BITS, bool)
    near[seed >> np.uint64(64 - FILTER_BITS)] = True
    used = [*zip(masks, range(len(masks)), strict=True), *(("1" * n, len(masks) + n) for n in sorted(runs))]
    return Items(list(ids), token, begin, seed, item, place, near, used)


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... size[0] numbers, then those of begin[1], and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def _lay(w: Words, items: Items) -> np.ndarray:
    """Rows (document, item, token at which the item begins), each once."""
    found = [np.zeros((0, 3), np.int64)]
    for mask, number in items.masks:
        at, seed = seeds(w, mask, number)
        some = items.near[seed >> np.uint64(64 - FILTER_BITS)]
        at, seed = at[some], seed[some]
        low, high = (np.searchsorted(items.seed, seed, side) for side in ("left", "right"))
        hit = high > low
        at, low, size = at[hit], low[hit], (high - low)[hit]
        # In parts, as a seed that text and item repeat has as many hits as the product of both, but few alignments.
        part = np.cumsum(size) // _CHUNK
        for k in np.unique(part):
            own = part == k
            which, spot = _spread(low[own], size[own]), np.repeat(at[own], size[own])
            found.append(np.unique(np.stack([w.doc[spot], items.item[which], spot - items.place[which]], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def overlaps(w: Words, items: Items, overlap: int, same: float) -> np.ndarray:
    """Rows (document, item, first token, end token, equal tokens) of the verified overlaps."""
    laid, out = _lay(w, items), []
    edge = w.doc_start
    size = items.begin[laid[:, 1] + 1] - items.begin[laid[:, 1]]
    group = np.cumsum(size) // _CHUNK
    for g in np.unique(group):
        part, long = laid[group == g], size[group == g]
        own = np.repeat(np.arange(len(part)), long)
        place = _spread(np.zeros(len(part), np.int64), long)
        at = part[own, 2] + place
        inside = (at >= edge[part[own, 0]]) & (at < edge[part[own, 0] + 1])
        equal = np.zeros(len(at), bool)
        equal[inside] = w.hash[at[inside]] == items.token[items.begin[part[own[inside], 1]] + place[inside]]
        window = np.minimum(long, overlap)
        so_far = np.concatenate(([0], np.cumsum(equal)))
        start = np.flatnonzero(place <= (long - window)[own])
        wide = window[own[start]]
        good = so_far[start + wide] - so_far[start] >= np.ceil(same * wide - 1e-9)
        start, wide = start[good], wide[good]
        if not len(start):
            continue
        head = np.flatnonzero(np.concatenate(([True], own[start][1:] != own[start][:-1])))
        last = np.append(head[1:], len(start)) - 1
        a, b, who = start[head], start[last] + wide[last], own[start[head]]
        # An overlap begins and ends with an equal token.
        spots = np.flatnonzero(equal)
        a, b = spots[np.searchsorted(spots, a)], spots[np.searchsorted(spots, b) - 1] + 1
        begin = part[who, 2] + place[a]
        out.append(np.stack([part[who, 0], part[who, 1], begin, begin + b - a, so_far[b] - so_far[a]], 1))
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def _hits(texts: pa.Array, items: Items, overlap: int, same: float) -> pa.Array:
    counts, columns = [], []
    for w in words(texts, NORMAL_WORDS, wide=True):
        rows = overlaps(w, items, overlap, same)
        counts.append(np.bincount(rows[:, 0], minlength=w.n))
        if not len(rows):
            continue
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        points = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80)))
        zero = points[w.text_start[rows[:, 0]]]
        columns.append((rows[:, 1], points[w.start[rows[:, 2]]] - zero, points[w.end[rows[:, 3] - 1]] - zero, rows[:, 4], rows[:, 3] - rows[:, 2]))
    joined = [np.concatenate(x) for x in zip(*columns, strict=True)] if columns else [np.zeros(0, np.int64)] * 5
    item = pa.array([items.ids[k] for k in joined[0]], pa.int64())
    values = pa.StructArray.from_arrays([item, *(pa.array(x.astype(np.int32)) for x in joined[1:])], fields=list(_HIT))
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def hits_column(items: Items, text: Column, overlap: int, same: float) -> Column:
    """The overlaps of a text with a block of items: item, code points, equal tokens and tokens."""
    @F.arrow_udf(HIT)
    def hits(texts: pa.Array) -> pa.Array:
        return _hits(texts, items, overlap, same)

    return hits(text)


def found_column(
    benchmark: DataFrame,
    text: Column,
    item_id: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    overlap: int = 13,
    same: float = 0.8,
    block_tokens: int = 500_000,
) -> Column:
    """The verified overlaps of a text with all test items."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("passage"))
    normal = F.trim(F.regexp_replace(F.lower("passage"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    items = items.groupBy(normal.alias("normal")).agg(F.min("item").alias("item"), F.min("passage").alias("passage"))
    total = items.agg(F.sum(F.size(F.split("normal", " ")))).first()[0] or 0
    blocks = -(-2 * total // block_tokens) if total > block_tokens else 1
    items = items.withColumn("block", F.pmod(F.xxhash64("normal"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        some = items.filter(F.col("block") == block).orderBy("item", "normal").select("item", "passage").toArrow()
        if some.num_rows:
            index = index_items(some["item"].to_pylist(), some["passage"], masks, overlap, same)
            found.append(hits_column(index, text, overlap, same))
    return F.concat(*found) if found else F.array().cast(HIT)


def with_hits(documents: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "hits", **options) -> DataFrame:
    """The documents with one more column: their verified overlaps with the test items."""
    return documents.withColumn(name, found_column(benchmark, F.col(text), **options))


def without_overlaps(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that overlap no test item, all columns as they are."""
    return documents.filter(F.size(found_column(benchmark, F.col(text), **options)) == 0)
