"""Substring dedup by sliding sentence spans.

A run starts at every sentence of a text and goes on for `sentences` sentences, or until it has `enough` words if that comes
first, but never has fewer than `least` words. With `whole` there are also the runs that do not end at `enough` words, and a
text without such a run is one run: so a repeated passage goes to its end, and so do later copies of short texts. Runs of all
documents are hashed and joined; of the runs with one hash the first, by id, text and place, stays. Every sentence that any
other one covers is removed, with the space after it.

A sentence ends at a word that ends with a full stop, exclamation or question mark, or at the end of a line.

Defined results: null and empty texts have no sentences and stay empty; a null id comes after all others; rows equal in id and
text are one document and get the same result; a run repeated inside one document loses its later copies; sentences after the
last whole run of a longer text are only removed as part of earlier runs; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import BROADCAST_ROWS, staged
from isobar.llm.textarrays import PLAIN_WORDS, Words, mix, powers, words

_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)


def _inverse_powers(n: int, _kept: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    if len(_kept[0]) < n:
        grown = np.full(max(n, 2 * len(_kept[0])), _INVERSE, np.uint64)
        grown[0] = 1
        _kept[0] = np.multiply.accumulate(grown)
    return _kept[0]


def sentence_starts(w: Words) -> np.ndarray:
    """Places of the words that begin a sentence, of all texts of a slice."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    lines = np.concatenate(([0], np.cumsum(w.data == 0x0A)))
    begins = np.ones(len(w.start), bool)
    begins[1:] = (w.doc[1:] != w.doc[:-1]) | _STOPS[w.data[w.end[:-1] - 1]] | (lines[w.start[1:]] != lines[w.end[:-1]])
    return np.flatnonzero(begins)


def runs(w: Words, sentences: int, enough: int, least: int, whole: bool) -> tuple[np.ndarray, ...]:
    """(text, first sentence, end sentence, hash) of the runs; sentences count from 0 in each text."""
    start = sentence_starts(w)
    doc = w.doc[start]
    edge = np.append(start, len(w.start))
    first_of = np.searchsorted(doc, np.arange(w.n + 1))
    at = np.arange(len(start))
    enough_at, least_at = np.searchsorted(edge, start + enough), np.searchsorted(edge, start + least)
    fixed = np.maximum(at + sentences, least_at)
    bounded = np.maximum(np.minimum(at + sentences, enough_at), least_at)
    end = bounded
    if whole:
        fixed = np.where((at == first_of[doc]) & (fixed > first_of[doc + 1]), first_of[doc + 1], fixed)
        more = fixed != bounded
        at, end, doc = np.append(at, at[more]), np.append(bounded, fixed[more]), np.append(doc, doc[more])
    inside = end <= first_of[doc + 1]
    at, end, doc = at[inside], end[inside], doc[inside]
    n = len(w.hash) + 1
    so_far = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w.hash * powers(n)[: n - 1])))
    a, b = edge[at], edge[end]
    hashed = mix((so_far[b] - so_far[a]) * _inverse_powers(n)[a] + (b - a).astype(np.uint64))
    return doc, at - first_of[doc], end - first_of[doc], hashed


def _runs_of(sentences: int, enough: int, least: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column("text"), PLAIN_WORDS):
                doc, a, b, hashed = runs(w, sentences, enough, least, whole)
                place = pa.array(w.first + doc)
                columns = [pa.array(hashed.view(np.int64)), batch.column("doc_id").take(place), batch.column("t").take(place)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((a << 32) | b)], ["run", "doc_id", "t", "spot"])

    return run


CLEANED = "struct<text: string, n_sentences: int, n_removed: int, removed: array<int>>"


def without_spans(texts: pa.Array, spots: pa.Array) -> pa.Array:
    """The text without the sentences of the given runs, and the removed stretches as code points."""
    runs_of, kept, total, gone, cut = spots.to_pylist(), [], [], [], []
    for w in words(texts, PLAIN_WORDS):
        start = sentence_starts(w)
        first_of = np.searchsorted(w.doc[start], np.arange(w.n + 1))
        raw = texts.slice(w.first, w.n).to_pylist()
        for k in range(w.n):
            n = int(first_of[k + 1] - first_of[k])
            covered = np.zeros(n + 1, np.int64)
            for spot in runs_of[w.first + k] or ():
                covered[spot >> 32] += 1
                covered[spot & 0xFFFFFFFF] -= 1
            drop = np.cumsum(covered)[:n] > 0
            total.append(n)
            gone.append(int(drop.sum()))
            if not drop.any():
                kept.append(raw[k] or "")
                cut.append([])
                continue
            # Byte edges of the sentences; the last one goes to the end of the text.
            low, high = w.text_start[k], w.text_start[k + 1]
            edge = np.append(w.start[start[first_of[k] : first_of[k + 1]]], high) - low
            data = (raw[k] or "").encode()
            points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
            flips = np.flatnonzero(np.diff(np.concatenate(([False], drop, [False])).astype(np.int8)))
            stretches = edge[flips].reshape(-1, 2)
            cut.append(points[stretches].ravel().tolist())
            inner = np.concatenate(([0], stretches.ravel(), [len(data)])).reshape(-1, 2)
            kept.append(b"".join(data[a:b] for a, b in inner).decode())
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(total, pa.int32()), pa.array(gone, pa.int32()), pa.array(cut, pa.list_(pa.int32()))],
        names=["text", "n_sentences", "n_removed", "removed"],
    )


def drop_repeated_spans(
    documents: DataFrame, sentences: int = 3, enough: int = 20, least: int = 12, text: str = "text", doc_id: str = "doc_id", whole: bool = False
) -> DataFrame:
    """One row per document: doc_id, text without repeated spans, n_sentences, n_removed, removed (code points, in pairs)."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text"))
    found = rows.mapInArrow(_runs_of(sentences, enough, least, whole), "run long, doc_id long, t long, spot long")
    again = staged(found.groupBy("run").agg(F.count("*").alias("n")).filter("n > 1").select("run"), "repeated")
    few = again.count() <= BROADCAST_ROWS
    hits = staged(found.join(F.broadcast(again) if few else again, "run"), "runs")
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "t", "spot")
    firsts = staged(hits.groupBy("run").agg(F.min(own).alias("first")), "firsts")
    later = hits.join(F.broadcast(firsts) if few else firsts, "run").filter(own != F.col("first"))
    per_doc = staged(later.groupBy("doc_id", "t").agg(F.collect_set("spot").alias("spots")), "spots")
    size = per_doc.agg(F.count("*"), F.sum(F.size("spots"))).first()
    few = (size[0] or 0) + (size[1] or 0) <= BROADCAST_ROWS
    other = per_doc.select(F.col("doc_id").alias("d"), F.col("t").alias("u"), "spots")
    joined = rows.join(F.broadcast(other) if few else other, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u")), "left")
    cleaned = joined.select("doc_id", F.arrow_udf(without_spans, CLEANED)("text", "spots").alias("c"))
    return cleaned.select("doc_id", "c.text", "c.n_sentences", "c.n_removed", "c.removed")
