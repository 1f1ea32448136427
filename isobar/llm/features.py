"""Hashed text features of whole texts, and the sample of labelled rows that models are fitted on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import small_or_not, staged
from isobar.llm.textarrays import NORMAL_WORDS, Words, mix, prefix_hashes, words

BITS = 20
PREFIXES = range(4, 9)
#: A character that opens or closes a word: letters small and large, digits, several marks, other bytes.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 4
for _k, _marks in enumerate((b".,;:", b"!?", b"*#$%&@^~", b"|_-=+/<>", b"()[]{}\"'")):
    _CLASS[list(_marks)] = 5 + _k


def split_by_crc(doc_id: Column, parts: int, held: int) -> Column:
    """True for the held-out rows: crc32 of the id as text has that remainder. Rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == held, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: Column, train: Column, limit: int, seed: int, text: str, doc_id: str
) -> DataFrame:
    """(doc_id, text, label): at most `limit` labelled training documents, chosen by a hash of the id.

    Of several labels of a document the largest counts, of several texts with one id the first in order.
    """
    rated = labels.select(F.col(doc_id).alias("doc_id"), label.cast("int").alias("label")).filter("label IS NOT NULL AND doc_id IS NOT NULL")
    rated = rated.filter(train).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = rated.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(limit)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return staged(found, "sample")


def repeated_ids(documents: DataFrame) -> DataFrame:
    """(doc_id) of several rows, written."""
    times = documents.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    return small_or_not(staged(times.filter("n > 1").select("doc_id"), "twice"))


def first_texts(documents: DataFrame, twice: DataFrame) -> DataFrame:
    """(doc_id, text) with one row per id: of several texts with one id the first in order. Only these are grouped. Each row without
    an id stays."""
    first = documents.join(twice, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return documents.join(twice, "doc_id", "left_anti").select("doc_id", "text").unionByName(first)


def key_dims(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For whole words, then for each length of prefix: places of words, and their feature numbers."""
    shift = np.uint64(64 - BITS)
    yield np.arange(len(w.hash)), (mix(w.hash) >> shift).astype(np.int64)
    for at, hashed in prefix_hashes(w, PREFIXES):
        yield at, (hashed >> shift).astype(np.int64)


def counted(w: Words, chosen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of the chosen features; all of them if None."""
    pairs = []
    for at, dim in key_dims(w):
        if chosen is not None:
            some = chosen[dim]
            at, dim = at[some], dim[some]
        pairs.append((w.doc[at].astype(np.int64) << BITS) + dim)
    pair, n = np.unique(np.concatenate(pairs), return_counts=True)
    return pair >> BITS, pair & ((1 << BITS) - 1), n


def shapes(w: Words) -> np.ndarray:
    """Ten numbers per text about its layout, each between 0 and 1."""
    n = w.counts
    size = np.diff(w.text_start)
    owner = np.repeat(np.arange(w.n), size)
    kinds = np.bincount(owner * 10 + _CLASS[w.data], minlength=w.n * 10).reshape(w.n, 10)[:, :10]
    some, byte = np.maximum(n, 1), np.maximum(size, 1)
    pair, times = np.unique((w.doc.astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)), return_counts=True)
    who = (pair >> np.uint64(40)).astype(np.int64)
    distinct = np.bincount(who, minlength=w.n)
    most = np.zeros(w.n, np.int64)
    np.maximum.at(most, who, times)
    again = np.zeros(len(w.hash), bool)
    if len(again):
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    return np.stack(
        [
            np.minimum(np.log1p(n) / 12, 1),
            np.minimum(np.bincount(w.doc, (w.end - w.start), minlength=w.n) / some / 16, 1),
            kinds[:, 2] / letters,
            kinds[:, 3] / byte,
            np.minimum(kinds[:, 5] / some, 1),
            np.minimum(kinds[:, 6] / some, 1),
            np.minimum((kinds[:, 7] + kinds[:, 8]) / some, 1),
            distinct / some,
            most / some,
            np.bincount(w.doc, again, minlength=w.n) / some,
        ],
        1,
    )


def normal_words(texts: pa.Array) -> Iterator[Words]:
    return words(texts, NORMAL_WORDS, wide=True)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents and sum of grades by feature."""
    number, total = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.float64)
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for w in normal_words(batch.column("text")):
            doc, dim, _ = counted(w, None)
            number += np.bincount(dim, minlength=1 << BITS)
            total += np.bincount(dim, label[w.first + doc], minlength=1 << BITS)
    dim = np.flatnonzero(number)
    if len(dim):
        yield pa.RecordBatch.from_arrays([pa.array(dim), pa.array(number[dim]), pa.array(total[dim])], ["dim", "n", "total"])


def feature_counts(sample: DataFrame) -> DataFrame:
    """(dim, n, total): documents that have a feature, and the sum of their labels; `sample` has (text, label)."""
    counts = sample.select("text", "label").mapInArrow(_feature_counts, "dim long, n long, total double")
    return counts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def telling_features(sample: DataFrame, keep: int, support: int, counts: DataFrame | None = None) -> np.ndarray:
    """The `keep` features whose documents' mean label differs most from the others', in standard errors.

    `counts` are those of `feature_counts`, if they are there already.
    """
    size, mean, spread = sample.agg(F.count("*"), F.avg("label"), F.coalesce(F.stddev_pop("label"), F.lit(0.0))).first()
    if not size or not spread:
        return np.zeros(0, np.int64)
    by = feature_counts(sample) if counts is None else counts
    by = by.filter((F.col("n") >= support) & (F.col("n") < size))
    z = F.abs(F.col("total") / F.col("n") - mean) / (spread * F.sqrt(1 / F.col("n") - 1 / F.lit(float(size))))
    top = by.withColumn("z", z).orderBy(F.desc("z"), "dim").limit(keep)
    return np.array(sorted(r.dim for r in top.select("dim").collect()), np.int64)


def places(dims: np.ndarray) -> np.ndarray:
    """Of each feature number, its place in `dims`, else -1."""
    place = np.full(1 << BITS, -1, np.int64)
    place[dims] = np.arange(len(dims))
    return place


def found_features(texts: pa.Array, place: np.ndarray) -> list[bytes]:
    """Of each text, the places of its features and how often each occurs, as pairs of int32."""
    kept = []
    for w in normal_words(texts):
        doc, dim, n = counted(w, place >= 0)
        parts = np.split(np.stack([place[dim], n], 1), np.searchsorted(doc, np.arange(1, w.n)))
        kept += [p.astype(np.int32).tobytes() for p in parts]
    return kept


def matrix(sample: DataFrame, dims: np.ndarray, extra=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, label, extra columns) of the bounded sample, rows by id: log of one plus the count of each feature.

    `extra` gives more columns from a list of texts.
    """
    place = places(dims)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            kept = found_features(texts, place)
            more = extra(texts) if extra else np.zeros((len(texts), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(kept, pa.binary()), pa.array([x.astype(np.float64).tobytes() for x in more], pa.binary())],
                ["doc_id", "label", "found", "more"],
            )

    out = sample.select("doc_id", "label", "text").mapInArrow(rows, "doc_id long, label int, found binary, more binary").toArrow()
    out = out.sort_by("doc_id")
    x = np.zeros((out.num_rows, len(dims)), np.float32)
    for k, found in enumerate(out["found"].to_pylist()):
        at = np.frombuffer(found, np.int32).reshape(-1, 2)
        x[k, at[:, 0]] = np.log1p(at[:, 1])
    more = np.array([np.frombuffer(m, np.float64) for m in out["more"].to_pylist()])
    return x, out["label"].to_numpy(), more


def linear(w: Words, weights: np.ndarray) -> np.ndarray:
    """Sum over a text's features of weight times log of one plus the count."""
    doc, dim, n = counted(w, weights != 0)
    return np.bincount(doc, weights[dim] * np.log1p(n), minlength=w.n)
