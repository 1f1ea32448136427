"""Order-dependent operators against brute force, with slices small enough to be split and stitched."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isobar.operators import ordered, quality
from isobar.operators.joins import join_per_key

SLICINGS = [{}, {"target_rows": 2}, {"target_rows": 50}]


@pytest.fixture(scope="module")
def pdf():
    rng = random.Random(7)
    out = []
    for i in range(400):
        # A third of the rows is one series, and many of its rows fall into one hour.
        series = "hot" if i % 3 == 0 else rng.choice("abc")
        second = rng.randrange(3600) if series == "hot" else rng.randrange(5 * 86400)
        out.append((i, series, pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=second // 7 * 7), None if rng.random() < 0.4 else float(i)))
    return pd.DataFrame(out, columns=["id", "series", "ts", "x"])


@pytest.fixture(scope="module")
def df(spark, pdf):
    rows = [(int(r.id), r.series, r.ts.to_pydatetime(), None if np.isnan(r.x) else r.x) for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "id LONG, series STRING, ts TIMESTAMP, x DOUBLE").repartition(8).cache()


@pytest.mark.parametrize("slicing", SLICINGS)
@pytest.mark.parametrize("series", [["series"], []])
def test_backfill_one(df, pdf, series, slicing):
    got = {r["id"]: r["x"] for r in quality.backfill_one(df, "x", series, "ts", ["id"], **slicing).collect()}
    ordered_pdf = pdf.sort_values([*series, "ts", "id"])
    nxt = ordered_pdf.groupby("series")["x"].shift(-1) if series else ordered_pdf["x"].shift(-1)
    want = ordered_pdf["x"].fillna(nxt)
    assert len(got) == len(pdf)
    for i, value in zip(ordered_pdf["id"], want):
        assert got[i] == (None if np.isnan(value) else value)


@pytest.mark.parametrize("slicing", SLICINGS)
def test_row_index(df, pdf, slicing):
    got = {r["id"]: r["row_index"] for r in ordered.with_row_index(df, "ts", ["id"], **slicing).collect()}
    want = pdf.sort_values(["ts", "id"])["id"].tolist()
    assert [got[i] for i in want] == list(range(len(want)))
    per = {r["id"]: r["row_index"] for r in ordered.with_row_index(df, "ts", ["id"], ["series"], **slicing).collect()}
    for _, part in pdf.sort_values(["ts", "id"]).groupby("series"):
        assert [per[i] for i in part["id"]] == list(range(len(part)))


def test_hot_times_are_cut(spark, df):
    assert ordered.with_slices(df, ["series"], "ts") is None
    sizes = lambda d: [r["count"] for r in d.groupBy("_slice").count().collect()]
    assert max(sizes(ordered.with_slices(df, ["series"], "ts", ["id"], target_rows=20))) <= 40
    # Two full hours only, as stations that report on the hour give: neither is one task.
    hours = spark.sql("SELECT id, 'a' AS s, timestamp_seconds((id % 2) * 3600) AS ts FROM range(5000)")
    for tiebreak in (["id"], []):
        cut = ordered.with_slices(hours, ["s"], "ts", tiebreak, target_rows=100)
        assert max(sizes(cut)) <= 300 and cut.count() == 5000
    index = ordered.with_row_index(hours, "ts", ["id"], ["s"], target_rows=100)
    assert index.schema["row_index"].dataType == ordered.with_row_index(hours, "ts", ["id"], ["s"]).schema["row_index"].dataType
    want = {i: k for k, i in enumerate([*range(0, 5000, 2), *range(1, 5000, 2)])}
    assert all(want[r["id"]] == r["row_index"] for r in index.collect())


def test_null_positions(df, pdf, rows):
    want = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    want = sorted(("x", i) for i in want.index[want["x"].isna()])
    assert sorted(rows(quality.null_row_indices(df, ["id", "x"], "ts", ["id"]))) == want


def test_null_runs_fill_only_the_last(spark):
    df = spark.sql(
        """SELECT timestamp_seconds(id * 3600) AS ts, CASE WHEN id IN (0, 3, 4, 7) THEN NULL ELSE double(id) END AS x
        FROM range(8)"""
    )
    got = [r["x"] for r in quality.backfill_one(df, "x", [], "ts").orderBy("ts").collect()]
    assert got == [1.0, 1.0, 2.0, None, 5.0, 5.0, 6.0, None]


@pytest.mark.parametrize("series", [["series"], []])
def test_tails_splits_and_skips(df, pdf, series):
    order = ["ts", "id"]
    sorted_pdf = pdf.sort_values(order)
    groups = [g for _, g in sorted_pdf.groupby("series")] if series else [sorted_pdf]
    tail = {i for g in groups for i in g["id"].tail(24)}
    head = {i for g in groups for i in g["id"].head(15)}
    everything = set(pdf["id"])
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(ordered.newest(df, 24, series, order)) == sorted(tail)
    assert ids(ordered.oldest(df, 15, series, order)) == sorted(head)
    marked = ordered.split_newest(df, 24, series, order)
    assert ids(marked.filter("is_test")) == sorted(tail)
    assert ids(marked.filter("NOT is_test")) == sorted(everything - tail)
    assert ids(ordered.skip_oldest(df, 15, series, order)) == sorted(everything - head)
    assert ids(ordered.drop_newest(df, 24, series, order)) == sorted(everything - tail)


def test_series_shorter_than_the_tail(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "series STRING, id INT")
    assert ordered.newest(df, 24, ["series"], ["id"]).count() == 2
    assert ordered.split_newest(df, 24, ["series"], ["id"]).filter("is_test").count() == 2
    assert ordered.skip_oldest(df, 15, ["series"], ["id"]).count() == 0


def test_null_series_and_times_are_kept(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 5, None), (2, None, 7, 2.0), (3, "a", None, None), (4, "a", 3, 4.0), (5, "a", 4000, 5.0)],
        "id INT, series STRING, s LONG, x DOUBLE",
    ).withColumn("ts", F.timestamp_seconds("s"))
    cut = {"target_rows": 1}
    filled = quality.backfill_one(df, "x", ["series"], "ts", ["id"], **cut)
    assert sorted(rows(filled, "id", "x")) == [(1, 2.0), (2, 2.0), (3, 4.0), (4, 4.0), (5, 5.0)]
    indexed = ordered.with_row_index(df, "ts", ["id"], ["series"], **cut)
    assert sorted(rows(indexed, "id", "row_index")) == [(1, 0), (2, 1), (3, 0), (4, 1), (5, 2)]
    marked = ordered.split_newest(df, 1, ["series"], ["ts", "id"])
    assert sorted(rows(marked, "id", "is_test")) == [(1, False), (2, True), (3, False), (4, False), (5, True)]


@pytest.mark.parametrize("limit", [0, 100])
def test_join_per_key_with_and_without_broadcast(spark, rows, limit):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k STRING, v INT")
    sums = df.filter("v < 3").groupBy("k").agg(F.sum("v").alias("total"))
    out = join_per_key(df, sums, ["k"], "left", limit)
    assert sorted(rows(out, "k", "v", "total"), key=str) == [("a", 1, 1), ("b", 3, None), (None, 2, 2)]
