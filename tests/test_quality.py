import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import quality
from isobar.plans.quality import null_report, quality_profile


def frame(spark, values, extra=None):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id INT, x DOUBLE").repartition(8)


SHAPES = {
    "uniform": np.random.default_rng(1).uniform(size=5000),
    "heavy": np.random.default_rng(2).pareto(0.5, size=5000),
    "one value for a third": np.where(np.arange(4001) % 3 == 0, 7.0, np.random.default_rng(3).normal(size=4001)),
    "constant": np.full(100, 3.0),
    "pair": np.array([1.0, 2.0]),
    "single": np.array([5.0]),
    "few": np.array([4.0, 1.0, 3.0, 2.0, 10.0, -1.0]),
}


@pytest.mark.parametrize("name", SHAPES)
@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_quantiles_are_exact(spark, name, accuracy):
    values = SHAPES[name]
    qs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    out = quality.exact_quantiles(frame(spark, values), ["x"], qs, accuracy).collect()
    got = {r["q"]: r["value"] for r in out}
    assert [got[q] for q in qs] == pytest.approx(list(np.quantile(values, qs)), rel=1e-12, abs=1e-12)


def test_describe(spark):
    values = SHAPES["few"]
    row = quality.describe(frame(spark, [*values, None]), ["x"]).first()
    assert row["n"] == 6 and row["std"] == pytest.approx(values.std(ddof=1))
    assert (row["q1"], row["median"], row["q3"]) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    empty = frame(spark, [1.0, 2.0]).withColumn("gone", F.lit(None).cast("double"))
    facts = {r["column_name"]: r for r in quality.describe(empty, ["x", "gone"]).collect()}
    assert facts["x"]["n"] == 2 and facts["gone"]["n"] == 0 and facts["gone"]["mean"] is facts["gone"]["median"] is None
    assert {r["value"] for r in quality.exact_quantiles(empty, ["gone"]).collect()} == {None}


def test_null_counts_shares_and_report(spark, rows):
    df = frame(spark, [1, None, 3, None])
    assert rows(quality.null_counts(df)) == [(0, 2)]
    assert rows(quality.null_shares(df)) == [(0.0, 50.0)]
    assert rows(null_report(df, ["id", "x"])) == [("id", 4, 0, 0.0), ("x", 4, 2, 50.0)]
    assert sorted(rows(quality.rows_with_null(df, ["id", "x"], ["id"]))) == [(1, "x"), (3, "x")]
    assert quality.complete_rows(df).count() == 2
    assert rows(null_report(df.limit(0), ["x"])) == [("x", 0, 0, None)]


def test_profile(spark, rows):
    df = frame(spark, [1, None, 3]).withColumn("ts", F.timestamp_seconds("id"))
    parts = quality_profile(df, ["x"], "ts", ["id"], peek=1)
    assert rows(parts["positions"]) == [("x", 1)]
    assert rows(parts["newest"], "id") == [(2,)]


def test_schema_facts(spark, rows):
    assert rows(quality.schema_facts(frame(spark, [1, None]))) == [("id", "int", 2, 2), ("x", "double", 2, 1)]


def test_zscore_round_trip_and_constant_series(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 6.0), ("flat", 4.0), ("flat", 4.0)], "s STRING, x DOUBLE"
    )
    scored = quality.zscore(df, "x", ["s"])
    a = np.array([1.0, 2.0, 6.0])
    got = sorted(r["z"] for r in scored.filter("s = 'a'").collect())
    assert got == pytest.approx(list((a - a.mean()) / a.std()))
    assert {r["z"] for r in scored.filter("s = 'flat'").collect()} == {None}
    back = quality.zscore_inverse(scored.filter("s = 'a'"), out="back")
    assert all(abs(r["back"] - r["x"]) < 1e-12 for r in back.collect())
    # Statistics of the training rows only.
    train = quality.zscore(df, "x", ["s"], F.col("x") < 5)
    assert train.filter("x = 6").first()["z"] == pytest.approx((6 - 1.5) / 0.5)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a INT, b STRING")
    assert quality.distinct_rows(df).count() == 2
