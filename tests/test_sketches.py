from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import sketches as sk

DAYS = [date(2024, 1, d) for d in range(1, 6)]


def readings(spark, n=4000):
    rng = np.random.default_rng(4)
    rows = []
    for k, day in enumerate(DAYS):
        x = 1e6 + rng.gamma(2.0, 10.0 * (k + 1), n)
        rows += [(day, float(v) if i % 9 else None, f"place {i % (300 * (k + 1))}", None) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "day DATE, x DOUBLE, place STRING, gone DOUBLE")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    df, folder = readings(spark), str(tmp_path_factory.mktemp("facts"))
    for day in DAYS:
        sk.keep_facts(df, F.col("day"), folder, [day], ["x", "place", "gone"])
    return df, folder


def exact(df):
    x = np.array([r["x"] for r in df.select("x").collect() if r["x"] is not None])
    return x, df.agg(F.count_distinct("place").alias("n")).first()["n"]


@pytest.mark.parametrize("days", [DAYS, DAYS[1:3], DAYS[4:]])
def test_merged_days_equal_the_rows(spark, kept, days):
    df, folder = kept
    profile = {r["column_name"]: r for r in sk.merged_profile(sk.kept_facts(spark, folder, days), (0.1, 0.5, 0.9)).collect()}
    some = df.filter(F.col("day").isin(days))
    x, places = exact(some)
    row = profile["x"]
    assert (row["n_rows"], row["n_values"]) == (some.count(), len(x))
    assert (row["min"], row["max"]) == (x.min(), x.max())
    assert (row["mean"], row["std"]) == pytest.approx((x.mean(), x.std(ddof=1)), rel=1e-9)
    for q, rank in zip(row["q"], (0.1, 0.5, 0.9), strict=True):
        assert abs((x <= q).mean() - rank) < sk.RANK_ERROR
    assert abs(profile["place"]["n_distinct"] / places - 1) < sk.DISTINCT_ERROR
    assert (profile["gone"]["n_values"], profile["gone"]["pct_null"], profile["gone"]["mean"], profile["gone"]["q"]) == (0, 100.0, None, None)


def test_a_new_day_reads_that_day_only(spark, tmp_path):
    source, folder = tmp_path / "rows", str(tmp_path / "facts")
    readings(spark, 50).write.partitionBy("day").parquet(str(source))
    for part in (source / "day=2024-01-01").glob("*.parquet"):
        part.write_bytes(b"no parquet")
    table = spark.read.schema("x DOUBLE, place STRING, gone DOUBLE, day DATE").parquet(str(source))
    sk.keep_facts(table, F.col("day"), folder, DAYS[1:3])
    sk.keep_facts(table, F.col("day"), folder, DAYS[3:4])
    sk.keep_facts(table, F.col("day"), folder, DAYS[3:4])
    facts = sk.kept_facts(spark, folder)
    assert sorted(r["day"] for r in facts.select("day").distinct().collect()) == DAYS[1:4]
    # The day of the rows is a column too.
    assert facts.count() == 12


def test_kinds_and_gaps(spark):
    df = spark.createDataFrame(
        [(None, 1, float("nan"), bytearray(b"x"), True), (None, None, 2.0, bytearray(b"x"), None)], "day DATE, i INT, d DOUBLE, b BINARY, t BOOLEAN"
    )
    rows = {r["column_name"]: r for r in sk.merged_profile(sk.daily_facts(df, F.col("day"), ["i", "d", "b", "t"])).collect()}
    assert (rows["i"]["mean"], rows["i"]["std"], rows["i"]["n_values"]) == (1.0, None, 1)
    assert (rows["d"]["n_values"], rows["d"]["min"], rows["d"]["q"]) == (2, 2.0, [2.0, 2.0, 2.0])
    assert (rows["b"]["n_distinct"], rows["t"]["n_values"]) == (1, 1)
    assert sk.merged_profile(sk.daily_facts(df.limit(0), F.col("day"))).count() == 0
