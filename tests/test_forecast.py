from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import forecast as fc


def hourly(spark, values, series="a", start="2024-02-27 00:00:00"):
    t0 = datetime.fromisoformat(start)
    rows = [(series, t0 + timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series STRING, ds TIMESTAMP, y DOUBLE").repartition(4)


def test_trend_and_season_against_numpy(spark):
    rng = np.random.default_rng(0)
    n = 24 * 9 + 5
    x = np.arange(n)
    y = 20 + 0.01 * x + 5 * np.sin(2 * np.pi * x / 24) + rng.normal(size=n)
    out = fc.forecast(hourly(spark, y).unionByName(hourly(spark, y * 2, "b")), 12).orderBy("series", "ds").collect()
    slope, icept = np.polyfit(x, y, 1)
    resid = y - (slope * x + icept)
    season = np.array([resid[x % 24 == h].mean() for h in range(24)])
    ahead = np.arange(n, n + 12)
    want = slope * ahead + icept + season[ahead % 24]
    assert [r["yhat"] for r in out[:12]] == pytest.approx(list(want), abs=1e-6)
    assert [r["yhat"] for r in out[12:]] == pytest.approx(list(2 * want), abs=1e-6)
    assert out[0]["ds"] == datetime(2024, 2, 27) + timedelta(hours=n)


def test_history_steps_and_guards(spark):
    df = hourly(spark, range(30))
    model = fc.TrendSeason("15min").fit(df)
    assert model.predict(16).agg(F.max("ds")).first()[0] == datetime(2024, 2, 28, 9)
    everything = model.predict(16, only_future=False)
    assert everything.count() == 46
    with pytest.raises(ValueError):
        fc.TrendSeason().predict(3)
    with pytest.raises(ValueError):
        fc.TrendSeason().fit(df.drop("y"))
    with pytest.raises(ValueError):
        fc.TrendSeason("D")


def test_one_point_and_gaps(spark):
    out = fc.forecast(hourly(spark, [4.0, None]), 2).orderBy("ds").collect()
    assert [r["yhat"] for r in out] == [4.0, 4.0]


def test_scores_with_zeros(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y DOUBLE, yhat DOUBLE")
    row = fc.score(df).first()
    assert (row["rmse"], row["mae"]) == (1.0, 1.0)
    assert row["mape"] == pytest.approx((1 / np.finfo(float).eps + 0.5) / 2)


def regression_frame(spark, n=24 * 20):
    rng = np.random.default_rng(5)
    t0 = datetime(2024, 1, 1)
    rows = []
    for name, level in (("a", 10.0), ("b", 50.0)):
        for i in range(n):
            u, v = rng.normal(size=2)
            y = level + 3 * u - 2 * v + 4 * np.sin(2 * np.pi * (i % 24) / 24)
            rows.append((name, t0 + timedelta(hours=i), float(y), float(u), float(v)))
    return spark.createDataFrame(rows, "series STRING, datetime TIMESTAMP, precipitation DOUBLE, u DOUBLE, v DOUBLE").repartition(4)


@pytest.mark.parametrize("normalise, parity", [(False, False), (True, False), (True, True)])
def test_holdout_with_regressors(spark, normalise, parity):
    tested = fc.holdout_forecast(
        regression_frame(spark), "precipitation", ["u", "v"], "datetime", normalise=normalise, parity=parity
    )
    scores = fc.score(tested, keys=["series"]).collect()
    assert tested.count() == 48
    limit = 4.0 if parity else 0.4
    assert len(scores) == 2 and all(s["rmse"] < limit for s in scores)


def test_coefficients_against_least_squares(spark):
    df = regression_frame(spark).filter("series = 'a'")
    rows = fc.prepare(df, "precipitation", ["u", "v", "datetime"], "datetime")
    assert rows.columns == ["series", "ds", "y", "u", "v"]
    model = fc.RegressorForecast(["u", "v"]).fit(rows)
    got = {r["ds"]: r["yhat"] for r in model.predict(rows).collect()}
    data = sorted((r["ds"], r["y"], r["u"], r["v"]) for r in rows.collect())
    hours = np.array([(d - datetime(2020, 1, 1)).total_seconds() / 3600 for d, *_ in data])
    angle = 2 * np.pi * hours / 24
    X = np.column_stack(
        [np.ones(len(data)), hours / (24 * 365.25), np.sin(angle), np.cos(angle), np.sin(2 * angle), np.cos(2 * angle),
         [d[2] for d in data], [d[3] for d in data]]
    )
    y = np.array([d[1] for d in data])
    X[:, 1] -= X[:, 1].mean()
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert [got[d[0]] for d in data] == pytest.approx(list(X @ beta), abs=1e-3)
    gaps = rows.limit(2).withColumn("u", F.lit(None).cast("double"))
    assert [r["yhat"] for r in model.predict(gaps).collect()] == [None, None]
    unknown = rows.limit(2).withColumn("series", F.lit("new"))
    assert [r["yhat"] for r in model.predict(unknown).collect()] == [None, None]
    with pytest.raises(ValueError):
        fc.RegressorForecast(["u"]).predict(rows)


def test_context_and_joined_regressors(spark):
    from isobar.operators.ordered import split_newest

    df = hourly(spark, range(100))
    marked = split_newest(df, 24, ["series"], ["ds"])
    assert fc.context_rows(marked, 10).count() == 34
    grid = fc.future_grid(df.groupBy("series").agg((F.max("ds") - F.expr("INTERVAL 3 HOURS")).alias("ds")), 5)
    known = df.withColumnRenamed("y", "u")
    joined = fc.with_regressors(grid, known, ["u"]).orderBy("ds").collect()
    assert [r["u"] for r in joined] == [97.0, 98.0, 99.0, None, None]
