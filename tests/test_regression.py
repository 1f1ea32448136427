from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import forecast as fc
from isobar.operators import regression as rg

T0 = datetime(2024, 1, 1)


def frame(spark, columns):
    """Rows of (series, ds, y, regressors..) from arrays by series."""
    rows = [
        (s, T0 + timedelta(hours=i), *(None if v is None or np.isnan(v) else float(v) for v in values))
        for s, parts in columns.items()
        for i, values in enumerate(zip(*parts, strict=True))
    ]
    width = len(next(iter(columns.values()))) - 1
    extra = "".join(f", x{k} DOUBLE" for k in range(width))
    return spark.createDataFrame(rows, f"series STRING, ds TIMESTAMP, y DOUBLE{extra}").repartition(5)


def by_series(df):
    return {r["series"]: r for r in df.collect()}


def test_opposite_coefficients_and_a_large_offset(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2, 900)) + 1e6
    base = 3 * (x[0] - 1e6) - 2 * (x[1] - 1e6)
    df = frame(spark, {"up": (base + 7, *x), "down": (-base - 7, *x), "small": (base[:3], *x[:, :3])})
    found = by_series(rg.SeriesRegression(["x0", "x1"], daily=0).fit(df).model)
    assert found["up"]["beta"][1:] == pytest.approx([3, -2], abs=1e-6)
    assert found["down"]["beta"][1:] == pytest.approx([-3, 2], abs=1e-6)
    assert [found[s]["n"] for s in ("up", "down", "small")] == [900, 900, 3]


def test_against_numpy_with_gaps_and_many_series(spark, monkeypatch):
    monkeypatch.setattr(rg, "HELD_BYTES", 2000)
    rng = np.random.default_rng(2)
    columns = {}
    for k in range(40):
        x = rng.normal(size=(2, 60 + k))
        y = k + x[0] * k - x[1] + rng.normal(size=60 + k)
        y[k % 7] = np.nan
        x[1][k % 5] = np.nan
        columns[f"s{k}"] = (y, *x)
    df = frame(spark, columns)
    model = rg.SeriesRegression(["x0", "x1"], daily=1).fit(df)
    found = by_series(model.model)
    for name, (y, x0, x1) in columns.items():
        hours = np.arange(len(y))
        seconds = hours * 3600 + (T0 - datetime(1970, 1, 1)).total_seconds()
        angle = 2 * np.pi * seconds / 86400
        design = np.column_stack((np.ones(len(y)), (seconds - 1577836800) / 31557600, np.sin(angle), np.cos(angle), x0, x1))
        whole = ~np.isnan(y) & ~np.isnan(x1)
        want, rss, *_ = np.linalg.lstsq(design[whole], y[whole], rcond=None)
        assert [found[name]["intercept"], *found[name]["beta"]] == pytest.approx(list(want), rel=1e-6, abs=1e-6)
        assert found[name]["rss"] == pytest.approx(rss[0], rel=1e-8)
        assert found[name]["n"] == whole.sum()
    out = model.predict(df.select("series", "ds", "x0", "x1"))
    assert out.count() == df.count() and out.filter("yhat IS NULL").count() == df.filter("x1 IS NULL").count()


def test_degenerate_series(spark):
    one, flat, twice = np.array([4.0]), np.full(50, 2.0), np.arange(50.0)
    df = frame(spark, {"one": (one, one, one), "flat": (flat, flat, flat), "twice": (3 * twice, twice, twice)})
    df = df.unionByName(spark.createDataFrame([(None, T0, 5.0, 1.0, 1.0), ("none", T0, None, 1.0, 1.0)], df.schema))
    model = rg.SeriesRegression(["x0", "x1"], daily=0).fit(df)
    found = by_series(model.model)
    assert set(found) == {"one", "flat", "twice", None}
    assert found["one"]["intercept"] == 4.0 and list(found["flat"]["beta"]) == [0.0] * 3
    assert found["twice"]["rss"] == pytest.approx(0, abs=1e-6)
    fitted = {(r["series"], r["yhat"]) for r in model.predict(df).filter("series IS NULL OR series IN ('none', 'flat')").collect()}
    assert fitted == {(None, 5.0), ("none", None), ("flat", 2.0)}
    with pytest.raises(ValueError):
        rg.SeriesRegression().predict(df)
    with pytest.raises(ValueError):
        rg.SeriesRegression(["gone"]).fit(df)
    assert rg.SeriesRegression(["x0"]).fit(df.limit(0)).model.count() == 0


def broken(n, slopes, breaks, noise, seed):
    """A trend with slopes per day that change at the given shares of the time, a day and a week."""
    rng = np.random.default_rng(seed)
    days = np.arange(n) / 24
    trend = slopes[0] * days
    for before, after, at in zip(slopes, slopes[1:], breaks):
        trend = trend + (after - before) * np.maximum(days - at * days[-1], 0)
    return 10 + trend + 3 * np.sin(2 * np.pi * days) + 2 * np.cos(2 * np.pi * days / 7) + noise * rng.normal(size=n)


def test_two_breaks_are_found(spark):
    n = 24 * 7 * 12
    series = {
        "bent": broken(n, (0.5, -0.7, 0.2), (0.32, 0.64), 0.3, 3),
        "straight": broken(n, (0.3,), (), 0.3, 4),
    }
    model = rg.BrokenTrend(candidates=25).fit(frame(spark, {s: (y,) for s, y in series.items()}))
    found = model.change_points().orderBy("ds").collect()
    assert [r["series"] for r in found] == ["bent", "bent"]
    assert [r["change"] for r in found] == pytest.approx([-1.2, 0.9], abs=0.05)
    span = timedelta(hours=n - 1)
    for r, share in zip(found, (0.32, 0.64), strict=True):
        assert abs((r["ds"] - T0) / span - share) < 0.02


def test_better_than_one_slope_on_the_next_week(spark):
    n, ahead = 24 * 7 * 12, 24 * 7
    y = broken(n + ahead, (0.5, -0.7, 0.2), (0.32 * n / (n + ahead), 0.64 * n / (n + ahead)), 0.3, 5)
    history = frame(spark, {"a": (y[:n],)})
    error = {}
    for name, model in {"broken": rg.BrokenTrend(), "straight": fc.TrendSeason()}.items():
        got = [r["yhat"] for r in model.fit(history).predict(ahead).orderBy("ds").collect()]
        error[name] = np.sqrt(np.mean((np.array(got) - y[n:]) ** 2))
    assert error["broken"] < 0.6 and error["broken"] < error["straight"] / 5


def test_fixed_breaks_equal_numpy(spark):
    n = 24 * 30
    y = broken(n, (1.0, -1.0), (0.5,), 0.2, 6)
    model = rg.BrokenTrend(breaks=["2024-01-10 00:00:00", "2024-01-20 00:00:00"], daily=2, weekly=1).fit(frame(spark, {"a": (y,)}))
    days = np.arange(n) / 24
    angle = 2 * np.pi * (days + (T0 - datetime(1970, 1, 1)).days)
    waves = [w(k * angle / p) for p, orders in ((1, 2), (7, 1)) for k in range(1, orders + 1) for w in (np.sin, np.cos)]
    design = np.column_stack((np.ones(n), days, np.maximum(days - 9, 0), np.maximum(days - 19, 0), *waves))
    want = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    got = model.predict(1, only_future=False).orderBy("ds").collect()
    assert [r["yhat"] for r in got[:n]] == pytest.approx(list(want), abs=1e-6)
    assert len(got) == n + 1 and got[-1]["ds"] == T0 + timedelta(hours=n)


def test_choice_equals_all_subsets():
    """The chosen hinges have the lowest criterion of all subsets of few candidates."""
    from itertools import combinations

    rng = np.random.default_rng(8)
    for trial in range(20):
        n, t = 300, np.linspace(0, 1, 300)
        knots = np.array([0.2, 0.4, 0.6, 0.8])
        hinges = np.maximum(t[:, None] - knots, 0)
        y = t + hinges @ (rng.normal(size=4) * 3 * (rng.random(4) < 0.5)) + 0.1 * rng.normal(size=n)
        got = rg.broken_trend(rg.moments_of(np.column_stack((hinges, t, y))), 4)

        def criterion(chosen):
            design = np.column_stack((np.ones(n), t, hinges[:, list(chosen)]))
            rest = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
            return n * np.log(rest @ rest) + 2 * len(chosen) * np.log(n)

        best = min((c for size in range(5) for c in combinations(range(4), size)), key=criterion)
        assert tuple(np.flatnonzero(np.array(got["beta"])[:4])) == best, trial


def test_short_and_empty_series(spark):
    df = frame(spark, {"one": (np.array([4.0]),), "two": (np.array([1.0, 2.0]),)})
    out = rg.BrokenTrend(candidates=5).fit(df).predict(2)
    assert out.filter("yhat IS NULL").count() == 0 and out.count() == 4
    assert out.filter("series = 'one' AND abs(yhat - 4) > 1e-9").count() == 0
    assert rg.BrokenTrend().fit(df.limit(0)).predict(2).count() == 0
    assert rg.BrokenTrend(candidates=0).fit(df).change_points().count() == 0
    assert rg.BrokenTrend(candidates=3).fit(df.withColumn("series", F.lit(None).cast("string"))).predict(1).count() == 1
