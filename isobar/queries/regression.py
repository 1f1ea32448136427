"""Models per series: coefficients, hold-out forecasts, trends with breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from isobar.functions.times import hour_of
from isobar.operators import forecast, regression
from isobar.queries.registry import SQL_K, events, ntz, payload_k, query, r6


def sql_least_squares(rows: str, keys: str, features: Sequence[str]) -> str:
    """`r`, the rows with `v` (1, features, y), and `b`, each series' coefficients in that order, for rows with `train`.

    The normal equations are swept one feature after the other.
    """
    n = len(features) + 1
    return f"""WITH RECURSIVE r AS (SELECT *, [1.0, {", ".join(features)}, y] AS v FROM ({rows})),
    d AS (SELECT unnest(range(1, {n + 2})) AS i),
    g AS (SELECT {keys}, p.i AS i, q.i AS j, sum(v[p.i] * v[q.i]) AS a FROM r, d AS p, d AS q WHERE train GROUP BY ALL),
    s AS (SELECT 1 AS k, {keys}, i, j, a FROM g
        UNION ALL
        SELECT k + 1, {keys}, i, j, CASE WHEN i = k THEN a / corner ELSE a - below * beside / corner END FROM (
            SELECT *, max(CASE WHEN i = k AND j = k THEN a END) OVER (PARTITION BY {keys}) AS corner,
                max(CASE WHEN j = k THEN a END) OVER (PARTITION BY {keys}, i) AS below,
                max(CASE WHEN i = k THEN a END) OVER (PARTITION BY {keys}, j) AS beside FROM s WHERE k <= {n})),
    b AS (SELECT {keys}, list(a ORDER BY i) AS b FROM s WHERE k = {n + 1} AND j = {n + 1} AND i <= {n} GROUP BY ALL)"""


_DAYS = "(epoch_us(ds) / 1e6 - 1705276800) / 86400.0"


def _sql_waves(daily: int, weekly: int = 0) -> list[str]:
    angles = [f"2 * pi() * {k} * epoch_us(ds) / 1e6 / {period}" for period, order in ((86400, daily), (604800, weekly)) for k in range(1, order + 1)]
    return [f"{wave}({angle})" for angle in angles for wave in ("sin", "cos")]


# Every reading twice, once with its sign turned.
_SQL_SIGNED = f"""SELECT user_id, sign, ts AS ds, sign * value AS y, CAST({SQL_K} AS DOUBLE) AS x, TRUE AS train
    FROM events, (VALUES (1), (-1)) AS t(sign)"""


@query(
    "series_coefficients",
    sql_least_squares(_SQL_SIGNED, "user_id, sign", [_DAYS, "x"])
    + """, c AS (SELECT user_id, sign, count(*) AS n FROM r GROUP BY ALL)
    SELECT user_id, sign, n, round(b[3], 6) AS per_k, round(b[2], 6) AS per_day FROM b JOIN c USING (user_id, sign) WHERE n > 5""",
)
def series_coefficients(spark, sf):
    """A model per place and sign: the coefficients of a series and of its mirror are opposite."""
    rows = events(spark, sf).select(
        "user_id", F.explode(F.array(F.lit(1), F.lit(-1))).alias("sign"), F.col("ts").alias("ds"), "value", payload_k().cast("double").alias("x")
    )
    rows = rows.withColumn("y", F.col("sign") * F.col("value"))
    model = regression.SeriesRegression(["x"], ["user_id", "sign"], daily=0).fit(rows).model
    return model.filter("n > 5").select(
        "user_id", "sign", "n", r6(F.col("beta")[1]).alias("per_k"), r6(F.col("beta")[0] / 365.25).alias("per_day")
    )


_SQL_HOURS = f"""SELECT event_type AS series, date_trunc('hour', ts) AS ds, avg(value) AS y, avg({SQL_K}) AS x,
    CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY ALL"""
_SQL_SPLIT = f"""SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) > 24 AS train FROM ({_SQL_HOURS})"""
_SQL_VALUE = "list_sum(list_transform(list_zip(b, v[1:len(b)]), lambda p: p[1] * p[2]))"


@query(
    "forecast_regressors",
    sql_least_squares(_SQL_SPLIT, "series", [_DAYS, *_sql_waves(2), "x", "n"])
    + f""", t AS (SELECT series, y, y - {_SQL_VALUE} AS e FROM r JOIN b USING (series) WHERE NOT train)
    SELECT series, round(sqrt(avg(e * e)), 5) AS rmse, round(avg(abs(e)), 5) AS mae,
        round(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)), 5) AS mape FROM t GROUP BY series""",
)
def forecast_regressors(spark, sf):
    """Hold-out forecast of each provider's hourly mean with payload and activity as regressors; a model per provider."""
    hourly = events(spark, sf).groupBy(F.col("event_type").alias("series"), hour_of("ts").alias("datetime")).agg(
        F.avg("value").alias("temperature_2m"),
        F.avg(payload_k()).alias("relative_humidity_2m"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    names = ["relative_humidity_2m", "n"]
    tested = forecast.holdout_forecast(hourly, "temperature_2m", names, "datetime", normalise=True, model=regression.SeriesRegression(names))
    return forecast.score(tested, keys=["series"]).withColumns({c: F.round(c, 5) for c in ("rmse", "mae", "mape")})


_BREAKS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00"]
_SQL_BENDS = [f"greatest((epoch_us(ds) - epoch_us(TIMESTAMP '{b}')) / 864e8, 0)" for b in _BREAKS]


def _hourly_means(spark, sf):
    return events(spark, sf).groupBy(F.col("event_type").alias("series"), hour_of("ts").alias("ds")).agg(F.avg("value").alias("y"))


@query(
    "forecast_fixed_breaks",
    sql_least_squares(f"SELECT *, TRUE AS train FROM ({_SQL_HOURS})", "series", [*_SQL_BENDS, _DAYS, *_sql_waves(2, 1)])
    + f""", f AS (SELECT series, unnest(generate_series(max(ds) + INTERVAL 1 HOUR, max(ds) + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS ds
        FROM r GROUP BY series),
    a AS (SELECT series, ds, [1.0, {", ".join([*_SQL_BENDS, _DAYS, *_sql_waves(2, 1)])}] AS v FROM f)
    SELECT series, ds, round({_SQL_VALUE}, 5) AS yhat FROM a JOIN b USING (series)""",
)
def forecast_fixed_breaks(spark, sf):
    """The next day of a trend that bends at two given times, with seasons of day and week."""
    model = regression.BrokenTrend(breaks=_BREAKS, daily=2, weekly=1).fit(_hourly_means(spark, sf))
    return model.predict(24).select("series", ntz("ds").alias("ds"), F.round("yhat", 5).alias("yhat"))


@query("forecast_change_points")
def forecast_change_points(spark, sf):
    """The next day of a trend whose breaks are chosen from 25 candidates per provider."""
    return regression.BrokenTrend(weekly=2).fit(_hourly_means(spark, sf)).predict(24).withColumn("ds", ntz("ds"))
