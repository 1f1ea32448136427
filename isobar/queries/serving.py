"""Latest rows, finds, upserts, serving series and dashboard frames."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from isobar.functions.times import hour_of, quarter_hour_of
from isobar.operators import dashboard, forecast, serving
from isobar.operators.project import latest_projection, where_equal
from isobar.queries.registry import SQL_K, events, ntz, payload_k, query, r6
from isobar.sources.documents import find, page_after, scan_all, since, until_hour
from isobar.sources.files import read_table, replace_table


@query("latest_row", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_row(spark, sf):
    return serving.latest_row(events(spark, sf), "ts", "event_id").select("event_id", ntz("ts").alias("ts"), "value")


@query(
    "latest_row_per_place",
    """SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_row_per_place(spark, sf):
    return serving.latest_per_key(events(spark, sf), ["user_id"], "ts", "event_id").select(
        "user_id", "event_id", "value"
    )


def _today(spark, sf, as_of):
    moment = F.lit(as_of).cast("timestamp")
    picked = serving.latest_today_else_latest(events(spark, sf), "ts", moment, "event_id")
    return picked.select("event_id", ntz("ts").alias("ts"))


_SQL_TODAY = """SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '{as_of}'
    ORDER BY ts >= date_trunc('day', TIMESTAMP '{as_of}') DESC, ts DESC, event_id DESC LIMIT 1"""


@query("latest_of_today", _SQL_TODAY.format(as_of="2024-01-29 18:00:00"))
def latest_of_today(spark, sf):
    return _today(spark, sf, "2024-01-29 18:00:00")


@query("latest_today_else_latest", _SQL_TODAY.format(as_of="2024-02-01 09:00:00"))
def latest_today_else_latest(spark, sf):
    return _today(spark, sf, "2024-02-01 09:00:00")


@query("top_n_newest", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def top_n_newest(spark, sf):
    return serving.top_newest(events(spark, sf), 5, "ts", "event_id").select(
        "event_id", ntz("ts").alias("ts"), "value"
    )


@query(
    "document_find",
    """SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value >= 10
    ORDER BY ts DESC, event_id DESC LIMIT 100""",
)
def document_find(spark, sf):
    selector = (F.col("event_type") == "purchase") & (F.col("value") >= 10)
    return find(
        events(spark, sf), selector, ["event_id", "user_id", "value"], [F.desc("ts"), F.desc("event_id")], 100
    )


@query(
    "recent_two_hours",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 22:30:00' - INTERVAL 2 HOUR",
)
def recent_two_hours(spark, sf):
    as_of = F.lit("2024-01-30 22:30:00").cast("timestamp")
    return since(events(spark, sf), "ts", as_of).select("event_id", ntz("ts").alias("ts"))


@query(
    "until_full_hour",
    """SELECT event_type, count(*) AS n FROM events
    WHERE ts <= date_trunc('hour', TIMESTAMP '2024-01-20 12:45:00') GROUP BY ALL""",
)
def until_full_hour(spark, sf):
    as_of = F.lit("2024-01-20 12:45:00").cast("timestamp")
    return until_hour(events(spark, sf), "ts", as_of).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_SQL_KEYED = """(SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN '_design/' || o_orderkey
    ELSE lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS _id, o_totalprice FROM orders)"""


def _keyed_orders(spark, sf):
    key = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    design = F.concat(F.lit("_design/"), F.col("o_orderkey"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", design).otherwise(key).alias("_id"), "o_totalprice"
    )


@query("full_scan", f"SELECT * FROM {_SQL_KEYED} WHERE NOT starts_with(_id, '_design/')")
def full_scan(spark, sf):
    return scan_all(_keyed_orders(spark, sf))


@query(
    "keyset_page",
    f"""SELECT * FROM {_SQL_KEYED} WHERE _id > '000000500' AND NOT starts_with(_id, '_design/')
    ORDER BY _id LIMIT 500""",
)
def keyset_page(spark, sf):
    return page_after(_keyed_orders(spark, sf), "000000500", 500)


@query("equality_filter", "SELECT event_id, value FROM events WHERE event_type = 'view'")
def equality_filter(spark, sf):
    return where_equal(events(spark, sf), "event_type", "view").select("event_id", "value")


@query(
    "sorted_by_place_and_time",
    "SELECT user_id, ts, event_id FROM events ORDER BY user_id, ts",
)
def sorted_by_place_and_time(spark, sf):
    ordered = serving.sort_by_time(events(spark, sf), "user_id", "ts")
    return ordered.select("user_id", ntz("ts").alias("ts"), "event_id")


_STORED = "('click', 'view', 'signup')"


@query(
    "upsert_latest_wins",
    f"""SELECT user_id, hour, event_id, value FROM (SELECT *, date_trunc('hour', ts) AS hour,
        row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC,
            event_type NOT IN {_STORED} DESC) AS rn FROM events) WHERE rn = 1""",
)
def upsert_latest_wins(spark, sf):
    """Clicks, views and signups are stored; the others come in. One row per place and hour."""
    rows = events(spark, sf).select("user_id", hour_of("ts").alias("hour"), "ts", "event_id", "event_type", "value")
    stored = F.col("event_type").isin("click", "view", "signup")
    merged = serving.upsert_latest(rows.filter(stored), rows.filter(~stored), ["user_id", "hour"], ["ts"])
    return merged.select("user_id", ntz("hour").alias("hour"), "event_id", "value")


@query(
    "insert_if_absent",
    """WITH d AS (SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS _id, * FROM events)
    SELECT _id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY ts, event_id) AS rn
        FROM d WHERE event_type <> 'error')
    WHERE rn = 1 AND _id NOT IN (SELECT _id FROM d WHERE event_type = 'error')""",
)
def insert_if_absent(spark, sf):
    """One document per place and day, unless an error already holds its id."""
    rows = events(spark, sf).withColumn(
        "_id", F.concat(F.col("user_id").cast("string"), F.lit("/"), F.to_date("ts").cast("string"))
    )
    held = F.col("event_type") == "error"
    fresh = serving.insert_if_absent(rows.filter(~held), rows.filter(held), "_id", "ts", "event_id")
    return fresh.select("_id", "event_id")


def _weather_data(spark, sf):
    """Events as rows of the quarter-hour serving table, keyed by place."""
    k = payload_k()
    return events(spark, sf).select(
        F.col("user_id").alias("place"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("temp_c"),
        (F.col("value") + 1.5).alias("feelslike_c"),
        k.alias("humidity"),
        (k / 10).alias("precip_mm"),
        F.col("event_type").alias("icon"),
        (F.col("value") / 4).alias("wind_kph"),
        (k + 1000.0).alias("pressure_mb"),
        (F.col("value") / 2).alias("gust_kph"),
        k.alias("cloud"),
        "event_id",
    )


@query(
    "serving_series",
    f"""SELECT 'temperature' AS metric, event_id, CAST(value AS DOUBLE) AS value FROM events
    UNION ALL SELECT 'humidity', event_id, {SQL_K} FROM events
    UNION ALL SELECT 'precipitation', event_id, {SQL_K} / 10 FROM events
        WHERE date_part('minute', ts) <= 2""",
)
def serving_series(spark, sf):
    data = _weather_data(spark, sf)
    parts = []
    for metric, on_slot in (("temperature", False), ("humidity", False), ("precipitation", True)):
        rows = serving.serving_series(data, metric, "quarter", ["event_id"], on_slot)
        parts.append(rows.select(F.lit(metric).alias("metric"), "event_id", F.col("value").cast("double").alias("value")))
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "latest_projection",
    f"""SELECT value AS temp_c, value / 4 AS wind_kph, {SQL_K} + 1000.0 AS pressure, {SQL_K} AS humidity,
        value + 1.5 AS feelslike_c, value / 2 AS gust_kph, {SQL_K} AS cloud, round(1.5, 2) AS feels_like_gap
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""",
)
def latest_projection_row(spark, sf):
    newest = serving.latest_row(_weather_data(spark, sf), "timestamp", "event_id")
    return dashboard.feels_like_gap(latest_projection(newest, "quarter"))


_SQL_CARDS = f"""WITH s AS (SELECT user_id AS place, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, ts, event_id,
        value, {SQL_K} / 10 AS precip, event_type FROM events),
    c AS (SELECT place, slot, avg(value) AS t, avg(precip) AS p, arg_max(event_type, ts) AS icon FROM s GROUP BY ALL)
    SELECT place, slot AS timestamp, strftime(slot, '%m-%d %H:%M') AS Hour, round(t, 6) AS Temperature,
        round(p, 6) AS Precipitation, icon AS Icon
    FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY slot DESC) AS rn FROM c) WHERE rn <= 16"""


@query("timeline_cards", _SQL_CARDS)
def timeline_cards(spark, sf):
    data = _weather_data(spark, sf)
    series = [serving.serving_series(data, m, "quarter", ["place"]) for m in ("temperature", "precipitation", "icon")]
    cards = dashboard.data_cards(*series, slicing=16, mode="quarter", keys=["place"])
    return cards.withColumns(
        {"timestamp": ntz("timestamp"), "Temperature": r6("Temperature"), "Precipitation": r6("Precipitation")}
    )


@query(
    "timeline_cards_hourly",
    f"""WITH s AS (SELECT user_id AS place, date_trunc('hour', ts + INTERVAL 30 MINUTE) AS slot, ts, value,
        {SQL_K} / 10 AS precip, event_type, date_part('minute', ts) <= 2 AS on_slot FROM events),
    t AS (SELECT place, slot, avg(value) AS t FROM s GROUP BY ALL),
    p AS (SELECT place, slot, avg(precip) AS p, arg_max(event_type, ts) AS icon FROM s WHERE on_slot GROUP BY ALL)
    SELECT place, slot AS timestamp, strftime(slot, '%m-%d %H:%M') AS Hour, printf('%.2f', t) AS Temperature,
        printf('%.2f', p) AS Precipitation, icon AS Icon
    FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY slot DESC) AS rn FROM t JOIN p USING (place, slot))
    WHERE rn <= 8""",
)
def timeline_cards_hourly(spark, sf):
    data = _weather_data(spark, sf)
    temperature = serving.serving_series(data, "temperature", "quarter", ["place"])
    slotted = [serving.serving_series(data, m, "quarter", ["place"], True) for m in ("precipitation", "icon")]
    cards = dashboard.data_cards(temperature, *slotted, slicing=8, mode="hour", keys=["place"])
    return dashboard.card_text(cards).withColumn("timestamp", ntz("timestamp"))


# Trend and season in SQL over `s(series.., ds, y)`; {step} seconds, {slots} per day.
def sql_forecast(source: str, keys: str, step: int, periods: int) -> str:
    hours = "((epoch_us(ds) / 1e6 - 1577836800) / 3600.0)"
    return f"""WITH s AS ({source}),
    m AS (SELECT {keys}, max(ds) AS last, regr_slope(y, {hours}) AS slope, regr_intercept(y, {hours}) AS icept
        FROM s GROUP BY ALL),
    r AS (SELECT {keys}, CAST(floor(epoch_us(ds) / 1000000) AS BIGINT) % 86400 // {step} AS slot,
        avg(y - coalesce(slope, 0) * {hours} - coalesce(icept, y)) AS residual
        FROM s JOIN m USING ({keys}) GROUP BY ALL),
    f AS (SELECT {keys}, last + i * INTERVAL {step} SECOND AS ds, slope, icept
        FROM m, (SELECT unnest(range(1, {periods + 1})) AS i)),
    p AS (SELECT {keys}, ds, slope * {hours} + icept + coalesce(residual, 0) AS yhat FROM (
        SELECT *, CAST(floor(epoch_us(ds) / 1000000) AS BIGINT) % 86400 // {step} AS slot FROM f)
        LEFT JOIN r USING ({keys}, slot))"""


_SQL_SERIES = "SELECT event_type AS series, date_trunc('hour', ts) AS ds, avg(value) AS y FROM events GROUP BY ALL"


def _hourly_series(spark, sf):
    return events(spark, sf).groupBy(F.col("event_type").alias("series"), hour_of("ts").alias("ds")).agg(
        F.avg("value").alias("y")
    )


@query(
    "forecast_trend_season",
    sql_forecast(_SQL_SERIES, "series", 3600, 12) + " SELECT series, ds, round(yhat, 6) AS yhat FROM p",
)
def forecast_trend_season(spark, sf):
    ahead = forecast.forecast(_hourly_series(spark, sf), 12)
    return ahead.select("series", ntz("ds").alias("ds"), r6("yhat").alias("yhat"))


@query(
    "forecast_with_history",
    sql_forecast(
        "SELECT user_id AS series, time_bucket(INTERVAL 15 MINUTE, ts) AS ds, avg(value) AS y FROM events GROUP BY ALL",
        "series", 900, 16,
    )
    + """, h AS (SELECT series, ds, slope * ((epoch_us(ds) / 1e6 - 1577836800) / 3600.0) + icept
            + coalesce(residual, 0) AS yhat
        FROM (SELECT *, CAST(floor(epoch_us(ds) / 1000000) AS BIGINT) % 86400 // 900 AS slot FROM s JOIN m USING (series))
        LEFT JOIN r USING (series, slot))
    SELECT series, ds, round(yhat, 6) AS yhat FROM p UNION ALL SELECT series, ds, round(yhat, 6) FROM h""",
)
def forecast_with_history(spark, sf):
    rows = events(spark, sf).groupBy(F.col("user_id").alias("series"), quarter_hour_of("ts").alias("ds")).agg(
        F.avg("value").alias("y")
    )
    fitted = forecast.forecast(rows, 16, "15min", only_future=False)
    return fitted.select("series", ntz("ds").alias("ds"), r6("yhat").alias("yhat"))


@query(
    "future_grid",
    """SELECT event_type AS series, max(ts) + i * INTERVAL 1 HOUR AS ds
    FROM events, (SELECT unnest(range(1, 25)) AS i) GROUP BY event_type, i""",
)
def future_grid(spark, sf):
    last = events(spark, sf).groupBy(F.col("event_type").alias("series")).agg(F.max("ts").alias("ds"))
    return forecast.future_grid(last, 24).withColumn("ds", ntz("ds"))


@query(
    "regressors_joined",
    f"""WITH s AS (SELECT event_type AS series, date_trunc('hour', ts) AS ds, round(avg({SQL_K}), 6) AS k,
        FROM events GROUP BY ALL),
    g AS (SELECT series, max(ds) - 48 * INTERVAL 1 HOUR + i * INTERVAL 1 HOUR AS ds
        FROM s, (SELECT unnest(range(1, 49)) AS i) GROUP BY series, i)
    SELECT series, ds, k FROM g LEFT JOIN s USING (series, ds)""",
)
def regressors_joined(spark, sf):
    """The grid of the last 48 hours with the regressor known for them."""
    known = events(spark, sf).groupBy(F.col("event_type").alias("series"), hour_of("ts").alias("ds")).agg(
        r6(F.avg(payload_k())).alias("k")
    )
    start = known.groupBy("series").agg((F.max("ds") - F.expr("INTERVAL 48 HOURS")).alias("ds"))
    joined = forecast.with_regressors(forecast.future_grid(start, 48), known, ["k"])
    return joined.withColumn("ds", ntz("ds"))


_SQL_METRICS = f"""SELECT place, metric, ds, avg(y) AS y FROM (
    SELECT user_id AS place, date_trunc('hour', ts) AS ds, unnest([
        {{'metric': 'temperature', 'y': CAST(value AS DOUBLE)}}, {{'metric': 'humidity', 'y': CAST({SQL_K} AS DOUBLE)}},
        {{'metric': 'feels_like', 'y': value + 1.5}}, {{'metric': 'precipitation', 'y': {SQL_K} / 10}}], recursive := true)
    FROM events) GROUP BY ALL"""


@query(
    "dashboard_frame",
    sql_forecast(_SQL_METRICS, "place, metric", 3600, 12)
    + """, rows_ AS (SELECT place, metric, ds, y AS v FROM (SELECT *, row_number() OVER (
            PARTITION BY place, metric ORDER BY ds DESC) AS rn FROM s) WHERE rn <= 8
        UNION ALL SELECT place, metric, ds, yhat FROM p)
    SELECT place, ds AS slot, strftime(ds, '%m-%d %H:%M') AS Hour,
        round(avg(v) FILTER (metric = 'temperature'), 6) AS Temperature,
        round(avg(v) FILTER (metric = 'humidity'), 6) AS Humidity,
        round(avg(v) FILTER (metric = 'feels_like'), 6) AS Feels_Like,
        round(avg(v) FILTER (metric = 'precipitation'), 6) AS Precipitation
    FROM rows_ GROUP BY place, ds""",
)
def dashboard_frame(spark, sf):
    columns = {"temperature": "temp_c", "humidity": "humidity", "feels_like": "feelslike_c", "precipitation": "precip_mm"}
    hourly = _weather_data(spark, sf).withColumn("timestamp", hour_of("timestamp"))
    stacked = dashboard.stack_metrics(hourly, columns, ["place"])
    frame = dashboard.dashboard_frame(stacked, "hour", ["place"])
    rounded = {c: r6(c) for c in ("Temperature", "Humidity", "Feels_Like", "Precipitation")}
    return frame.withColumns({"slot": ntz("slot"), **rounded})


@query(
    "score_forecast",
    f"""SELECT event_type, round(sqrt(avg((value - k) * (value - k))), 6) AS rmse,
        round(avg(abs(value - k)), 6) AS mae,
        round(avg(abs(value - k) / greatest(abs(value), 2.220446049250313e-16)), 6) AS mape
    FROM (SELECT *, {SQL_K} AS k FROM events) GROUP BY ALL""",
)
def score_forecast(spark, sf):
    rows = events(spark, sf).withColumn("k", payload_k())
    return forecast.score(rows, "value", "k", ["event_type"]).withColumns({c: r6(c) for c in ("rmse", "mae", "mape")})


def _hourly_regressors(spark, sf):
    return events(spark, sf).groupBy(F.col("event_type").alias("series"), hour_of("ts").alias("datetime")).agg(
        F.avg("value").alias("temperature_2m"), F.avg(payload_k()).alias("relative_humidity_2m")
    )


@query(
    "forecast_one_regressor",
    f"""WITH h AS (SELECT event_type AS series, date_trunc('hour', ts) AS ds, avg(value) AS y, avg({SQL_K}) AS x,
        (epoch(date_trunc('hour', ts)) - 1705276800) / 31557600.0 AS t FROM events GROUP BY ALL),
    m AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) <= 24 AS is_test FROM h),
    l AS (SELECT series, avg(y) AS level FROM m WHERE NOT is_test GROUP BY series),
    r AS (SELECT m.*, level, y - level AS c FROM m JOIN l USING (series)),
    a AS (SELECT avg(t) AS mt, avg(x) AS mx, avg(c) AS mc FROM r WHERE NOT is_test),
    q AS (SELECT sum((t - mt) ** 2) AS tt, sum((x - mx) ** 2) AS xx, sum((t - mt) * (x - mx)) AS tx,
        sum((t - mt) * (c - mc)) AS tc, sum((x - mx) * (c - mc)) AS xc FROM r, a WHERE NOT is_test),
    b AS (SELECT (tc * xx - xc * tx) / (tt * xx - tx * tx) AS bt, (xc * tt - tc * tx) / (tt * xx - tx * tx) AS bx FROM q)
    SELECT series, ds, round(y, 6) AS y, round(level + mc + bt * (t - mt) + bx * (x - mx), 5) AS yhat
    FROM r, a, b WHERE is_test""",
)
def forecast_one_regressor(spark, sf):
    """Hold-out forecast with a trend and one regressor: its normal equations have a closed form."""
    tested = forecast.holdout_forecast(
        _hourly_regressors(spark, sf), "temperature_2m", ["relative_humidity_2m"], "datetime", daily=0, ridge=0.0
    )
    return tested.select("series", ntz("ds").alias("ds"), r6("y").alias("y"), F.round("yhat", 5).alias("yhat"))


@query("table_replaced", "SELECT event_id, value FROM events WHERE event_type <> 'click'")
def table_replaced(spark, sf):
    """A table of the catalog that is replaced, and scanned in full."""
    name = f"replaced_{uuid.uuid4().hex}"
    rows = events(spark, sf)
    replace_table(rows.select("event_id", F.lit(0.0).alias("old")), name)
    replace_table(rows.filter("event_type <> 'click'").select("event_id", "value"), name)
    return read_table(spark, name)
