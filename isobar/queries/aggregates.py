"""Means, unions, unit switches and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.functions.times import hour_of
from isobar.operators.aggregate import (
    fix_kelvin,
    fix_kelvin_by_provider,
    group_means,
    hourly_means,
    mean_of_means,
    mean_over_frames,
    round_coordinates,
    scale_units,
    union_all,
    union_common,
)
from isobar.operators.project import drop_present, strip_prefix, with_constants, with_location
from isobar.operators.quality import distinct_rows
from isobar.operators.serving import join_on_time, lookup
from isobar.queries.registry import (
    EVENT_TYPES,
    SQL_K,
    events,
    ntz,
    payload_k,
    query,
    r6,
    r8,
    table,
)
from isobar.sources.weather_codes import WEATHER_CODES, weather_codes


@query(
    "hourly_mean_by_provider",
    """SELECT event_type, user_id, date_trunc('hour', ts) AS timestamp, round(avg(value), 8) AS avg_value
    FROM events GROUP BY ALL""",
)
def hourly_mean_by_provider(spark, sf):
    means = hourly_means(events(spark, sf), "ts", ("event_type", "user_id"), ["value"])
    return means.select("event_type", "user_id", ntz("ts").alias("timestamp"), r8("value").alias("avg_value"))


@query(
    "mean_of_provider_means",
    """SELECT user_id, h AS timestamp, round(avg(v), 8) AS avg_value FROM (
        SELECT user_id, event_type, date_trunc('hour', ts) AS h, avg(value) AS v FROM events GROUP BY ALL)
    GROUP BY ALL""",
)
def mean_of_provider_means(spark, sf):
    rows = events(spark, sf).withColumn("timestamp", hour_of("ts"))
    out = mean_of_means(rows, "event_type", ["user_id", "timestamp"], ["value"])
    return out.select("user_id", ntz("timestamp").alias("timestamp"), r8("avg_value").alias("avg_value"))


@query(
    "common_column_union",
    f"""SELECT user_id, h AS timestamp, round(avg(v), 8) AS avg_value, round(avg(k), 8) AS avg_k FROM (
        SELECT user_id, event_type IN ('click', 'view') AS web, date_trunc('hour', ts) AS h,
            avg(value) AS v, avg({SQL_K}) AS k
        FROM events GROUP BY ALL) GROUP BY ALL""",
)
def common_column_union(spark, sf):
    """Two sources with different columns; the extra column of one is not common."""
    rows = events(spark, sf).withColumn("k", payload_k())
    web = F.col("event_type").isin("click", "view")
    first = hourly_means(rows.filter(web), "ts", ["user_id"], ["value", "k"])
    other = rows.filter(~web).withColumn("twice", F.col("value") * 2)
    second = hourly_means(other, "ts", ["user_id"], ["twice", "k", "value"])
    out = mean_over_frames([first, second], ["user_id", "ts"])
    return out.select(
        "user_id", ntz("ts").alias("timestamp"), r8("avg_value").alias("avg_value"), r8("avg_k").alias("avg_k")
    )


@query(
    "union_common_rows",
    """SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""",
)
def union_common_rows(spark, sf):
    buyers = table(spark, sf, "customer").withColumnsRenamed({"c_nationkey": "nationkey", "c_acctbal": "acctbal"})
    sellers = table(spark, sf, "supplier").withColumnsRenamed({"s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return union_common([buyers, sellers])


@query(
    "union_dedupe",
    """SELECT o_custkey AS custkey, o_orderdate AS seen FROM orders
    UNION SELECT c_custkey, NULL FROM customer""",
)
def union_dedupe(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("seen"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    return distinct_rows(union_all([orders, customers], fill=True))


SQL_READING = """(SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN value + 273.15
    ELSE value END AS reading FROM events)"""


def _readings(spark, sf):
    warm = F.col("event_type").isin("purchase", "signup")
    return events(spark, sf).withColumn("reading", F.when(warm, F.col("value") + 273.15).otherwise(F.col("value")))


@query(
    "unit_switch_kelvin",
    f"""SELECT event_id, event_type, round(CASE WHEN avg(reading) OVER (PARTITION BY event_type) > 273.15
        THEN reading - 273.15 ELSE reading END, 6) AS temperature_c FROM {SQL_READING}""",
)
def unit_switch_kelvin(spark, sf):
    fixed = fix_kelvin_by_provider(_readings(spark, sf), "event_type", EVENT_TYPES, ["reading"])
    return fixed.select("event_id", "event_type", r6("reading").alias("temperature_c"))


@query(
    "unit_switch_whole_frame",
    """SELECT event_id, round(CASE WHEN avg(value + 273.15) OVER () > 273.15 THEN value + 273.15 - 273.15
        ELSE value + 273.15 END, 6) AS temperature_c FROM events""",
)
def unit_switch_whole_frame(spark, sf):
    kelvin = events(spark, sf).select("event_id", (F.col("value") + 273.15).alias("temperature_c"))
    return fix_kelvin(kelvin).select("event_id", r6("temperature_c").alias("temperature_c"))


@query(
    "group_means_per_timestamp",
    """SELECT date_trunc('hour', ts) AS timestamp, round(avg(value), 10) AS value FROM events GROUP BY ALL""",
)
def group_means_per_timestamp(spark, sf):
    rows = events(spark, sf).withColumn("timestamp", hour_of("ts"))
    return group_means(rows, ["timestamp"], ["value"]).select(ntz("timestamp").alias("timestamp"), F.round("value", 10).alias("value"))


@query(
    "location_constants",
    """SELECT 'Malang' AS location_name, -7.95 AS latitude, 112.61 AS longitude,
        count(*) AS n, round(avg(value) * 3.6, 6) AS wind_speed_kmph FROM events""",
)
def location_constants(spark, sf):
    """Default place, rounded constant coordinates and a unit factor."""
    placed = with_constants(with_location(events(spark, sf)), latitude=-7.9512, longitude=112.6134)
    scaled = scale_units(round_coordinates(placed, 2), {"value": 3.6})
    return scaled.groupBy("location_name", "latitude", "longitude").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("wind_speed_kmph")
    )


@query(
    "strip_and_drop",
    """SELECT event_type, round(avg(value), 6) AS value FROM events GROUP BY ALL""",
)
def strip_and_drop(spark, sf):
    plain = drop_present(events(spark, sf), "props", "_rev", "ts", "no_such_column")
    means = group_means(plain, ["event_type"], ["value"], prefix="avg_")
    return strip_prefix(means).select("event_type", r6("value").alias("value"))


@query(
    "inner_join_on_time",
    """SELECT user_id, timestamp, t.v AS temperature, i.icon FROM (
        SELECT user_id, date_trunc('hour', ts) AS timestamp, round(avg(value), 6) AS v FROM events
        WHERE event_type <> 'error' GROUP BY ALL) t
    JOIN (SELECT user_id, date_trunc('hour', ts) AS timestamp, min(props) AS icon FROM events
        WHERE event_type <> 'view' GROUP BY ALL) i USING (user_id, timestamp)""",
)
def inner_join_on_time(spark, sf):
    rows = events(spark, sf).withColumn("timestamp", hour_of("ts"))
    keys = ["user_id", "timestamp"]
    temperature = rows.filter("event_type <> 'error'").groupBy(*keys).agg(r6(F.avg("value")).alias("temperature"))
    icons = rows.filter("event_type <> 'view'").groupBy(*keys).agg(F.min("props").alias("icon"))
    return join_on_time(temperature, icons, "timestamp", ["user_id"]).withColumn("timestamp", ntz("timestamp"))


@query(
    "dimension_lookup",
    """SELECT c_custkey, n_name, r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dimension_lookup(spark, sf):
    """Customers with nation and region; both lists have a fixed size."""
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup(lookup(customers, nations, "c_nationkey"), regions, "n_regionkey").select(
        "c_custkey", "n_name", "r_name"
    )


_CODE_ROWS = ", ".join(f"('{code}', '{text}')" for code, text in WEATHER_CODES.items())


@query(
    "weather_code_lookup",
    f"""SELECT code, description, count(*) AS n FROM (
        SELECT lpad(CAST({SQL_K} AS VARCHAR), 2, '0') AS code FROM events) e
    LEFT JOIN (VALUES {_CODE_ROWS}) w(code, description) USING (code) GROUP BY ALL""",
)
def weather_code_lookup(spark, sf):
    codes = events(spark, sf).select(F.lpad(payload_k().cast("string"), 2, "0").alias("code"))
    per_code = codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return lookup(per_code, weather_codes(spark), "code").select("code", "description", "n")
