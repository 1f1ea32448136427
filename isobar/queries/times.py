"""Buckets, labels, zones, slots, text forms and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.functions import times as tf
from isobar.functions.ids import binary_text_id, concat_id
from isobar.queries.feed import sql_binary_id
from isobar.queries.registry import events, ntz, query, r8

_MINUTE = "date_part('minute', ts)"


def _near(spark, sf, slots, wrap=False):
    return events(spark, sf).filter(tf.near_slot("ts", slots, 2, wrap)).select("event_id", ntz("ts").alias("ts"))


@query("near_slot_hourly", f"SELECT event_id, ts FROM events WHERE {_MINUTE} <= 2")
def near_slot_hourly(spark, sf):
    return _near(spark, sf, "hourly")


@query(
    "near_slot_quarter",
    f"""SELECT event_id, ts FROM events WHERE abs({_MINUTE} - 0) <= 2 OR abs({_MINUTE} - 15) <= 2
        OR abs({_MINUTE} - 30) <= 2 OR abs({_MINUTE} - 45) <= 2""",
)
def near_slot_quarter(spark, sf):
    return _near(spark, sf, "quarter")


@query("near_slot_wrapped", f"SELECT event_id, ts FROM events WHERE {_MINUTE} <= 2 OR {_MINUTE} >= 58")
def near_slot_wrapped(spark, sf):
    return _near(spark, sf, "hourly", True)


@query(
    "bucket_15min",
    """SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS slot, count(*) AS n, round(avg(value), 8) AS avg_value
    FROM events GROUP BY ALL""",
)
def bucket_15min(spark, sf):
    slots = events(spark, sf).groupBy(tf.quarter_hour_of("ts").alias("slot"))
    return slots.agg(F.count(F.lit(1)).alias("n"), r8(F.avg("value")).alias("avg_value")).withColumn("slot", ntz("slot"))


@query(
    "round_nearest_hour",
    """SELECT date_trunc('hour', ts + INTERVAL 30 MINUTE) AS slot, count(*) AS n FROM events GROUP BY ALL""",
)
def round_nearest_hour(spark, sf):
    return (
        events(spark, sf).groupBy(tf.nearest_hour("ts").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("slot", ntz("slot"))
    )


@query(
    "time_labels",
    """SELECT event_id, strftime(ts, '%m-%d %H:%M') AS label, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
        strftime(ts, '%Y-%m-%dT%H:%M') AS t_text, strftime(ts, '%Y-%m-%d %H:%M') || ':00-07' AS sql_text
    FROM events""",
)
def time_labels(spark, sf):
    return events(spark, sf).select(
        "event_id",
        tf.label("ts").alias("label"),
        tf.iso_text("ts").alias("iso"),
        tf.t_text("ts").alias("t_text"),
        tf.append_seconds(tf.t_text("ts"), ":00-07").alias("sql_text"),
    )


@query(
    "zone_shift",
    "SELECT event_id, ts - INTERVAL 10 HOUR AS shifted FROM events",
)
def zone_shift(spark, sf):
    return events(spark, sf).select("event_id", tf.shift_zone("ts").alias("shifted"))


@query(
    "epoch_zoned_text",
    """SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') || '+07:00' AS zoned,
        epoch_us(ts) // 1000 AS millis FROM events""",
)
def epoch_zoned_text(spark, sf):
    rows = events(spark, sf)
    return rows.select(
        "event_id", tf.zoned_text(F.unix_seconds("ts")).alias("zoned"), F.unix_millis("ts").alias("millis")
    )


@query(
    "wall_clock_hour",
    "SELECT event_id, date_trunc('hour', ts + INTERVAL 7 HOUR) AS local_hour FROM events",
)
def wall_clock_hour(spark, sf):
    local = tf.hour_of(tf.wall_clock("ts").cast("timestamp"))
    return events(spark, sf).select("event_id", ntz(local).alias("local_hour"))


@query(
    "date_arithmetic",
    """SELECT event_id, ts - INTERVAL 2 HOUR AS two_hours_before, CAST(ts AS DATE) - 3 AS three_days_before
    FROM events""",
)
def date_arithmetic(spark, sf):
    return events(spark, sf).select(
        "event_id",
        ntz(F.col("ts") - F.expr("INTERVAL 2 HOURS")).alias("two_hours_before"),
        F.date_sub(F.to_date("ts"), 3).alias("three_days_before"),
    )


@query(
    "multi_format_timestamp",
    """SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts)
        WHEN 'view' THEN date_trunc('minute', ts) WHEN 'purchase' THEN date_trunc('minute', ts)
        WHEN 'signup' THEN ts END AS parsed FROM events""",
)
def multi_format_timestamp(spark, sf):
    """Every type writes its time in another form; errors write one that cannot be read."""
    rows = events(spark, sf)
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "click", tf.zoned_text(F.unix_seconds(ts)))
        .when(kind == "view", F.date_format(ts, tf.T_FORM))
        .when(kind == "purchase", F.date_format(ts, tf.PLAIN_FORM))
        .when(kind == "signup", F.date_format(ts, tf.CREATED_FORM))
        .otherwise(F.lit("no time"))
    )
    return rows.select("event_id", ntz(tf.parse_mixed_time(text)).alias("parsed"))


@query(
    "record_id_sha256",
    """SELECT event_id, sha256(event_type || strftime(ts, '%Y-%m-%dT%H:%M')) AS record_id FROM events""",
)
def record_id_sha256(spark, sf):
    return events(spark, sf).select("event_id", concat_id("event_type", tf.t_text("ts")).alias("record_id"))


@query(
    "record_id_binary_sha256",
    f"SELECT event_id, {sql_binary_id('CAST(epoch_us(ts) // 1000 AS VARCHAR)')} AS record_id FROM events",
)
def record_id_binary_sha256(spark, sf):
    return events(spark, sf).select(
        "event_id", binary_text_id(F.unix_millis("ts").cast("string")).alias("record_id")
    )


@query(
    "name_replacements",
    """SELECT event_id, replace(CAST(value AS VARCHAR), '.', '_') || '_data_'
        || regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), '[ .:]', '_', 'g') || '.csv' AS file_name,
        contains(event_type, 'i') AS has_i, starts_with(event_type, 's') AS starts_s FROM events""",
)
def name_replacements(spark, sf):
    stamp = F.regexp_replace(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "[ .:]", "_")
    value = F.replace(F.col("value").cast("string"), F.lit("."), F.lit("_"))
    return events(spark, sf).select(
        "event_id",
        F.concat(value, F.lit("_data_"), stamp, F.lit(".csv")).alias("file_name"),
        F.col("event_type").contains("i").alias("has_i"),
        F.col("event_type").startswith("s").alias("starts_s"),
    )
