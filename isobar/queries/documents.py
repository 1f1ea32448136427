"""Provider messages, documents, flattening, exports and the jobs over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.functions.paths import json_path
from isobar.functions.times import JAKARTA, parse_mixed_time
from isobar.operators.project import standardize_names, weather_data_rows, weather_summary_rows
from isobar.operators.reshape import content_id_documents, flatten_by_leaf, flatten_by_path
from isobar.plans.exports import dataset, mapped_dataset
from isobar.plans.hourly import hourly_aggregate, provider_hours
from isobar.plans.serving import data_backfill, increment_rows, summary_backfill
from isobar.queries.feed import SQL_DOCS, SQL_ID, all_documents, documents, message_log
from isobar.queries.registry import SQL_K, events, ntz, payload_k, query, r6
from isobar.schemas import COMMON_MEASURES, FREE_WEATHER, OPEN_METEO, OPEN_WEATHER
from isobar.sources.documents import align_to_header, export_mapped, find, sorted_columns
from isobar.sources.messages import (
    envelope_records,
    good_records,
    parse_envelopes,
    parse_json,
    rejected_records,
)

SQL_FREE = f"(SELECT * FROM {SQL_DOCS} WHERE topic = 'free-weather')"
_LOCAL = "strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M')"


@query(
    "free_weather_documents",
    f"""SELECT {SQL_ID} AS _id, 'FreeWeatherAPI' AS provider, 'Malang' AS name, lat, lon, value AS temp_c,
        k AS humidity, event_type AS condition, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
        {_LOCAL} AS last_updated FROM {SQL_FREE}""",
)
def free_weather_documents(spark, sf):
    docs = documents(spark, sf, FREE_WEATHER)
    return docs.select(
        "_id", "provider", "location.name", "location.lat", "location.lon", "current_weather.temp_c",
        "current_weather.humidity", F.col("current_weather.condition.text").alias("condition"),
        "created_at", "last_updated",
    )


@query(
    "open_weather_documents",
    f"""SELECT {SQL_ID} AS _id, 'OpenWeatherMap' AS provider, 'ID' AS country, lat, lon,
        round(value + 273.15, 6) AS temp, 1000 + k AS pressure, 900 + k AS pressure_ground_level,
        CASE WHEN k >= 50 THEN 10000 ELSE 0 END AS visibility, k AS wind_dir, k AS clouds,
        event_type AS description, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') || '+07:00' AS last_updated
    FROM {SQL_DOCS} WHERE topic = 'open-weather'""",
)
def open_weather_documents(spark, sf):
    docs = documents(spark, sf, OPEN_WEATHER)
    main = F.col("current_weather.main")
    return docs.select(
        "_id", "provider", "location.country", "location.lat", "location.lon",
        r6(main["temp"]).alias("temp"), main["pressure"].alias("pressure"),
        main["pressure_ground_level"].alias("pressure_ground_level"),
        main["visibility"].alias("visibility"), main["wind_dir"].alias("wind_dir"),
        F.col("current_weather.clouds.all").alias("clouds"),
        F.col("current_weather.weather")[0]["description"].alias("description"), "last_updated",
    )


@query(
    "open_meteo_documents",
    f"""SELECT {SQL_ID} AS _id, 'Open-Meteo' AS provider, lat, lon, lat AS grid_lat, lon AS grid_lon,
        value AS temperature_2m, k AS weather_code,
        strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M') AS last_updated
    FROM {SQL_DOCS} WHERE topic = 'open-meteo'""",
)
def open_meteo_documents(spark, sf):
    return documents(spark, sf, OPEN_METEO).select(
        "_id", "provider", "location.lat", "location.lon", "location.grid_lat", "location.grid_lon",
        "current_weather.temperature_2m", "current_weather.weather_code", "last_updated",
    )


@query(
    "content_id_documents",
    f"""SELECT user_id, {_LOCAL} AS last_updated, 1 AS ids, count(*) AS polls
    FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL""",
)
def content_ids(spark, sf):
    """Polls of one place and minute share an id when it is made from the content."""
    parsed = good_records(parse_envelopes(message_log(spark, sf), FREE_WEATHER))
    # The local time is part of the location, so equal ids are equal places and minutes.
    docs = content_id_documents(parsed, F.col("timestamp"))
    place = (F.col("location.lat") * -16).cast("long").alias("user_id")
    ids = F.countDistinct("_id").cast("int").alias("ids")
    return docs.groupBy(place, "last_updated").agg(ids, F.count(F.lit(1)).alias("polls"))


@query(
    "envelope_sink",
    f"""SELECT event_type AS topic, event_type AS provider, user_id / 16.0 AS latitude, value AS temp,
        {SQL_K} AS k FROM events""",
)
def envelope_sink(spark, sf):
    """Messages as the log sink gets them, read back from their JSON."""
    rows = events(spark, sf).select(
        "event_type",
        (F.col("user_id") / 16.0).alias("latitude"),
        F.lit(112.5).alias("longitude"),
        F.struct(F.col("value").alias("temp"), payload_k().alias("k")).alias("data"),
    )
    sent = envelope_records(rows, F.col("event_type"), F.col("event_type"))
    return sent.select(
        "topic",
        json_path("value", "provider").alias("provider"),
        json_path("value", "latitude").cast("double").alias("latitude"),
        json_path("value", "data.temp").cast("double").alias("temp"),
        json_path("value", "data.k").cast("long").alias("k"),
    )


@query(
    "rejected_messages",
    """SELECT event_id AS "offset", props AS value FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def rejected_messages(spark, sf):
    """Payload texts are JSON but no envelopes, so they go to the quarantine; the good messages among them do not."""
    good = message_log(spark, sf).filter(F.col("topic") == FREE_WEATHER)
    rows = events(spark, sf).filter(~F.col("event_type").isin("click", "view")).select(
        F.lit(FREE_WEATHER).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("props").cast("binary").alias("value"),
    )
    mixed = rows.unionByName(good.select(*rows.columns))
    return rejected_records(parse_envelopes(mixed, FREE_WEATHER)).select("offset", "value")


@query(
    "tolerant_json",
    """SELECT event_id, k AS as_double, k AS as_int, CASE WHEN event_type = 'error' THEN text END AS bad_text
    FROM (SELECT event_id, event_type, k, '{' || props AS text
        FROM (SELECT *, CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k
            FROM events))""",
)
def tolerant_json(spark, sf):
    """Integers where doubles are declared and the reverse are read; broken text is kept aside."""
    from isobar.schemas import record

    number = F.get_json_object("props", "$.k")
    text = F.when(
        F.col("event_type") == "error", F.concat(F.lit("{"), F.col("props"))
    ).otherwise(F.concat(F.lit('{"as_double": '), number, F.lit(', "as_int": '), number, F.lit(".0}")))
    rows = events(spark, sf).select("event_id", text.alias("text"))
    parsed = rows.withColumn("p", parse_json(F.col("text"), record("as_double DOUBLE, as_int INT")))
    return parsed.select("event_id", "p.as_double", "p.as_int", F.col("p._corrupt_record").alias("bad_text"))


def _nested(spark, sf):
    k = payload_k()
    item = lambda n: F.struct(n.alias("code"), F.when(n % 2 == 0, F.col("event_type")).alias("text"))
    return events(spark, sf).select(
        F.col("event_id").alias("_id"),
        F.struct(
            F.col("user_id").alias("name"),
            F.struct(F.col("value").alias("c"), k.alias("name")).alias("temp"),
        ).alias("place"),
        F.array(item(k), item(k + 1)).alias("sky"),
        F.array(k, k * 2).alias("levels"),
    )


@query(
    "flatten_path",
    f"""SELECT event_id AS _id, user_id AS place_name, value AS place_temp_c, k AS place_temp_name,
        k AS sky_0_code, CASE WHEN k % 2 = 0 THEN event_type END AS sky_0_text,
        k + 1 AS sky_1_code, CASE WHEN (k + 1) % 2 = 0 THEN event_type END AS sky_1_text,
        '[' || k || ', ' || k * 2 || ']' AS levels FROM (SELECT *, {SQL_K} AS k FROM events)""",
)
def flatten_path(spark, sf):
    return flatten_by_path(_nested(spark, sf), items={"sky": 2})


def _sql_listed():
    columns = []
    for i in range(3):
        there = f"k % 3 >= {i}"
        columns.append(f"CASE WHEN {there} THEN k + {i} END AS sky_{i}_code")
        columns.append(f"CASE WHEN {there} THEN k * 10 + {i} END AS sky_{i}_parts_0_y")
        second = f"CASE WHEN {there} THEN k * 20 + {i} END" if i == 1 else "CAST(NULL AS BIGINT)"
        columns.append(f"{second} AS sky_{i}_parts_1_y")
    return f"SELECT CAST(event_id AS VARCHAR) AS _id, {', '.join(columns)} FROM (SELECT *, {SQL_K} AS k FROM events)"


@query("csv_list_elements", _sql_listed())
def csv_list_elements(spark, sf):
    """One to three list elements per document, each with a list of one or two inside."""
    k = payload_k()

    def item(i):
        parts = [F.struct((k * 10 * (j + 1) + i).alias("y")) for j in range(1 + i % 2)]
        return F.struct((k + i).alias("code"), F.array(*parts).alias("parts"))

    sky = F.slice(F.array(*[item(i) for i in range(3)]), F.lit(1), (k % 3 + 1).cast("int"))
    return dataset(events(spark, sf).select(F.col("event_id").cast("string").alias("_id"), sky.alias("sky")))


@query(
    "flatten_leaf",
    f"""SELECT event_id AS _id, k AS name, value AS c, k + 1 AS code, event_type AS text, k AS level_0
    FROM (SELECT *, {SQL_K} AS k FROM events)""",
)
def flatten_leaf(spark, sf):
    flat = flatten_by_leaf(_nested(spark, sf))
    return flat.withColumn("level_0", F.col("levels")[0]).drop("levels")


@query(
    "json_path_extract",
    f"""SELECT event_id, CAST({SQL_K} AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS missing, event_type AS kind
    FROM events""",
)
def json_path_extract(spark, sf):
    return export_mapped(
        events(spark, sf),
        {"event_id": "event_id", "k": json_path("props", "k"), "missing": json_path("props", "a.b"), "kind": "event_type"},
    )


@query(
    "standardize_names",
    f"""SELECT lat AS latitude, lon AS longitude, {_LOCAL} AS date, value AS temperature_c, k AS feels_like_c,
        k AS humidity_pct, value / 4 AS wind_speed_kmph, value / 2 AS wind_gust_kmph, 1000.0 + k AS pressure,
        k AS cloud_total_pct FROM {SQL_FREE}""",
)
def standardized(spark, sf):
    flat = flatten_by_leaf(documents(spark, sf, FREE_WEATHER))
    return standardize_names(flat).drop("wind_degree")


_MEASURES = {
    "temperature_c": "value",
    "feels_like_c": "k",
    "humidity_pct": "k",
    "wind_speed_kmph": "value / 4",
    "wind_gust_kmph": "value / 2",
    "pressure": "1000 + k",
    "cloud_total_pct": "k",
}
_SQL_HOURS = ", ".join(f"avg({source}) AS {name}" for name, source in _MEASURES.items())
_SQL_PROVIDER_HOURS = f"""(SELECT topic, 'Malang' AS location_name, lat AS latitude, lon AS longitude,
    date_trunc('hour', ts) AS timestamp, {_SQL_HOURS} FROM {SQL_DOCS} GROUP BY ALL)"""


@query(
    "provider_hours",
    "SELECT topic, location_name, latitude, longitude, timestamp, "
    + ", ".join(f"round({name}, 6) AS {name}" for name in _MEASURES)
    + f" FROM {_SQL_PROVIDER_HOURS}",
)
def provider_hour_means(spark, sf):
    """Standardized, unit-fixed and time-aligned hourly means of each provider."""
    hours = provider_hours(all_documents(spark, sf), JAKARTA).withColumnRenamed("provider", "topic")
    return hours.withColumns({"timestamp": ntz("timestamp"), **{c: r6(c) for c in COMMON_MEASURES}})


SQL_AGGREGATE = (
    "SELECT location_name, latitude, longitude, timestamp, "
    + ", ".join(f"round(avg({name}), 6) AS avg_{name}" for name in _MEASURES)
    + f" FROM {_SQL_PROVIDER_HOURS} GROUP BY ALL"
)


@query("hourly_aggregate_job", SQL_AGGREGATE)
def hourly_aggregate_job(spark, sf):
    """Three message logs to hourly means over providers."""
    out = hourly_aggregate(spark, all_documents(spark, sf), zone=JAKARTA)
    return out.withColumns({"timestamp": ntz("timestamp"), **{f"avg_{c}": r6(f"avg_{c}") for c in COMMON_MEASURES}})


@query(
    "hourly_aggregate_recent",
    "SELECT location_name, latitude, longitude, timestamp, "
    + ", ".join(f"round(avg({name}), 6) AS avg_{name}" for name in _MEASURES)
    + " FROM "
    + _SQL_PROVIDER_HOURS.replace("GROUP BY ALL", "WHERE ts >= TIMESTAMP '2024-01-30 22:10:00' GROUP BY ALL")
    + " GROUP BY ALL",
)
def hourly_aggregate_recent(spark, sf):
    """The same over documents created within two hours of a moment."""
    as_of = F.lit("2024-01-31 00:10:00").cast("timestamp")
    out = hourly_aggregate(spark, all_documents(spark, sf), as_of, zone=JAKARTA)
    return out.withColumns({"timestamp": ntz("timestamp"), **{f"avg_{c}": r6(f"avg_{c}") for c in COMMON_MEASURES}})


@query(
    "summary_backfill",
    "SELECT location_name, latitude, longitude, timestamp, "
    + ", ".join(f"round(avg({name}), 6) AS {name}" for name in _MEASURES)
    + f" FROM {_SQL_PROVIDER_HOURS} WHERE latitude <> -1.0 GROUP BY ALL",
)
def summary_backfill_job(spark, sf):
    """Stored aggregates, some twice and some rejected, as summary rows."""
    aggregate = hourly_aggregate(spark, all_documents(spark, sf), zone=JAKARTA, newest_first=False)
    stored = aggregate.withColumns(
        {
            "_id": F.concat_ws("/", F.col("latitude").cast("string"), F.col("timestamp").cast("string")),
            "created_at": F.lit("now"),
            "avg_date": F.lit(None).cast("string"),
        }
    )
    rejects = stored.filter("latitude = -1.0").select("_id")
    rows = summary_backfill(stored, rejects)
    return rows.withColumns({"timestamp": ntz("timestamp"), **{c: r6(c) for c in COMMON_MEASURES}})


@query(
    "summary_backfill_one_place",
    "SELECT location_name, latitude, longitude, timestamp, round(avg(temperature_c), 6) AS temperature_c"
    f" FROM {_SQL_PROVIDER_HOURS} WHERE latitude = -2.5 GROUP BY ALL",
)
def summary_backfill_one_place(spark, sf):
    aggregate = hourly_aggregate(spark, all_documents(spark, sf), zone=JAKARTA, newest_first=False)
    rows = summary_backfill(aggregate, latitude=-2.5)
    return rows.select(
        "location_name", "latitude", "longitude", ntz("timestamp").alias("timestamp"), r6("temperature_c").alias("temperature_c")
    )


@query(
    "data_backfill",
    f"""SELECT DISTINCT 'FreeWeatherAPI' AS provider, 'Malang' AS name, lat, lon,
        time_bucket(INTERVAL 15 MINUTE, date_trunc('minute', ts)) AS timestamp, value AS temp_c, event_type AS text,
        k AS humidity, k / 10 AS precip_mm, value / 2 AS gust_kph FROM {SQL_FREE}
    WHERE date_part('minute', ts) % 15 <= 2 OR date_part('minute', ts) IN (13, 14, 28, 29, 43, 44)""",
)
def data_backfill_job(spark, sf):
    rows = data_backfill(documents(spark, sf, FREE_WEATHER), zone=JAKARTA)
    return rows.select(
        "provider", "name", "lat", "lon", ntz("timestamp").alias("timestamp"), "temp_c", "text", "humidity",
        "precip_mm", "gust_kph",
    )


@query(
    "serving_rows",
    f"""SELECT 'FreeWeatherAPI' AS provider, lat, lon, date_trunc('minute', ts) AS timestamp, value AS temp_c,
        0.0 AS temp_f, k AS code, '' AS wind_dir, k / 10 AS precip_mm, 0.0 AS uv FROM {SQL_FREE}""",
)
def serving_rows(spark, sf):
    """Documents with a default for every field they lack."""
    flat = flatten_by_leaf(documents(spark, sf, FREE_WEATHER))
    rows = weather_data_rows(flat, parse_mixed_time("last_updated", JAKARTA))
    return rows.select(
        "provider", "lat", "lon", ntz("timestamp").alias("timestamp"), "temp_c", "temp_f", "code", "wind_dir",
        "precip_mm", "uv",
    )


@query(
    "summary_rows",
    f"""SELECT 'Malang' AS location_name, lat AS latitude, lon AS longitude, date_trunc('minute', ts) AS timestamp,
        k AS cloud_total_pct, value / 4 AS wind_speed_kmph, 1000.0 + k AS pressure, k AS humidity_pct,
        value AS temperature_c, k AS feels_like_c, value / 2 AS wind_gust_kmph FROM {SQL_FREE}""",
)
def summary_rows(spark, sf):
    flat = flatten_by_leaf(documents(spark, sf, FREE_WEATHER))
    rows = weather_summary_rows(flat, parse_mixed_time("last_updated", JAKARTA))
    return rows.withColumn("timestamp", ntz("timestamp"))


def _sql_increment(bucket, as_of):
    return f"""SELECT 'Malang' AS place, lat, lon, {bucket} AS timestamp, value AS temp
    FROM {SQL_FREE} WHERE ts <= TIMESTAMP '{as_of}' ORDER BY ts DESC LIMIT 1"""


@query("increment_quarter", _sql_increment("time_bucket(INTERVAL 15 MINUTE, ts)", "2024-01-28 13:20:00"))
def increment_quarter(spark, sf):
    as_of = F.lit("2024-01-28 13:20:00").cast("timestamp")
    row = increment_rows(documents(spark, sf, FREE_WEATHER), "quarter", as_of, JAKARTA)
    return row.select(
        F.col("name").alias("place"), "lat", "lon", ntz("timestamp").alias("timestamp"), F.col("temp_c").alias("temp")
    )


@query("increment_hour", _sql_increment("date_trunc('hour', ts)", "2024-02-10 08:00:00"))
def increment_hour(spark, sf):
    as_of = F.lit("2024-02-10 08:00:00").cast("timestamp")
    row = increment_rows(documents(spark, sf, FREE_WEATHER), "hour", as_of, JAKARTA)
    return row.select(
        F.col("location_name").alias("place"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        ntz("timestamp").alias("timestamp"), F.col("temperature_c").alias("temp"),
    )


@query(
    "csv_header_sorted",
    f"""SELECT {SQL_ID} AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
        k AS current_weather_clouds_all, round(value + 273.15, 6) AS current_weather_main_temp,
        event_type AS current_weather_weather_0_description, k AS current_weather_weather_0_id, lat AS location_lat
    FROM {SQL_DOCS} WHERE topic = 'open-weather'""",
)
def csv_header_sorted(spark, sf):
    """Path-flattened documents with sorted columns; some of the columns."""
    flat = dataset(documents(spark, sf, OPEN_WEATHER))
    header = [
        "_id", "created_at", "current_weather_clouds_all", "current_weather_main_temp",
        "current_weather_weather_0_description", "current_weather_weather_0_id", "location_lat",
    ]
    return sorted_columns(align_to_header(flat, header)).withColumn(
        "current_weather_main_temp", r6("current_weather_main_temp")
    )


@query(
    "field_map_export",
    f"""SELECT {SQL_ID} AS id, 'FreeWeatherAPI' AS provider, 'Malang' AS location_name, 'East Java' AS region,
        'Indonesia' AS country, lat, lon, {_LOCAL} AS localtime, {_LOCAL} AS provider_last_updated, value AS temp_c,
        CAST(NULL AS DOUBLE) AS temp_f, 1 AS is_day, event_type AS weather_desc, k AS weather_code,
        CAST(NULL AS DOUBLE) AS wind_mph, value / 4 AS wind_kph, 1000.0 + k AS pressure_mb, k / 10 AS precip_mm,
        k AS humidity, k AS cloud_cover, CAST(k AS DOUBLE) AS feelslike_c, CAST(NULL AS DOUBLE) AS uv,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS doc_created_at, {_LOCAL} AS doc_last_updated FROM {SQL_FREE}""",
)
def field_map_export(spark, sf):
    return mapped_dataset(documents(spark, sf, FREE_WEATHER))


@query(
    "documents_find_newest",
    f"""SELECT {SQL_ID} AS _id, lat FROM {SQL_FREE} WHERE value > 20 ORDER BY ts DESC LIMIT 100""",
)
def documents_find_newest(spark, sf):
    docs = documents(spark, sf, FREE_WEATHER)
    return find(
        docs, F.col("current_weather.temp_c") > 20, ["_id", "location.lat"], [F.desc("created_at")], 100
    )
