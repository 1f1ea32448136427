"""Archive payloads, city histories, CSV and table round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators.aggregate import kelvin_to_celsius
from isobar.operators.project import with_metadata
from isobar.operators.serving import top_newest
from isobar.plans.archives import archive_tables, district_history, fill_gap, write_archive
from isobar.plans.city import city_history
from isobar.queries.registry import EVENT_TYPES, SQL_GAPPED, gapped_events, ntz, query, r6, table
from isobar.session import shared_folder
from isobar.sources.archive import hourly_rows, newest_file, parse_payloads, payload_parts, rejected_payloads
from isobar.sources.files import append_rows, iso_timestamps, read_csv, write_aggregate, write_csv

_FEATURES = ("temperature_2m", "cloud_cover")


def _payloads(spark, sf):
    """One payload text per vector: its values are hourly temperatures, its label the district.

    Every vector starts where the one before it ends, so a district has many payloads.
    """
    vectors = table(spark, sf, "embeddings")
    first = F.make_dt_interval(hours=(F.col("vec_id") * F.size("embedding")).cast("int"))
    start = F.lit("2017-01-01").cast("timestamp_ntz") + first
    values = F.transform("embedding", lambda x: x.cast("double"))
    times = F.transform(
        F.sequence(F.lit(0), F.size("embedding") - 1),
        lambda i: F.date_format(start + F.make_dt_interval(hours=i), "yyyy-MM-dd'T'HH:mm"),
    )
    lat, lon = -F.col("label") / 8.0, F.lit(112.5)
    hourly = F.struct(
        times.alias("time"),
        values.alias("temperature_2m"),
        F.transform(values, lambda x: x * 2).alias("cloud_cover"),
    )
    body = F.struct(
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(25200).alias("utc_offset_seconds"),
        F.lit("Asia/Bangkok").alias("timezone"),
        F.lit("GMT+7").alias("timezone_abbreviation"),
        hourly.alias("hourly"),
    )
    return vectors.select(
        "vec_id",
        F.concat(F.lit("district "), F.col("label").cast("string")).alias("district"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.to_json(body).alias("value"),
    )


_SQL_ROWS = """(SELECT vec_id, 'district ' || label AS district, -label / 8.0 AS latitude, 112.5 AS longitude,
    strftime(TIMESTAMP '2017-01-01' + CAST(vec_id * len(embedding) + i - 1 AS INT) * INTERVAL 1 HOUR,
        '%Y-%m-%dT%H:%M') AS time, CAST(embedding[i] AS DOUBLE) AS x, i
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""


@query(
    "parallel_arrays_to_rows",
    f"SELECT vec_id, time, round(x, 6) AS temperature_2m, round(x * 2, 6) AS cloud_cover FROM {_SQL_ROWS}",
)
def parallel_arrays_to_rows(spark, sf):
    parsed = parse_payloads(_payloads(spark, sf), features=_FEATURES)
    rows = hourly_rows(parsed, _FEATURES, ["vec_id"])
    return rows.withColumns({c: r6(c) for c in _FEATURES})


@query(
    "merged_archive_rows",
    f"""SELECT latitude AS lat, longitude AS lon, 25200 AS utc_offset_seconds, 'Asia/Bangkok' AS timezone,
        'GMT+7' AS timezone_abbreviation, time AS datetime, round(x, 6) AS temperature_2m FROM {_SQL_ROWS}""",
)
def merged_archive_rows(spark, sf):
    parsed = parse_payloads(_payloads(spark, sf), features=_FEATURES)
    return payload_parts(parsed, _FEATURES[:1], "datetime").withColumn("temperature_2m", r6("temperature_2m"))


@query(
    "archive_descriptors",
    """SELECT -label / 8.0 AS latitude, 112.5 AS longitude, 25200 AS utc_offset_seconds,
        'Asia/Bangkok' AS timezone, 'GMT+7' AS timezone_abbreviation FROM embeddings""",
)
def archive_descriptors(spark, sf):
    stamp = F.lit("2031-02-03 04:05:06.789012")
    return archive_tables(_payloads(spark, sf), stamp, _FEATURES)[0]


_SQL_MANIFEST = """(SELECT DISTINCT -label / 8.0 AS latitude, 112.5 AS longitude,
    replace(CAST(-label / 8.0 AS VARCHAR), '.', '_') || '_112_5_descriptor_2031-02-03_04_05_06_789012.csv'
        AS descriptor_file_name,
    replace(CAST(-label / 8.0 AS VARCHAR), '.', '_') || '_112_5_data_2031-02-03_04_05_06_789012.csv'
        AS data_file_name FROM embeddings)"""


@query("archive_manifest", f"SELECT * FROM {_SQL_MANIFEST}")
def archive_manifest(spark, sf):
    return archive_tables(_payloads(spark, sf), F.lit("2031-02-03 04:05:06.789012"), _FEATURES)[2]


@query("newest_archive_file", f"SELECT data_file_name FROM {_SQL_MANIFEST} ORDER BY data_file_name DESC LIMIT 1")
def newest_archive_file(spark, sf):
    names = archive_tables(_payloads(spark, sf), F.lit("2031-02-03 04:05:06.789012"), _FEATURES)[2]
    return newest_file(names).select("data_file_name")


@query(
    "archive_written",
    f"SELECT latitude, longitude, time AS datetime, round(x, 6) AS temperature_2m FROM {_SQL_ROWS}",
)
def archive_written(spark, sf):
    """Payloads written twice as CSV by location after their manifest, and the data read back."""
    folder = shared_folder(spark, "archive")
    for _ in range(2):
        write_archive(_payloads(spark, sf), folder, F.lit("2031-02-03 04:05:06.789012"), _FEATURES)
    rows = read_csv(
        spark,
        f"{folder}/data",
        "latitude DOUBLE, longitude DOUBLE, datetime STRING, temperature_2m DOUBLE, cloud_cover DOUBLE",
    )
    return rows.select("latitude", "longitude", "datetime", r6("temperature_2m").alias("temperature_2m"))


@query(
    "rejected_payloads",
    """SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'cut' WHEN vec_id % 5 = 1 THEN 'error' ELSE 'text' END AS kind
    FROM embeddings WHERE vec_id % 5 < 3""",
)
def rejected(spark, sf):
    """Payloads cut short, error answers and plain text among whole ones."""
    part = F.col("vec_id") % 5
    damaged = _payloads(spark, sf).withColumn(
        "value",
        F.when(part == 0, F.substring("value", 1, 60))
        .when(part == 1, '{"error": true, "reason": "limit"}')
        .when(part == 2, "no payload")
        .otherwise(F.col("value")),
    )
    bad = rejected_payloads(parse_payloads(damaged, features=_FEATURES))
    kind = F.when(F.col("value").startswith('{"error'), "error").when(F.col("value").startswith("{"), "cut")
    return bad.select("vec_id", kind.otherwise("text").alias("kind"))


@query(
    "row_metadata",
    f"""SELECT sha256(district || time) AS _id, '2025-06-01T00:00:00' AS last_updated, time, vec_id FROM {_SQL_ROWS}""",
)
def row_metadata(spark, sf):
    parsed = parse_payloads(_payloads(spark, sf), features=_FEATURES)
    rows = hourly_rows(parsed, _FEATURES, ["district", "vec_id"])
    stamped = with_metadata(rows, "district", "time", as_of=F.lit("2025-06-01").cast("timestamp"))
    return stamped.select("_id", "last_updated", "time", "vec_id")


@query(
    "district_history",
    f"""SELECT district, latitude, longitude, count(*) AS n, min(time) AS first_time, max(time) AS last_time,
        round(avg(x), 6) AS temperature_2m FROM {_SQL_ROWS} GROUP BY ALL""",
)
def district_rows(spark, sf):
    rows = district_history(_payloads(spark, sf), _FEATURES)
    return rows.groupBy("district", "latitude", "longitude").agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        r6(F.avg("temperature_2m")).alias("temperature_2m"),
    )


_SQL_GAP = f"""SELECT district, latitude, longitude, time, temperature_2m FROM (
    SELECT DISTINCT district, latitude, longitude, time, round(x, 6) AS temperature_2m FROM {_SQL_ROWS}
    UNION SELECT district, latitude, longitude, time, round(2 * x, 6) FROM {_SQL_ROWS} WHERE x < 0)"""


@query("fill_gap", _SQL_GAP)
def fill_recent_gap(spark, sf):
    """The recent feed repeats the warm hours and brings other values for the cold ones."""
    history = district_history(_payloads(spark, sf), _FEATURES).drop("cloud_cover")
    cold = F.col("temperature_2m") < 0
    recent = history.withColumn("temperature_2m", F.when(cold, F.col("temperature_2m") * 2).otherwise(F.col("temperature_2m")))
    out = fill_gap(history, recent, ordered=False)
    return out.withColumn("temperature_2m", r6("temperature_2m"))


@query("newest_archive_rows", f"SELECT time, vec_id FROM {_SQL_ROWS} ORDER BY time DESC, vec_id DESC LIMIT 5")
def newest_archive_rows(spark, sf):
    rows = hourly_rows(parse_payloads(_payloads(spark, sf), features=_FEATURES), _FEATURES, ["vec_id"])
    return top_newest(rows, 5, "time", "vec_id").select("time", "vec_id")


def _wide(spark, sf):
    """One column per event type, one row per hour, in Kelvin; errors have no readings."""
    hours = gapped_events(spark, sf).groupBy(F.date_trunc("hour", "ts").alias("h"))
    wide = hours.pivot("event_type", list(EVENT_TYPES)).agg(F.avg("value") + 273.15)
    return wide.select(F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("datetime"), *EVENT_TYPES)


@query(
    "city_history",
    f"""WITH w AS (SELECT date_trunc('hour', ts) AS h, avg(value) FILTER (event_type = 'click') + 273.15 AS t
        FROM {SQL_GAPPED} GROUP BY ALL),
    old AS (SELECT strftime(h - INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M') AS datetime,
        coalesce(t, lead(t) OVER (ORDER BY h)) - 273.15 AS temperature FROM w),
    new AS (SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS datetime, min(o_totalprice) AS temperature
        FROM orders GROUP BY ALL),
    kept AS (SELECT datetime, temperature FROM (SELECT *, row_number() OVER (ORDER BY datetime) AS rn FROM new)
        WHERE rn > 15)
    SELECT replace(datetime, 'T', ' ') || ':00-07' AS datetime, round(temperature, 6) AS temperature FROM (
        SELECT * FROM old WHERE temperature IS NOT NULL UNION ALL SELECT * FROM kept)""",
)
def city_rows(spark, sf):
    newer = (
        table(spark, sf, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("datetime"))
        .agg(F.min("o_totalprice").alias("temperature"))
    )
    rows = city_history(_wide(spark, sf), "click", newer)
    return rows.select("datetime", r6("temperature").alias("temperature"))


@query(
    "wide_city_column",
    f"""SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS datetime, round(t - 273.15, 6) AS celsius FROM (
        SELECT date_trunc('hour', ts) AS h, avg(value) FILTER (event_type = 'view') + 273.15 AS t
        FROM {SQL_GAPPED} GROUP BY ALL)""",
)
def wide_city_column(spark, sf):
    return _wide(spark, sf).select("datetime", r6(kelvin_to_celsius("view")).alias("celsius"))


@query(
    "csv_round_trip",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
)
def csv_round_trip(spark, sf):
    folder = shared_folder(spark, "csv")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    write_csv(rows, folder)
    return read_csv(
        spark, folder, "o_orderkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"
    )


@query("parquet_append", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def parquet_append(spark, sf):
    folder = shared_folder(spark, "rows")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    append_rows(rows, folder)
    append_rows(rows, folder)
    return spark.read.parquet(folder)


@query(
    "aggregate_documents",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS timestamp, round(avg(value), 6) AS avg_value
    FROM events GROUP BY ALL""",
)
def aggregate_documents(spark, sf):
    """Hourly means written as JSON documents with ISO times and read back."""
    folder = shared_folder(spark, "aggregates")
    hours = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("timestamp"))
    write_aggregate(hours.agg(r6(F.avg("value")).alias("avg_value")), folder)
    return spark.read.schema("timestamp STRING, avg_value DOUBLE").json(folder)


@query("iso_timestamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts FROM events")
def iso_times(spark, sf):
    return iso_timestamps(table(spark, sf, "events").select("event_id", ntz("ts").alias("ts")))
