"""The events table as a log of provider messages.

Clicks and views are free-weather messages, purchases and signups open-weather ones (in Kelvin), and
errors open-meteo ones. Every event is one message; the place is the user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.reshape import provider_documents
from isobar.operators.serving import first_write_wins
from isobar.queries.registry import SQL_K, events
from isobar.schemas import TOPICS

_TOPIC = """CASE WHEN event_type IN ('click', 'view') THEN 'free-weather'
    WHEN event_type IN ('purchase', 'signup') THEN 'open-weather' ELSE 'open-meteo' END"""
_PLACE = "'latitude', lat, 'longitude', lon"
# Payload of each provider over `k`, `number` (k as an integer), `value`, `lat`, `lon`, `local`, `epoch`.
_FREE = """named_struct(
    'location', named_struct('name', 'Malang', 'region', 'East Java', 'country', 'Indonesia', 'lat', lat,
        'lon', lon, 'tz_id', 'Asia/Jakarta', 'localtime_epoch', epoch,
        'localtime', date_format(local, 'yyyy-MM-dd HH:mm')),
    'current', named_struct('last_updated_epoch', epoch,
        'last_updated', date_format(local, 'yyyy-MM-dd HH:mm'), 'temp_c', value, 'is_day', 1,
        'condition', named_struct('text', event_type, 'icon', event_type || '.png', 'code', number),
        'wind_kph', value / 4, 'pressure_mb', 1000D + k, 'precip_mm', k / 10, 'humidity', number,
        'cloud', number, 'feelslike_c', double(k), 'gust_kph', value / 2))"""
_OPEN_WEATHER = """named_struct(
    'coord', named_struct('lon', lon, 'lat', lat),
    'weather', array(named_struct('id', number, 'main', 'Clouds', 'description', event_type, 'icon', '04d')),
    'main', named_struct('temp', value + 273.15D, 'feels_like', k + 273.15D, 'pressure', number + 1000,
        'humidity', number, 'sea_level', number + 1000, 'grnd_level', number + 900),
    'visibility', CASE WHEN k >= 50 THEN 10000 END,
    'wind', named_struct('speed', value / 4, 'deg', number, 'gust', value / 2),
    'clouds', named_struct('all', number), 'dt', epoch, 'sys', named_struct('country', 'ID'), 'name', 'Malang')"""
_METEO = """named_struct(
    'latitude', lat, 'longitude', lon, 'elevation', 502D,
    'current', named_struct('time', date_format(local, "yyyy-MM-dd'T'HH:mm"), 'interval', 900,
        'temperature_2m', value, 'apparent_temperature', double(k), 'relative_humidity_2m', number,
        'precipitation', k / 10, 'weather_code', number, 'cloud_cover', number, 'wind_speed_10m', value / 4,
        'wind_direction_10m', number, 'pressure_msl', 1000D + k, 'wind_gusts_10m', value / 2))"""


def _envelope(provider: str, data: str) -> str:
    return f"to_json(named_struct('provider', '{provider}', {_PLACE}, 'data', {data}))"


_MESSAGE = f"""CASE topic WHEN 'free-weather' THEN {_envelope("FreeWeatherAPI", _FREE)}
    WHEN 'open-weather' THEN {_envelope("OpenWeatherMap", _OPEN_WEATHER)}
    ELSE {_envelope("Open-Meteo", _METEO)} END"""


def as_records(rows: DataFrame) -> DataFrame:
    """Events as Kafka-shaped records; works on a stream of events as well."""
    inputs = rows.selectExpr(
        "event_id", "ts", "event_type", "value", f"{_TOPIC} AS topic",
        "bigint(get_json_object(props, '$.k')) AS k", "int(get_json_object(props, '$.k')) AS number",
        "-user_id / 16D AS lat", "112D + user_id / 16D AS lon", "unix_seconds(ts) AS epoch",
        "convert_timezone(current_timezone(), 'Asia/Jakarta', CAST(ts AS TIMESTAMP_NTZ)) AS local",
    )
    return inputs.selectExpr(
        "binary(null) AS key", f"binary({_MESSAGE}) AS value", "topic", "0 AS partition",
        "event_id AS offset", "ts AS timestamp",
    )


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(events(spark, sf_dir))


def spread_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its messages made and read in tasks of equal size: rows of events are small, and a whole file of them, or the
    part that an offset range leaves of it, may be a few tasks of many messages."""
    return as_records(events(spark, sf_dir).repartition("event_id"))


def _stored(log: DataFrame, topic: str) -> DataFrame:
    made = provider_documents(log, topic, F.col("timestamp"))
    return first_write_wins(made, "_id", "partition", "offset").drop("id_time", "partition", "offset")


def documents(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Stored documents of one provider: the first message of every id, created when it was sent."""
    return _stored(message_log(spark, sf_dir), topic)


def all_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    log = message_log(spark, sf_dir)
    return {topic: _stored(log, topic) for topic in TOPICS}


SQL_TOPIC = """CASE WHEN event_type IN ('click', 'view') THEN 'free-weather'
    WHEN event_type IN ('purchase', 'signup') THEN 'open-weather' ELSE 'open-meteo' END"""
# The stored documents: first message per id, where the id time is a second or a millisecond.
SQL_DOCS = f"""(SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY topic, id_time ORDER BY event_id) AS rn FROM (
        SELECT *, {SQL_K} AS k, -user_id / 16.0 AS lat, 112.0 + user_id / 16.0 AS lon,
            {SQL_TOPIC} AS topic,
            CASE WHEN event_type IN ('purchase', 'signup') THEN date_trunc('second', ts)
                ELSE date_trunc('millisecond', ts) END AS id_time
        FROM events)) WHERE rn = 1)"""


def sql_binary_id(text: str) -> str:
    return (
        f"sha256(array_to_string(list_transform(regexp_extract_all({text}, '.'), "
        "lambda c: lpad(bin(ascii(c)), 8, '0')), ''))"
    )


# Id of a document in SQL.
SQL_ID = f"""CASE WHEN topic = 'open-weather'
    THEN {sql_binary_id("strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') || '+07:00'")}
    ELSE {sql_binary_id("CAST(epoch_us(ts) // 1000 AS VARCHAR)")} END"""
