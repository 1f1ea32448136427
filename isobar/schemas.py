"""Declared schemas, column maps and lookup tables."""

from __future__ import annotations

from pyspark.sql import types as T

FREE_WEATHER = "free-weather"
OPEN_WEATHER = "open-weather"
OPEN_METEO = "open-meteo"
TOPICS = (FREE_WEATHER, OPEN_WEATHER, OPEN_METEO)


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "BINARY": T.BinaryType(),
    "TIMESTAMP": T.TimestampType(),
}


def record(fields: str, **nested: T.DataType) -> T.StructType:
    """Schema from `name TYPE, ...`; a field without a type takes it from `nested`."""
    out = []
    for field in fields.split(","):
        name, *kind = field.split()
        out.append(T.StructField(name, _TYPES[kind[0]] if kind else nested[name]))
    return T.StructType(out)


# A record as the Kafka source delivers it.
KAFKA_RECORD = record(
    "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP"
)

# Payload of one message per provider.
FREE_WEATHER_LOCATION = record(
    "name STRING, region STRING, country STRING, lat DOUBLE, lon DOUBLE, tz_id STRING, "
    "localtime_epoch LONG, localtime STRING"
)
FREE_WEATHER_CURRENT = record(
    "last_updated_epoch LONG, last_updated STRING, temp_c DOUBLE, temp_f DOUBLE, is_day INT, "
    "condition, "
    "wind_mph DOUBLE, wind_kph DOUBLE, wind_degree INT, wind_dir STRING, "
    "pressure_mb DOUBLE, pressure_in DOUBLE, precip_mm DOUBLE, precip_in DOUBLE, "
    "humidity INT, cloud INT, feelslike_c DOUBLE, feelslike_f DOUBLE, "
    "windchill_c DOUBLE, windchill_f DOUBLE, heatindex_c DOUBLE, heatindex_f DOUBLE, "
    "dewpoint_c DOUBLE, dewpoint_f DOUBLE, vis_km DOUBLE, vis_miles DOUBLE, uv DOUBLE, "
    "gust_mph DOUBLE, gust_kph DOUBLE",
    condition=record("text STRING, icon STRING, code INT"),
)
SKY = T.ArrayType(record("id INT, main STRING, description STRING, icon STRING"))
OPEN_WEATHER_DATA = record(
    "coord, weather, base STRING, main, visibility INT, wind, clouds, dt LONG, sys, "
    "timezone INT, id INT, name STRING, cod INT",
    coord=record("lon DOUBLE, lat DOUBLE"),
    weather=SKY,
    main=record(
        "temp DOUBLE, feels_like DOUBLE, temp_min DOUBLE, temp_max DOUBLE, "
        "pressure INT, humidity INT, sea_level INT, grnd_level INT"
    ),
    wind=record("speed DOUBLE, deg INT, gust DOUBLE"),
    clouds=record("all INT"),
    sys=record("country STRING, sunrise LONG, sunset LONG"),
)
OPEN_METEO_CURRENT = record(
    "time STRING, interval INT, temperature_2m DOUBLE, apparent_temperature DOUBLE, "
    "relative_humidity_2m INT, rain DOUBLE, precipitation DOUBLE, weather_code INT, "
    "cloud_cover INT, showers DOUBLE, wind_speed_10m DOUBLE, wind_direction_10m INT, "
    "pressure_msl DOUBLE, surface_pressure DOUBLE, wind_gusts_10m DOUBLE"
)


def _envelope(data: T.StructType) -> T.StructType:
    return record("provider STRING, latitude DOUBLE, longitude DOUBLE, data", data=data)


ENVELOPES = {
    FREE_WEATHER: _envelope(
        record("location, current", location=FREE_WEATHER_LOCATION, current=FREE_WEATHER_CURRENT)
    ),
    OPEN_WEATHER: _envelope(OPEN_WEATHER_DATA),
    OPEN_METEO: _envelope(
        record(
            "latitude DOUBLE, longitude DOUBLE, generationtime_ms DOUBLE, utc_offset_seconds INT, "
            "timezone STRING, timezone_abbreviation STRING, elevation DOUBLE, current",
            current=OPEN_METEO_CURRENT,
        )
    ),
}


def _document(location: T.StructType, current_weather: T.StructType) -> T.StructType:
    return record(
        "_id STRING, provider STRING, location, current_weather, "
        "created_at STRING, last_updated STRING",
        location=location,
        current_weather=current_weather,
    )


# Stored documents, one table per provider.
DOCUMENTS = {
    FREE_WEATHER: _document(FREE_WEATHER_LOCATION, FREE_WEATHER_CURRENT),
    OPEN_WEATHER: _document(
        record("lat DOUBLE, lon DOUBLE, name STRING, country STRING"),
        record(
            "clouds, main, weather",
            clouds=record("all INT"),
            main=record(
                "feels_like DOUBLE, pressure_ground_level INT, humidity INT, pressure INT, "
                "sea_level INT, temp DOUBLE, visibility INT, wind_dir INT, wind_speed DOUBLE, "
                "wind_gust DOUBLE"
            ),
            weather=SKY,
        ),
    ),
    OPEN_METEO: _document(
        record("lat DOUBLE, lon DOUBLE, grid_lat DOUBLE, grid_lon DOUBLE"), OPEN_METEO_CURRENT
    ),
}

# Provider column name -> canonical name.
CANONICAL_NAMES = {
    "last_updated": "date",
    "temperature_2m": "temperature_c",
    "temp": "temperature_c",
    "temp_c": "temperature_c",
    "apparent_temperature": "feels_like_c",
    "feelslike_c": "feels_like_c",
    "feels_like": "feels_like_c",
    "relative_humidity_2m": "humidity_pct",
    "humidity": "humidity_pct",
    "wind_speed_10m": "wind_speed_kmph",
    "wind_kph": "wind_speed_kmph",
    "wind_speed": "wind_speed_kmph",
    "wind_gusts_10m": "wind_gust_kmph",
    "gust_kph": "wind_gust_kmph",
    "wind_gust": "wind_gust_kmph",
    "wind_degree": "wind_degree",
    "wind_direction_10m": "wind_degree",
    "pressure": "pressure",
    "pressure_mb": "pressure",
    "pressure_msl": "pressure",
    "cloud_cover": "cloud_total_pct",
    "cloud": "cloud_total_pct",
    "all": "cloud_total_pct",
    "district": "district",
    "latitude": "latitude",
    "lat": "latitude",
    "longitude": "longitude",
    "lon": "longitude",
}

# Measures every provider has, so the set is the same in a stream whatever has arrived.
COMMON_MEASURES = (
    "temperature_c",
    "feels_like_c",
    "humidity_pct",
    "wind_speed_kmph",
    "wind_gust_kmph",
    "pressure",
    "cloud_total_pct",
)
PLACE_COLUMNS = ("location_name", "latitude", "longitude")
DEFAULT_LOCATION = "Malang"

# Columns of the hourly aggregate.
HOURLY_AGGREGATE = record(
    "location_name STRING, latitude DOUBLE, longitude DOUBLE, timestamp TIMESTAMP, "
    + ", ".join(f"avg_{name} DOUBLE" for name in COMMON_MEASURES)
)

# Serving tables with the default of each column.
WEATHER_DATA_DEFAULTS = {
    "provider": ("string", "unknown"),
    "name": ("string", ""),
    "region": ("string", ""),
    "country": ("string", ""),
    "lat": ("double", 0.0),
    "lon": ("double", 0.0),
    "temp_c": ("double", 0.0),
    "temp_f": ("double", 0.0),
    "is_day": ("int", 0),
    "text": ("string", ""),
    "icon": ("string", ""),
    "code": ("int", 0),
    "wind_mph": ("double", 0.0),
    "wind_kph": ("double", 0.0),
    "wind_degree": ("int", 0),
    "wind_dir": ("string", ""),
    "pressure_mb": ("double", 0.0),
    "pressure_in": ("double", 0.0),
    "precip_mm": ("double", 0.0),
    "precip_in": ("double", 0.0),
    "humidity": ("int", 0),
    "cloud": ("int", 0),
    "feelslike_c": ("double", 0.0),
    "feelslike_f": ("double", 0.0),
    "windchill_c": ("double", 0.0),
    "windchill_f": ("double", 0.0),
    "heatindex_c": ("double", 0.0),
    "heatindex_f": ("double", 0.0),
    "dewpoint_c": ("double", 0.0),
    "dewpoint_f": ("double", 0.0),
    "vis_km": ("double", 0.0),
    "vis_miles": ("double", 0.0),
    "uv": ("double", 0.0),
    "gust_mph": ("double", 0.0),
    "gust_kph": ("double", 0.0),
}
# Summary column -> (free-weather leaf name, type, default).
WEATHER_SUMMARY_SOURCES = {
    "location_name": ("name", "string", ""),
    "latitude": ("lat", "double", 0.0),
    "longitude": ("lon", "double", 0.0),
    "cloud_total_pct": ("cloud", "double", 0.0),
    "wind_speed_kmph": ("wind_kph", "double", 0.0),
    "pressure": ("pressure_mb", "double", 0.0),
    "humidity_pct": ("humidity", "double", 0.0),
    "temperature_c": ("temp_c", "double", 0.0),
    "feels_like_c": ("feelslike_c", "double", 0.0),
    "wind_gust_kmph": ("gust_kph", "double", 0.0),
}
# Serving column of each metric by grain.
SERVING_METRICS = {
    "hour": {
        "temperature": "temperature_c",
        "feels_like": "feels_like_c",
        "humidity": "humidity_pct",
    },
    "quarter": {
        "temperature": "temp_c",
        "feels_like": "feelslike_c",
        "humidity": "humidity",
        "precipitation": "precip_mm",
        "icon": "icon",
    },
}
# Columns of the latest-row projection, serving column -> name.
LATEST_PROJECTION = {
    "hour": {
        "temperature_c": "temp_c",
        "wind_speed_kmph": "wind_kph",
        "pressure": "pressure",
        "humidity_pct": "humidity",
        "feels_like_c": "feelslike_c",
        "wind_gust_kmph": "gust_kph",
        "cloud_total_pct": "cloud",
    },
    "quarter": {
        "temp_c": "temp_c",
        "wind_kph": "wind_kph",
        "pressure_mb": "pressure",
        "humidity": "humidity",
        "feelslike_c": "feelslike_c",
        "gust_kph": "gust_kph",
        "cloud": "cloud",
    },
}

# Hourly arrays of an archive payload.
ARCHIVE_FEATURES = (
    "temperature_2m",
    "is_day",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "weather_code",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "et0_fao_evapotranspiration",
    "vapour_pressure_deficit",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
)
# Features of the load over districts and years.
DISTRICT_FEATURES = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "weather_code",
    "wind_speed_10m",
    "wind_speed_100m",
    "wind_direction_10m",
    "wind_direction_100m",
    "wind_gusts_10m",
    "rain",
    "apparent_temperature",
    "surface_pressure",
    "cloud_cover",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "et0_fao_evapotranspiration",
    "vapour_pressure_deficit",
    "pressure_msl",
    "dew_point_2m",
)


def archive_payload(features=ARCHIVE_FEATURES) -> T.StructType:
    arrays = {name: T.ArrayType(T.DoubleType()) for name in features}
    hourly = record(
        ", ".join(["time", *features]), time=T.ArrayType(T.StringType()), **arrays
    )
    return record(
        "latitude DOUBLE, longitude DOUBLE, utc_offset_seconds INT, timezone STRING, "
        "timezone_abbreviation STRING, hourly",
        hourly=hourly,
    )


# CSV header -> dotted path of the free-weather export.
FREE_WEATHER_EXPORT = {
    "id": "_id",
    "provider": "provider",
    "location_name": "location.name",
    "region": "location.region",
    "country": "location.country",
    "lat": "location.lat",
    "lon": "location.lon",
    "localtime": "location.localtime",
    "provider_last_updated": "current_weather.last_updated",
    "temp_c": "current_weather.temp_c",
    "temp_f": "current_weather.temp_f",
    "is_day": "current_weather.is_day",
    "weather_desc": "current_weather.condition.text",
    "weather_code": "current_weather.condition.code",
    "wind_mph": "current_weather.wind_mph",
    "wind_kph": "current_weather.wind_kph",
    "pressure_mb": "current_weather.pressure_mb",
    "precip_mm": "current_weather.precip_mm",
    "humidity": "current_weather.humidity",
    "cloud_cover": "current_weather.cloud",
    "feelslike_c": "current_weather.feelslike_c",
    "uv": "current_weather.uv",
    "doc_created_at": "created_at",
    "doc_last_updated": "last_updated",
}
