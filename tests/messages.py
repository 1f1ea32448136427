"""Hand-made provider messages."""

import json
from datetime import datetime, timezone

from isobar.schemas import FREE_WEATHER, KAFKA_RECORD, OPEN_METEO, OPEN_WEATHER


def free(temp, local="2031-03-09 09:15", lat=-6.34, lon=107.42, **current):
    return {
        "provider": "FreeWeatherAPI",
        "latitude": -6.29,
        "longitude": 107.37,
        "data": {
            "location": {
                "name": "Malang", "region": "East Java", "country": "Indonesia", "lat": lat, "lon": lon,
                "tz_id": "Asia/Jakarta", "localtime_epoch": 1930789381, "localtime": local,
            },
            "current": {
                "last_updated_epoch": 1930788900, "last_updated": local, "temp_c": temp, "is_day": 1,
                "condition": {"text": "Rain", "icon": "rain.png", "code": 7}, "wind_kph": 5.5,
                "wind_degree": 40, "wind_dir": "NE", "pressure_mb": 1003.5, "precip_mm": 0.5,
                "humidity": 61, "cloud": 47, "feelslike_c": 22.25, "gust_kph": 9.5, **current,
            },
        },
    }


def open_weather(temp, dt=1930789802, lat=-6.34, lon=107.42, visibility=7500, gust=4.25, weather=None):
    data = {
        "coord": {"lon": lon, "lat": lat},
        "weather": [{"id": 2, "main": "Mist", "description": "thin mist", "icon": "m"}]
        if weather is None
        else weather,
        "main": {
            "temp": temp, "feels_like": 305.5, "pressure": 1004, "humidity": 63, "sea_level": 1004,
            "grnd_level": 955,
        },
        "wind": {"speed": 2.5, "deg": 260},
        "clouds": {"all": 35},
        "dt": dt,
        "sys": {"country": "ID"},
        "name": "Malang",
    }
    if visibility is not None:
        data["visibility"] = visibility
    if gust is not None:
        data["wind"]["gust"] = gust
    return {"provider": "OpenWeatherMap", "latitude": -6.29, "longitude": 107.37, "data": data}


def meteo(temp, time="2031-03-09T09:15", lat=-6.34, lon=107.42):
    return {
        "provider": "Open-Meteo",
        "latitude": lat,
        "longitude": lon,
        "data": {
            "latitude": -6.25, "longitude": 107.375, "elevation": 730.0,
            "current": {
                "time": time, "interval": 900, "temperature_2m": temp, "apparent_temperature": 29.5,
                "relative_humidity_2m": 58, "precipitation": 0.0, "weather_code": 2, "cloud_cover": 44,
                "wind_speed_10m": 3.25, "wind_direction_10m": 310, "pressure_msl": 1002.5,
                "wind_gusts_10m": 8.75,
            },
        },
    }


def record(topic, message, offset, when="2031-03-09 02:20:00.123", partition=0):
    """A log record; texts are sent as they are."""
    text = message if isinstance(message, str) else json.dumps(message)
    instant = datetime.fromisoformat(when).replace(tzinfo=timezone.utc)
    return (None, bytearray(text.encode()), topic, partition, offset, instant)


def log(spark, *records):
    return spark.createDataFrame(list(records), KAFKA_RECORD)


__all__ = ["FREE_WEATHER", "OPEN_METEO", "OPEN_WEATHER", "free", "log", "meteo", "open_weather", "record"]
