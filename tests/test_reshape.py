import hashlib

from messages import FREE_WEATHER, OPEN_METEO, OPEN_WEATHER, free, log, meteo, open_weather, record
from pyspark.sql import functions as F

from isobar.operators.reshape import (
    content_id_documents,
    flatten_by_leaf,
    flatten_by_path,
    list_lengths,
    provider_documents,
)
from isobar.schemas import DOCUMENTS
from isobar.sources.messages import envelope_records, good_records, parse_envelopes, rejected_records


def digest(text):
    return hashlib.sha256("".join(format(ord(c), "08b") for c in text).encode()).hexdigest()


def test_free_weather_document(spark):
    docs = provider_documents(log(spark, record(FREE_WEATHER, free(23.1), 0)), FREE_WEATHER, F.col("timestamp"))
    doc = docs.first()
    assert doc["_id"] == digest("1930789200123")
    assert doc["location"]["name"] == "Malang" and doc["current_weather"]["condition"]["code"] == 7
    assert doc["created_at"] == "2031-03-09 02:20:00.123000"
    assert doc["last_updated"] == "2031-03-09 09:15"
    stored = docs.select(*DOCUMENTS[FREE_WEATHER].names)
    assert stored.schema.simpleString() == DOCUMENTS[FREE_WEATHER].simpleString()


def test_open_weather_document(spark):
    docs = provider_documents(
        log(
            spark,
            record(OPEN_WEATHER, open_weather(304.85), 0),
            record(OPEN_WEATHER, open_weather(300, visibility=None, gust=None, weather=[]), 1),
        ),
        OPEN_WEATHER,
    ).orderBy("offset")
    full, gaps = docs.collect()
    assert full["_id"] == digest("2031-03-09 09:30:02+07:00") == gaps["_id"]
    main = full["current_weather"]["main"]
    assert (main["pressure_ground_level"], main["wind_dir"], main["visibility"]) == (955, 260, 7500)
    assert gaps["current_weather"]["main"]["visibility"] == 0
    assert gaps["current_weather"]["main"]["wind_gust"] is None
    assert gaps["current_weather"]["main"]["temp"] == 300.0


def test_open_meteo_document_and_offset_ids(spark):
    records = log(spark, record(OPEN_METEO, meteo(27.4), 0), record(OPEN_METEO, meteo(27.5), 1))
    docs = provider_documents(records, OPEN_METEO)
    assert docs.select("_id").distinct().count() == 1
    assert docs.first()["location"].asDict() == {"lat": -6.34, "lon": 107.42, "grid_lat": -6.25, "grid_lon": 107.375}
    from isobar.operators.reshape import open_meteo_documents

    parsed = good_records(parse_envelopes(records, OPEN_METEO))
    assert open_meteo_documents(parsed, offset_in_id=True).select("_id").distinct().count() == 2


def test_content_ids_collapse_polls(spark):
    records = log(
        spark,
        record(FREE_WEATHER, free(23.1), 0),
        record(FREE_WEATHER, free(23.1), 1, "2031-03-09 02:25:00"),
        record(FREE_WEATHER, free(24.0, "2031-03-09 09:30"), 2),
    )
    docs = content_id_documents(good_records(parse_envelopes(records, FREE_WEATHER)))
    assert docs.select("_id").distinct().count() == 2


def test_bad_messages_are_kept_aside(spark, rows):
    whole = free(23.1)
    whole["data"]["current"]["humidity"] = 87.0  # a double where an integer is declared
    whole["data"]["current"]["temp_c"] = 23  # an integer where a double is declared
    parsed = parse_envelopes(
        log(
            spark,
            record(FREE_WEATHER, whole, 0),
            record(FREE_WEATHER, "{broken", 1),
            record(FREE_WEATHER, '{"hello": "world"}', 2),
            record(FREE_WEATHER, "[]", 3),
        ),
        FREE_WEATHER,
    )
    assert rows(good_records(parsed), "offset", "envelope.data.current.humidity") == [(0, 87)]
    assert sorted(rows(rejected_records(parsed), "offset", "value")) == [
        (1, "{broken"), (2, '{"hello": "world"}'), (3, "[]"),
    ]


def test_messages_without_an_id_or_reading_are_kept_aside(spark, rows):
    no_time = open_weather(300.0)
    del no_time["data"]["dt"]
    no_reading = meteo(20.0)
    del no_reading["data"]["current"]
    for topic, message in ((OPEN_WEATHER, no_time), (OPEN_METEO, no_reading)):
        parsed = parse_envelopes(log(spark, record(topic, message, 7)), topic)
        assert rows(rejected_records(parsed), "offset") == [(7,)]
        assert good_records(parsed).count() == 0


def test_envelope_round_trip(spark, rows):
    payloads = spark.sql(
        """SELECT -6.29D AS latitude, 107.37D AS longitude, named_struct('current', named_struct('temp_c', 1.5D)) AS data
        UNION ALL SELECT 0D, 0D, NULL"""
    )
    sent = envelope_records(payloads, FREE_WEATHER, "FreeWeatherAPI")
    assert rows(sent) == [
        (FREE_WEATHER, '{"provider":"FreeWeatherAPI","latitude":-6.29,"longitude":107.37,"data":{"current":{"temp_c":1.5}}}')
    ]


def nested(spark):
    return spark.sql(
        """SELECT named_struct('x', 1, 'name', 'outer', 'deep', named_struct('name', 'inner')) AS a,
            array(named_struct('id', 1, 'main', 'Rain'), named_struct('id', 2, 'main', CAST(NULL AS STRING))) AS w,
            array(1, 2) AS n, array('p', NULL) AS s, CAST(array() AS ARRAY<INT>) AS e, 'top' AS name
        UNION ALL SELECT NULL, CAST(array() AS ARRAY<STRUCT<id: INT, main: STRING>>), NULL, array('q'), array(3), NULL"""
    )


def test_flatten_by_path(spark):
    df = nested(spark)
    assert list_lengths(df) == {"w": 2}
    deep = spark.sql("SELECT 1 AS a, array(named_struct('k', array(named_struct('y', 5), named_struct('y', 6))), named_struct('k', array(named_struct('y', 7)))) AS m")
    assert list_lengths(deep) == {"m": 2, "m_k": 2}
    assert flatten_by_path(deep).first().asDict() == {"a": 1, "m_0_k_0_y": 5, "m_0_k_1_y": 6, "m_1_k_0_y": 7, "m_1_k_1_y": None}
    # Lists that are not named get their longest length.
    assert "m_1_k_1_y" in flatten_by_path(deep, items={"m": 2}).columns
    flat = flatten_by_path(df, items=list_lengths(df))
    assert flat.columns == [
        "a_x", "a_name", "a_deep_name", "w_0_id", "w_0_main", "w_1_id", "w_1_main", "n", "s", "e", "name",
    ]
    first, second = flat.collect()
    assert tuple(first) == (1, "outer", "inner", 1, "Rain", 2, None, "[1, 2]", "['p', None]", "[]", "top")
    assert tuple(second) == (None, None, None, None, None, None, None, None, "['q']", "[3]", None)


def test_flatten_by_leaf_last_value_wins(spark):
    flat = flatten_by_leaf(nested(spark))
    assert flat.columns == ["x", "name", "id", "main", "n", "s", "e"]
    first, second = flat.collect()
    assert tuple(first)[:4] == (1, "top", 2, "Rain")
    assert tuple(second)[:4] == (None, None, None, None)
