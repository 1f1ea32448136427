import json
from datetime import datetime, timedelta

import pytest
from messages import FREE_WEATHER, OPEN_WEATHER, free, log, open_weather, record
from pyspark.sql import functions as F

from isobar.operators.reshape import provider_documents
from isobar.plans.archives import archive_tables, district_history, fill_gap, write_archive
from isobar.plans.city import city_history
from isobar.plans.exports import dataset, mapped_dataset, write_dataset, write_mapped
from isobar.schemas import ARCHIVE_FEATURES, DISTRICT_FEATURES, FREE_WEATHER_EXPORT
from isobar.sources import files
from isobar.sources.archive import hourly_rows, newest_file, parse_payloads, payload_parts, read_payloads
from isobar.sources.documents import align_to_header, read_documents
from isobar.sources.weather_codes import weather_codes
from isobar.operators.serving import lookup


def payload(lat=-6.34, lon=112.5, hours=3, features=ARCHIVE_FEATURES, start="2017-01-01T00:00"):
    t0 = datetime.fromisoformat(start)
    hourly = {"time": [(t0 + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(hours)]}
    hourly |= {f: [float(i) if i else None for i in range(hours)] for f in features}
    return json.dumps(
        {"latitude": lat, "longitude": lon, "utc_offset_seconds": 25200, "timezone": "Asia/Bangkok",
         "timezone_abbreviation": "GMT+7", "hourly": hourly}
    )


def test_payload_rows_and_descriptor(spark, rows):
    texts = spark.createDataFrame([(payload(),), ("{broken",)], "value STRING")
    described, data, names = archive_tables(texts, F.lit("2031-02-03 04:05:06.789012"))
    assert rows(data, "datetime", "temperature_2m", "is_day") == [
        ("2017-01-01T00:00", None, None), ("2017-01-01T01:00", 1.0, 1.0), ("2017-01-01T02:00", 2.0, 2.0),
    ]
    assert rows(described) == [(-6.34, 112.5, 25200, "Asia/Bangkok", "GMT+7")]
    assert rows(names, "descriptor_file_name", "data_file_name") == [
        ("-6_34_112_5_descriptor_2031-02-03_04_05_06_789012.csv", "-6_34_112_5_data_2031-02-03_04_05_06_789012.csv")
    ]
    merged = payload_parts(parse_payloads(texts))
    assert len(merged.columns) == 5 + 1 + 18


def test_archive_is_written_manifest_first(spark, rows, tmp_path):
    folder = str(tmp_path / "archive")
    texts = spark.createDataFrame([(payload(lat=x),) for x in (-6.34, -8.5)], "value STRING")
    broken = spark.createDataFrame([("{broken",), ("{}",)], "value STRING")
    for _ in range(2):
        write_archive(texts.union(broken), folder, F.lit("2031-02-03 04:05:06"))
    assert sorted(rows(spark.read.parquet(f"{folder}/quarantine"), "value")) == [("{broken",), ("{}",)]
    assert spark.read.parquet(f"{folder}/manifest").count() == 2
    assert files.read_csv(spark, f"{folder}/descriptor", "latitude DOUBLE, longitude DOUBLE").count() == 2
    data = spark.read.option("header", True).csv(f"{folder}/data")
    assert data.count() == 6 and set(r[0] for r in rows(data.select("location"))) == {"-6_34_112_5", "-8_5_112_5"}
    newest = newest_file(spark.read.parquet(f"{folder}/manifest")).first()
    assert newest["data_file_name"].startswith("-8_5")
    # A manifest that cannot be written stops the rest.
    blocked = tmp_path / "blocked"
    blocked.mkdir()
    (blocked / "manifest").write_text("a file, no folder")
    with pytest.raises(Exception):
        write_archive(texts, str(blocked), F.lit("x"))
    assert sorted(p.name for p in blocked.iterdir()) == ["manifest"]


def test_payload_files(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(payload(lat=x) for x in (1.0, 2.0)))
    assert hourly_rows(read_payloads(spark, str(tmp_path))).count() == 6


def test_history_of_all_districts_and_gap(spark, rows):
    texts = [("Klojen", -6.33, 107.42, payload(features=DISTRICT_FEATURES)),
             ("Sukun", -6.35, 107.37, payload(features=DISTRICT_FEATURES, start="2018-01-01T00:00"))]
    frame = spark.createDataFrame(texts, "district STRING, latitude DOUBLE, longitude DOUBLE, value STRING")
    history = district_history(frame)
    assert history.count() == 6 and len(history.columns) == 3 + 1 + 20
    recent = history.filter("district = 'Klojen'").withColumn(
        "temperature_2m", F.when(F.col("time") == "2017-01-01T02:00", 9.0).otherwise(F.col("temperature_2m"))
    )
    full = fill_gap(history, recent)
    assert full.count() == 7
    assert rows(full, "district", "time")[0] == ("Klojen", "2017-01-01T00:00")


def test_exports(spark, rows, tmp_path):
    records = log(
        spark,
        record(OPEN_WEATHER, open_weather(300), 0),
        record(OPEN_WEATHER, open_weather(301, dt=1, weather=[{"id": 1, "main": "A"}, {"id": 2, "main": "B"}]), 1),
        record(FREE_WEATHER, free(20.0), 0),
    )
    docs = provider_documents(records, OPEN_WEATHER).drop("id_time", "partition", "offset")
    write_dataset(docs, str(tmp_path / "ow"))
    back = spark.read.option("header", True).csv(str(tmp_path / "ow"))
    assert back.columns == sorted(back.columns) and "current_weather_weather_1_id" in back.columns
    assert sorted(rows(back, "current_weather_weather_1_id"), key=str) == [("2",), (None,)]
    assert "current_weather_weather_1_id" in dataset(docs).columns
    assert "current_weather_weather_1_id" not in dataset(docs, {"current_weather_weather": 1}).columns
    free_docs = provider_documents(records, FREE_WEATHER).drop("id_time", "partition", "offset")
    mapped = mapped_dataset(free_docs, {**FREE_WEATHER_EXPORT, "gone": "location.nope.deeper"})
    row = mapped.first()
    assert (row["weather_code"], row["temp_c"], row["gone"], row["uv"]) == (7, 20.0, None, None)
    write_mapped(free_docs, str(tmp_path / "fw"))
    assert spark.read.option("header", True).csv(str(tmp_path / "fw")).columns == list(FREE_WEATHER_EXPORT)
    assert rows(align_to_header(free_docs, ["zzz", "provider"])) == [(None, "FreeWeatherAPI")]


def test_city_history(spark, rows):
    wide = spark.createDataFrame(
        [("2012-10-01 12:00:00", None, 1.0), ("2012-10-01 13:00:00", 289.15, 1.0),
         ("2012-10-01 14:00:00", 290.15, 1.0), ("2012-10-01 15:00:00", None, 1.0)],
        "datetime STRING, `San Francisco` DOUBLE, other DOUBLE",
    )
    newer = spark.createDataFrame([(f"2017-10-27T{h:02d}:00", f"{h}.5") for h in range(17)], "datetime STRING, temperature STRING")
    out = city_history(wide, "San Francisco", newer).orderBy("datetime")
    got = [(d, round(t, 6)) for d, t in rows(out, "datetime", "temperature")]
    assert got == [
        ("2012-10-01 02:00:00-07", 16.0), ("2012-10-01 03:00:00-07", 16.0), ("2012-10-01 04:00:00-07", 17.0),
        ("2017-10-27 15:00:00-07", 15.5), ("2017-10-27 16:00:00-07", 16.5),
    ]
    assert out.select("_id").distinct().count() == 5


def test_tables_and_files(spark, rows, tmp_path):
    df = spark.sql("SELECT id, TIMESTAMP '2031-03-09 02:00:00' AS timestamp FROM range(3)")
    files.replace_table(df, "serving_test")
    files.replace_table(df.limit(2), "serving_test")
    assert files.read_table(spark, "serving_test").count() == 2
    files.write_aggregate(df, str(tmp_path / "agg"))
    inferred = read_documents(spark, str(tmp_path / "agg"))
    assert rows(inferred.select("timestamp").distinct()) == [("2031-03-09T02:00:00",)]
    files.append_rows(df, str(tmp_path / "rows"), ["id"])
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 3
    schema = weather_codes(spark).schema
    facts = spark.createDataFrame([("95", "x"), ("zz", "y")], schema).drop("description")
    found = dict(rows(lookup(facts, weather_codes(spark), "code")))
    assert found["95"].startswith("Thunderstorm, slight or moderate") and found["zz"] is None
