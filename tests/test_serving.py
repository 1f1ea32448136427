from datetime import datetime

import pytest
from messages import FREE_WEATHER, free, log, record
from pyspark.sql import functions as F

from isobar.operators import dashboard, serving
from isobar.operators.project import (
    cast_column,
    latest_projection,
    pick,
    strip_prefix,
    summary_from_aggregate,
    weather_data_rows,
    with_metadata,
    without_rows,
)
from isobar.operators.reshape import provider_documents
from isobar.plans.archives import fill_gap
from isobar.plans.serving import data_backfill, increment_rows, summary_backfill, update_serving, update_summary
from isobar.schemas import WEATHER_DATA_DEFAULTS
from isobar.sources.documents import find, page_after, scan_all


def free_documents(spark, *messages):
    records = [record(FREE_WEATHER, m, i, when) for i, (m, when) in enumerate(messages)]
    docs = provider_documents(log(spark, *records), FREE_WEATHER, F.col("timestamp"))
    return docs.drop("id_time", "partition", "offset")


def test_upsert_keeps_highest_version(spark, rows):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old")], "k STRING, v INT, w STRING")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("c", 0, "new")], "k STRING, v INT, w STRING")
    assert sorted(rows(serving.upsert_latest(old, new, ["k"], ["v"]))) == [("a", 1, "new"), ("b", 5, "old"), ("c", 0, "new")]


def test_insert_if_absent(spark, rows):
    new = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3), ("z", 4)], "_id STRING, o INT")
    old = spark.createDataFrame([("z",)], "_id STRING")
    assert sorted(rows(serving.insert_if_absent(new, old, "_id", "o"))) == [("x", 1), ("y", 3)]


def test_latest_of_today_else_latest(spark):
    df = spark.sql("SELECT timestamp_seconds(id * 3600) AS ts, id FROM range(48)")
    at = lambda text: F.lit(text).cast("timestamp")
    # Rows after the moment are not known yet.
    assert serving.latest_today_else_latest(df, "ts", at("1970-01-02 05:00:00")).first()["id"] == 29
    assert serving.latest_today_else_latest(df.filter("id < 20 OR id > 30"), "ts", at("1970-01-02 05:00:00")).first()["id"] == 19
    assert serving.latest_today_else_latest(df, "ts", at("1960-01-02 05:00:00")).first() is None
    assert serving.latest_today_else_latest(df, "ts", at("1980-01-01 05:00:00")).first()["id"] == 47


def test_find_scan_and_pages(spark, rows):
    df = spark.createDataFrame([(f"{i:02d}",) for i in range(5)] + [("_design/a",)], "_id STRING")
    assert scan_all(df).count() == 5
    assert rows(page_after(df, None, 2)) == [("00",), ("01",)]
    assert rows(page_after(df, "01", 2)) == [("02",), ("03",)]
    assert rows(find(df, F.col("_id") > "01", ["_id"], [F.desc("_id")], 1)) == [("_design/a",)]


def test_projections(spark, rows):
    df = spark.createDataFrame([("a", 1.0, "x1")], "_id STRING, avg_t DOUBLE, u STRING")
    assert strip_prefix(df).columns == ["_id", "t", "u"]
    assert pick(df, ["u", "nope", "_id"]).columns == ["u", "_id"]
    assert rows(cast_column(df, "u", "double"), "u") == [(None,)]
    assert without_rows(df, df, ["_id"]).count() == 0
    stamped = with_metadata(df, "_id", "u", as_of=F.lit("2025-01-01 00:00:01").cast("timestamp"))
    assert stamped.first()["last_updated"] == "2025-01-01T00:00:01"


def test_defaults_for_missing_fields(spark):
    row = weather_data_rows(spark.createDataFrame([(None, 21.5)], "name STRING, temp_c DOUBLE"), F.lit("t")).first().asDict()
    assert len(row) == 36 and row["provider"] == "unknown" and row["name"] == "" and row["temp_c"] == 21.5
    assert all(v is not None for v in row.values()) and list(row)[6] == "timestamp"


def test_series_of_both_tables(spark, rows):
    data = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10, m), float(m), "i.png") for m in (0, 15, 58)], "timestamp TIMESTAMP, precip_mm DOUBLE, icon STRING"
    )
    assert [v for _, v in rows(serving.serving_series(data, "precipitation", "quarter"))] == [0.0, 15.0, 58.0]
    assert [v for _, v in rows(serving.serving_series(data, "precipitation", "quarter", on_slot_only=True))] == [0.0]
    with pytest.raises(ValueError):
        serving.serving_series(data, "precipitation", "hour")


def test_latest_projection_uses_cloud(spark):
    row = spark.sql(
        """SELECT 20D AS temp_c, 1D AS wind_kph, 1000D AS pressure_mb, 88 AS humidity, 21.256D AS feelslike_c,
        2D AS gust_kph, 40 AS cloud"""
    )
    got = dashboard.feels_like_gap(latest_projection(row, "quarter")).first()
    assert (got["cloud"], got["pressure"], got["feels_like_gap"]) == (40, 1000.0, 1.26)


def test_increment_row_has_the_reading_time(spark, rows):
    docs = free_documents(
        spark,
        (free(20.0, "2031-03-09 09:17"), "2031-03-09 02:20:00"),
        (free(25.0, "2031-03-09 09:48"), "2031-03-09 02:50:00"),
    )
    as_of = F.lit("2031-03-09 03:07:30").cast("timestamp")
    row = increment_rows(docs, "quarter", as_of, "Asia/Jakarta").first()
    assert (row["temp_c"], str(row["timestamp"]), row["temp_f"]) == (25.0, "2031-03-09 02:45:00", 0.0)
    hour = increment_rows(docs, "hour", as_of, "Asia/Jakarta").first()
    assert (hour["temperature_c"], str(hour["timestamp"]), hour["location_name"]) == (25.0, "2031-03-09 02:00:00", "Malang")
    parity = increment_rows(docs, "quarter", as_of, "Asia/Jakarta", parity=True).first()
    assert str(parity["timestamp"]) == "2031-03-09 03:07:00"
    with pytest.raises(ValueError):
        increment_rows(docs, "day", as_of)


def test_serving_folder_never_repeats_a_key(spark, rows, tmp_path):
    folder = str(tmp_path / "data")
    as_of = F.lit("2031-03-09 03:07:30").cast("timestamp")
    for temp in (20.0, 21.0, 21.0):
        update_serving(free_documents(spark, (free(temp, "2031-03-09 09:17"), "2031-03-09 02:20:00")), folder, "quarter", as_of, "Asia/Jakarta")
    later = as_of + F.expr("INTERVAL 1 DAY")
    update_serving(free_documents(spark, (free(9.0, "2031-03-10 09:17"), "2031-03-10 02:20:00")), folder, "quarter", later, "Asia/Jakarta")
    assert sorted(rows(spark.read.parquet(folder), "temp_c")) == [(9.0,), (21.0,)]
    assert set(WEATHER_DATA_DEFAULTS) < set(spark.read.parquet(folder).columns)


def test_summary_from_cross_provider_aggregate(spark, rows, tmp_path):
    aggregate = spark.sql(
        "SELECT 'Malang' AS location_name, -6.34D AS latitude, 107.42D AS longitude, TIMESTAMP '2031-03-09 02:00:00' AS timestamp, 21.0D AS avg_temperature_c"
    )
    row = summary_from_aggregate(aggregate).first()
    assert row["temperature_c"] == 21.0 and row["pressure"] == 0.0
    update_summary(aggregate, str(tmp_path / "s"))
    update_summary(aggregate.withColumn("avg_temperature_c", F.lit(22.0)), str(tmp_path / "s"))
    assert rows(spark.read.parquet(str(tmp_path / "s")), "temperature_c") == [(22.0,)]


def test_summary_backfill(spark, rows):
    stored = spark.createDataFrame(
        [
            ("1", "Malang", -6.34, 107.42, "2031-03-09T01:00:00", 20.0, None),
            ("2", "Malang", -6.34, 107.42, "2031-03-09T01:00:00", 20.0, None),
            ("3", "Malang", -6.34, 107.42, "2031-03-09T01:00:00", 26.0, None),
            ("4", "Malang", -6.34, 107.42, "2031-03-09T02:00:00", 99.0, None),
            ("5", "Malang", -6.29, 107.37, "2031-03-09T02:00:00", 30.0, None),
        ],
        "_id STRING, location_name STRING, latitude DOUBLE, longitude DOUBLE, timestamp STRING, avg_temperature_c DOUBLE, avg_date STRING",
    )
    rejects = spark.createDataFrame([("4",)], "_id STRING")
    out = summary_backfill(stored, rejects, -6.34)
    # Equal rows count once.
    assert rows(out, "latitude", "temperature_c") == [(-6.34, 23.0)]


def test_data_backfill(spark, rows):
    docs = free_documents(
        spark,
        (free(20.0, "2031-03-09 09:17"), "2031-03-09 02:20:00"),
        (free(21.0, "2031-03-09 09:22"), "2031-03-09 02:25:00"),
        (free(22.0, "no time"), "2031-03-09 02:26:00"),
        (free(20.0, "2031-03-09 09:17"), "2031-03-09 02:27:00"),
    )
    out = data_backfill(docs, zone="Asia/Jakarta")
    assert [(str(t), c) for t, c in rows(out, "timestamp", "temp_c")] == [("2031-03-09 02:15:00", 20.0)]
    assert out.columns[6] == "timestamp" and "_id" not in out.columns


def series(spark, n=40, step=900):
    return spark.sql(
        f"""SELECT TIMESTAMP '2024-02-28 20:00:00' + make_dt_interval(0, 0, 0, id * {step}) AS timestamp,
        double(id) AS temp_c, double(id) / 10 AS precip_mm, 'i' || id AS icon, double(2 * id) AS humidity,
        double(id + 1) AS feelslike_c FROM range({n})"""
    )


def test_dashboard_frame(spark):
    columns = {"temperature": "temp_c", "humidity": "humidity", "feels_like": "feelslike_c", "precipitation": "precip_mm"}
    stacked = dashboard.stack_metrics(series(spark), columns, [])
    frame = dashboard.dashboard_frame(stacked, "quarter").orderBy("slot").collect()
    assert len(frame) == 32
    assert [r["Temperature"] for r in frame] == pytest.approx(list(range(24, 56)), abs=1e-6)
    assert [r["Humidity"] for r in frame][:2] == pytest.approx([48, 50])
    assert frame[0]["Hour"] == "02-29 02:00"
    with pytest.raises(ValueError):
        dashboard.history_and_forecast(stacked, "day")
    hourly_steps = dashboard.history_and_forecast(stacked, "quarter", parity=True).filter("kind = 'forecast'")
    span = hourly_steps.agg(F.max("timestamp") - F.min("timestamp")).first()[0]
    assert span.total_seconds() == 15 * 3600


def test_cards(spark):
    data = series(spark)
    parts = [serving.serving_series(data, m, "quarter") for m in ("temperature", "precipitation", "icon")]
    cards = dashboard.data_cards(*parts, slicing=4).orderBy("timestamp").collect()
    assert [(r["Hour"], r["Temperature"], r["Icon"]) for r in cards] == [
        ("02-29 05:00", 36.0, "i36"), ("02-29 05:15", 37.0, "i37"), ("02-29 05:30", 38.0, "i38"), ("02-29 05:45", 39.0, "i39"),
    ]
    hourly = dashboard.data_cards(*parts, slicing=2, mode="hour")
    text = dashboard.card_text(hourly).orderBy("timestamp").collect()
    assert [(r["Hour"], r["Temperature"]) for r in text] == [("02-29 05:00", "35.50"), ("02-29 06:00", "38.50")]
    with pytest.raises(ValueError):
        dashboard.data_cards(*parts, slicing=2, mode="day")


def test_sorted_rows_come_out_in_order(spark):
    """Many rows, equal times and nulls, through several sorted partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "timestamp_seconds((id * 7919) % 1000) AS ts", "IF(id % 10 = 0, NULL, id % 3) AS k").repartition(9)
        up = [(r["ts"], r["id"]) for r in serving.sort_by_time(df, "ts", "id").collect()]
        assert up == sorted(up) and len(up) == 5000
        down = [(r["ts"], r["id"]) for r in serving.sort_by_time(df, "ts", "id", descending=True).collect()]
        assert down == up[::-1]
        nulls = [r["k"] for r in serving.sort_by_time(df, "k").collect()]
        assert nulls[:500] == [None] * 500 and nulls[500:] == sorted(nulls[500:])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_filled_gap_comes_out_by_district_and_time(spark):
    history = spark.range(900).selectExpr("concat('d', id % 7) AS district", "timestamp_seconds(id * 3600) AS time", "id AS v")
    recent = spark.range(800, 1200).selectExpr("concat('d', id % 7) AS district", "timestamp_seconds(id * 3600) AS time", "id AS v")
    out = [(r["district"], r["time"]) for r in fill_gap(history.repartition(5), recent.repartition(3)).collect()]
    assert out == sorted(out) and len(out) == 1200
