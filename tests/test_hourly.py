import pytest
from messages import FREE_WEATHER, OPEN_METEO, OPEN_WEATHER, free, log, meteo, open_weather, record
from pyspark.sql import functions as F

from isobar.operators.aggregate import (
    common_columns,
    fix_kelvin,
    fix_kelvin_by_day,
    fix_kelvin_by_provider,
    hourly_means,
    mean_of_means,
    mean_over_frames,
    union_all,
)
from isobar.operators.reshape import provider_documents
from isobar.plans.hourly import hourly_aggregate
from isobar.schemas import HOURLY_AGGREGATE, TOPICS


def documents(spark):
    records = log(
        spark,
        record(FREE_WEATHER, free(20.0, "2031-03-09 09:15"), 0, "2031-03-09 02:16:00"),
        record(FREE_WEATHER, free(22.0, "2031-03-09 09:45"), 1, "2031-03-09 02:46:00"),
        record(FREE_WEATHER, free(30.0, "2031-03-09 06:45"), 2, "2031-03-08 23:46:00"),
        record(OPEN_WEATHER, open_weather(300.15), 0),
        record(OPEN_METEO, meteo(27.0, "2031-03-09T09:30"), 0),
    )
    return {t: provider_documents(records, t, F.col("timestamp")).drop("id_time", "partition", "offset") for t in TOPICS}


def test_three_providers_unweighted(spark):
    out = hourly_aggregate(spark, documents(spark), zone="Asia/Jakarta")
    assert out.columns == HOURLY_AGGREGATE.names
    newest, older = out.collect()
    assert str(newest["timestamp"]) == "2031-03-09 02:00:00"
    # Providers have 21, 27 and 27 degrees; how many readings each has does not count.
    assert newest["avg_temperature_c"] == pytest.approx(25.0)
    assert newest["avg_feels_like_c"] == pytest.approx((22.25 + 32.35 + 29.5) / 3)
    assert older["avg_temperature_c"] == 30.0


def test_parity_keeps_feels_like_and_place(spark):
    out = hourly_aggregate(spark, documents(spark), zone="Asia/Jakarta", parity=True).collect()
    assert out[0]["avg_feels_like_c"] == pytest.approx((22.25 + 305.5 + 29.5) / 3)
    assert {r["location_name"] for r in out} == {"Malang"}


def test_one_provider_alone(spark):
    one = {OPEN_METEO: documents(spark)[OPEN_METEO]}
    assert [r["avg_temperature_c"] for r in hourly_aggregate(spark, one).collect()] == [27.0]
    with pytest.raises(ValueError):
        hourly_aggregate(spark, one, parity=True)


def test_lookback_and_limit(spark):
    as_of = F.lit("2031-03-09 03:00:00").cast("timestamp")
    docs = documents(spark)
    assert len(hourly_aggregate(spark, docs, as_of, zone="Asia/Jakarta").collect()) == 1
    newest = hourly_aggregate(spark, {FREE_WEATHER: docs[FREE_WEATHER]}, as_of, limit=1, zone="Asia/Jakarta")
    assert [r["avg_temperature_c"] for r in newest.collect()] == [22.0]


def test_units_and_coordinates(spark):
    docs = documents(spark)
    out = hourly_aggregate(
        spark, {OPEN_WEATHER: docs[OPEN_WEATHER]}, factors={OPEN_WEATHER: {"wind_speed_kmph": 3.6}}, places=0
    ).first()
    assert out["avg_wind_speed_kmph"] == pytest.approx(2.5 * 3.6)
    assert (out["latitude"], out["longitude"]) == (-6.0, 107.0)


def test_no_provider_gives_empty_table(spark):
    out = hourly_aggregate(spark, {})
    assert out.schema.simpleString() == HOURLY_AGGREGATE.simpleString() and out.count() == 0


def test_different_coordinates_do_not_meet(spark):
    records = log(
        spark, record(FREE_WEATHER, free(20.0), 0), record(OPEN_METEO, meteo(30.0, lat=-6.29, lon=107.37), 0)
    )
    docs = {t: provider_documents(records, t).drop("id_time", "partition", "offset") for t in (FREE_WEATHER, OPEN_METEO)}
    assert sorted(r["avg_temperature_c"] for r in hourly_aggregate(spark, docs).collect()) == [20.0, 30.0]


@pytest.mark.parametrize(
    "temps, want",
    [([273.15], [273.15]), ([300.0, None], [26.85, None]), ([None], [None]), ([260.0, 290.0], [-13.15, 16.85]), ([20.0], [20.0])],
)
def test_kelvin_switch_is_on_the_mean(spark, temps, want):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(temps)], "i INT, temperature_c DOUBLE")
    got = [r["temperature_c"] for r in fix_kelvin(df).orderBy("i").collect()]
    assert [None if g is None else round(g, 6) for g in got] == want


def test_kelvin_switch_by_provider(spark):
    df = spark.createDataFrame([("a", 300.15), ("a", 310.15), ("b", 20.0)], "p STRING, t DOUBLE")
    out = fix_kelvin_by_provider(df, "p", ["a", "b"], ["t"]).collect()
    assert [round(r["t"], 6) for r in out] == [27.0, 37.0, 20.0]
    # The unit of a provider that is not declared is unknown.
    with pytest.raises(Exception, match="undeclared provider b"):
        fix_kelvin_by_provider(df, "p", ["a"], ["t"]).collect()
    days = spark.createDataFrame([("a", 1, 300.0, 1), ("a", 2, 20.0, 9), ("b", 1, 280.0, 2), ("b", 1, None, 5)], "p STRING, d INT, t DOUBLE, n INT")
    by_day = fix_kelvin_by_day(days, "p", "d", "n", ["t"]).collect()
    assert sorted((r["p"], r["d"], round(r["t"], 2)) for r in by_day if r["t"] is not None) == [("a", 1, 26.85), ("a", 2, 20.0), ("b", 1, 6.85)]
    # Means of hours count by their readings: (300 * 1 + 20 * 9) / 10 is no Kelvin.
    hours = spark.createDataFrame([("a", 300.0, 1), ("a", 20.0, 9), ("a", None, 5)], "p STRING, t DOUBLE, n INT")
    assert [r["t"] for r in fix_kelvin_by_provider(hours, "p", ["a"], ["t"], weight="n").collect()] == [300.0, 20.0, None]
    assert fix_kelvin_by_provider(hours, "p", ["a"], ["t"]).first()["t"] == 300.0


def test_mean_over_frames_guards(spark):
    a = spark.createDataFrame([("d", 1.0, 2.0, 5.0, 1.0)], "district STRING, latitude DOUBLE, longitude DOUBLE, x DOUBLE, y DOUBLE")
    b = spark.createDataFrame([("d", 1.0, 2.0, 7.0)], "district STRING, latitude DOUBLE, longitude DOUBLE, x DOUBLE")
    assert common_columns([a, b]) == ["district", "latitude", "longitude", "x"]
    assert [tuple(r) for r in mean_over_frames([a, b]).collect()] == [("d", 1.0, 2.0, 6.0)]
    with pytest.raises(ValueError):
        mean_over_frames([a])
    with pytest.raises(ValueError):
        mean_over_frames([a, b.drop("district")])
    assert union_all([a, b], fill=True).count() == 2


def test_one_scan_equals_frames(spark):
    df = spark.sql(
        """SELECT element_at(array('a', 'b', 'c'), CAST(id % 3 + 1 AS INT)) AS p, id % 5 AS place,
            timestamp_seconds(id * 997) AS ts, CAST(id AS DOUBLE) AS x FROM range(300)"""
    )
    frames = [hourly_means(df.filter(F.col("p") == p), "ts", ["place"], ["x"]) for p in "abc"]
    one = mean_of_means(df.withColumn("ts", F.date_trunc("hour", "ts")), "p", ["place", "ts"], ["x"])
    key = lambda r: (r["place"], r["ts"], round(r["avg_x"], 9))
    assert sorted(map(key, mean_over_frames(frames, ["place", "ts"]).collect())) == sorted(map(key, one.collect()))
