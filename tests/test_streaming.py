from datetime import datetime

import pytest
from messages import FREE_WEATHER, OPEN_METEO, OPEN_WEATHER, free, log, meteo, open_weather, record
from pyspark.sql import functions as F

from isobar.operators.aggregate import hourly_means
from isobar.operators.reshape import provider_documents
from isobar.operators.serving import insert_if_absent
from isobar.plans.hourly import hourly_aggregate
from isobar.schemas import TOPICS
from isobar.sources.messages import good_records, kafka_options, parse_envelopes, parsed_once, rejected_records, stream_landed
from isobar.streaming.hourly import start_hourly_aggregate
from isobar.streaming.ingest import ingest_batch, keep_running, start_all
from isobar.streaming.stores import (
    document_schema,
    new_documents,
    read_documents,
    rows_and_crowds,
    rows_per_day,
    save_new_documents,
    spread_by_day,
    upsert_folder,
)
from isobar.streaming.windows import start_append, start_upserts, windowed_means

READINGS = "p STRING, ts TIMESTAMP, x DOUBLE"


def land(spark, folder, *records):
    log(spark, *records).coalesce(1).write.mode("append").parquet(str(folder))


def stored(spark, store, topic):
    schema = document_schema(provider_documents(log(spark), topic))
    return read_documents(spark, f"{store}/{topic}", schema)


def drain(queries):
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()


def test_ingest_replay_and_quarantine(spark, rows, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    land(
        spark, landed,
        record(FREE_WEATHER, free(20.0), 0),
        record(FREE_WEATHER, free(99.0), 1),  # same millisecond, same id
        record(FREE_WEATHER, "{broken", 2),
        record(OPEN_WEATHER, open_weather(300.0), 0),
        record(OPEN_WEATHER, open_weather(301.0), 1, "2031-03-09 04:00:00"),  # repeated reading
        record(OPEN_METEO, meteo(27.0), 0),
    )

    def run(checkpoints):
        drain(start_all(lambda t: stream_landed(spark, str(landed)), store, str(tmp_path / checkpoints)))

    run("c1")
    assert rows(stored(spark, store, FREE_WEATHER), "current_weather.temp_c") == [(20.0,)]
    assert rows(stored(spark, store, OPEN_WEATHER), "current_weather.main.temp") == [(300.0,)]
    assert rows(spark.read.parquet(f"{store}/_quarantine/{FREE_WEATHER}"), "offset", "value") == [(2, "{broken")]

    # The same id in a later batch, and a new one.
    land(spark, landed, record(OPEN_WEATHER, open_weather(302.0), 2), record(OPEN_WEATHER, open_weather(303.0, dt=1930793402), 3))
    run("c1")
    assert sorted(rows(stored(spark, store, OPEN_WEATHER), "current_weather.main.temp")) == [(300.0,), (303.0,)]

    # Everything replayed from the earliest offset by a query that has lost its checkpoint.
    before = {t: sorted(rows(stored(spark, store, t), "_id")) for t in TOPICS}
    run("c2")
    assert {t: sorted(rows(stored(spark, store, t), "_id")) for t in TOPICS} == before


def test_failed_batch_runs_again(spark, rows, tmp_path):
    store = str(tmp_path)
    first = log(spark, record(OPEN_WEATHER, open_weather(300.0), 0))
    second = log(spark, record(OPEN_WEATHER, open_weather(301.0), 1), record(OPEN_WEATHER, open_weather(302.0, dt=5), 2))
    ingest_batch(first, 0, OPEN_WEATHER, store)
    for _ in range(2):
        ingest_batch(second, 1, OPEN_WEATHER, store)
    assert sorted(rows(stored(spark, store, OPEN_WEATHER), "current_weather.main.temp", "batch")) == [(300.0, 0), (302.0, 1)]


def at(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


def landed_readings(spark, folder, *values):
    spark.createDataFrame(list(values), READINGS).coalesce(1).write.mode("append").parquet(str(folder))


def reading_stream(spark, folder):
    return spark.readStream.schema(READINGS).parquet(str(folder))


def test_windowed_means_equal_the_batch(spark, rows, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    values = [(p, at(h, m), float(h * m)) for p in "ab" for h in range(5) for m in (1, 20, 59)]
    landed_readings(spark, source, *values)
    run = lambda: drain(start_upserts(
        windowed_means(reading_stream(spark, source), "ts", ["p"], ["x"]), table, str(tmp_path / "c"), ["p", "timestamp"], ["n"]
    ))
    run()
    landed_readings(spark, source, ("a", at(4, 30), 1000.0), ("a", at(6), 1.0))
    run()
    batch = hourly_means(spark.read.parquet(str(source)), "ts", ["p"], ["x"])
    assert sorted(rows(spark.read.parquet(table), "p", "timestamp", "x")) == sorted(rows(batch, "p", "ts", "x"))


def test_late_rows_and_open_windows(spark, rows, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    run = lambda: drain(start_append(
        windowed_means(reading_stream(spark, source), "ts", ["p"], ["x"]), table, str(tmp_path / "c")
    ))
    landed_readings(spark, source, ("a", at(1, 10), 1.0), ("a", at(8), 5.0))
    run()
    # Later than the watermark of 06:00: its window is closed.
    landed_readings(spark, source, ("a", at(1, 50), 99.0), ("a", at(7), 7.0))
    run()
    assert rows(spark.read.parquet(table), "timestamp", "x") == [(at(1), 1.0)]


def test_stream_of_all_providers_equals_the_batch(spark, rows, tmp_path):
    landed, folder = tmp_path / "landed", str(tmp_path / "out")
    first = [
        record(FREE_WEATHER, free(20.0, "2031-03-09 09:15"), 0, "2031-03-09 02:16:00"),
        record(OPEN_WEATHER, open_weather(300.15), 0),
        record(OPEN_METEO, meteo(27.0, "2031-03-09T09:30"), 0),
    ]
    second = [
        record(FREE_WEATHER, free(22.0, "2031-03-09 09:45"), 1, "2031-03-09 02:46:00"),
        record(OPEN_WEATHER, open_weather(300.15), 1),  # repeated reading
        record(OPEN_METEO, meteo(29.0, "2031-03-09T10:30"), 1, "2031-03-09 03:31:00"),
    ]
    for part in (first, second):
        land(spark, landed, *part)
        drain(start_hourly_aggregate(lambda t: stream_landed(spark, str(landed)), folder, str(tmp_path / "c"), "Asia/Jakarta"))
    records = log(spark, *first, *second)
    docs = {t: provider_documents(records, t).dropDuplicates(["_id"]).drop("id_time", "partition", "offset") for t in TOPICS}
    columns = ["location_name", "timestamp", "avg_temperature_c", "avg_feels_like_c", "avg_wind_gust_kmph"]
    show = lambda df: sorted((a, b, *[round(v, 9) for v in c]) for a, b, *c in rows(df, *columns))
    streamed = spark.read.parquet(f"{folder}/summary")
    assert show(streamed) == show(hourly_aggregate(spark, docs, zone="Asia/Jakarta"))


def test_a_second_checkpoint_deletes_nothing(spark, rows, tmp_path):
    store = str(tmp_path / "store")

    def run(name, *records):
        land(spark, tmp_path / name, *records)
        drain(start_all(lambda t: stream_landed(spark, str(tmp_path / name)), store, str(tmp_path / f"c-{name}")))

    run("live", record(OPEN_WEATHER, open_weather(300.0), 0), record(OPEN_WEATHER, open_weather(301.0, dt=1930789900), 1))
    # Another query's batch 0 with one new document of the same day.
    run("backfill", record(OPEN_WEATHER, open_weather(302.0, dt=1930790000), 5))
    temps = sorted(rows(stored(spark, store, OPEN_WEATHER), "current_weather.main.temp"))
    assert temps == [(300.0,), (301.0,), (302.0,)]
    assert stored(spark, store, OPEN_WEATHER).select("run").distinct().count() == 2


def test_a_provider_that_is_behind_loses_nothing(spark, rows, tmp_path):
    landed, folder = tmp_path / "landed", str(tmp_path / "out")
    start = lambda: drain(start_hourly_aggregate(
        lambda t: stream_landed(spark, str(landed)), folder, str(tmp_path / "c"), "Asia/Jakarta"
    ))
    land(spark, landed, record(OPEN_METEO, meteo(27.0, "2031-03-09T15:30"), 0))
    start()
    # Six hours earlier, from another provider and after the first one's watermark has passed.
    land(spark, landed, record(FREE_WEATHER, free(20.0, "2031-03-09 09:15"), 0, "2031-03-09 02:16:00"))
    start()
    hours = rows(spark.read.parquet(f"{folder}/summary"), "timestamp", "avg_temperature_c")
    assert sorted((t.hour, v) for t, v in hours) == [(2, 20.0), (8, 27.0)]


def test_a_failed_query_is_started_again(spark, tmp_path):
    landed, calls = tmp_path / "landed", []
    land(spark, landed, record(OPEN_METEO, meteo(27.0), 0))

    def start(topic):
        def batch(df, batch_id):
            calls.append(batch_id)
            if len(calls) == 1:
                raise RuntimeError("lost")

        stream = stream_landed(spark, str(landed)).writeStream.foreachBatch(batch)
        return stream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    keep_running(start, ["t"], wait=0, restarts=2)
    assert calls == [0, 0]


def test_upsert_is_repeatable(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    make = lambda *v: spark.createDataFrame(list(v), "k STRING, timestamp TIMESTAMP, v INT")
    upsert_folder(make(("a", at(1), 1), ("b", at(1, day=2), 1)), folder, ["k", "timestamp"], ["v"])
    batch = make(("a", at(1), 2), ("c", at(1), 1))
    for _ in range(2):
        upsert_folder(batch, folder, ["k", "timestamp"], ["v"])
    upsert_folder(batch.limit(0), folder, ["k", "timestamp"], ["v"])
    assert sorted(rows(spark.read.parquet(folder), "k", "v")) == [("a", 2), ("b", 1), ("c", 1)]
    for v in (1, 2):
        upsert_folder(make(("n", None, v)), folder, ["k", "timestamp"], ["v"])
    assert rows(spark.read.parquet(folder).filter("k = 'n'"), "v") == [(2,)]


def test_a_full_day_is_spread_over_tasks(spark):
    df = spark.sql(
        """SELECT id, CASE WHEN id % 3 = 0 THEN DATE '2024-01-01' ELSE date_add(DATE '2024-01-02', CAST(id % 40 AS INT)) END AS d
        FROM range(6000)"""
    )
    spread = spread_by_day(df, "d", rows_per_day(df, "d"), ["id"])
    tasks = spread.withColumn("t", F.spark_partition_id())
    hot = tasks.filter("d = DATE '2024-01-01'")
    assert hot.select("t").distinct().count() > 1
    assert tasks.filter("d <> DATE '2024-01-01'").groupBy("d").agg(F.countDistinct("t").alias("n")).agg(F.max("n")).first()[0] == 1
    assert spread.count() == 6000


def test_kafka_options():
    options = kafka_options("host:9092", maxOffsetsPerTrigger="1000")
    assert options["subscribe"] == "free-weather,open-weather,open-meteo"
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"


def test_missing_store_is_empty(spark, tmp_path):
    assert stored(spark, str(tmp_path / "none"), OPEN_METEO).count() == 0
    with pytest.raises(Exception):
        spark.read.parquet(str(tmp_path / "none"))


def test_counts_stay_with_the_rows(spark):
    means = windowed_means(spark.createDataFrame([("a", at(1), 1.0), ("a", at(1, 30), 2.0)], READINGS), "ts", ["p"], ["x"], delay=None)
    assert [(r["x"], r["n"]) for r in means.select("x", F.col("n")).collect()] == [(1.5, 2)]


def test_a_query_with_state_has_no_more_stores_than_cores(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        land(spark, tmp_path / "in", record(FREE_WEATHER, free(20.0), 0))
        queries = start_hourly_aggregate(lambda t: stream_landed(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c"), "Asia/Jakarta")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
        drain(queries)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for topic in TOPICS:
        assert '"spark.sql.shuffle.partitions":"8"' in (tmp_path / "c" / topic / "offsets" / "0").read_text()


DATED = "_id STRING, id_time TIMESTAMP, id_date DATE, partition INT, offset LONG, text STRING"


def dated(spark, *ids):
    return spark.createDataFrame([(i, t, t.date(), p, o, f"{i} {o}") for i, t, p, o in ids], DATED)


def copies(spark, n=600):
    """Ids of four days, each of them three times, the first of them last; one id is null."""
    ids = [(f"i{k % (n // 3)}" if k % (n // 3) else None, at(k % 20, day=1 + k % (n // 3) % 4), 0, n - k) for k in range(n)]
    return dated(spark, *ids)


def test_new_documents_are_shuffled_once(spark, rows):
    incoming = copies(spark)
    held = dated(spark, *[(f"i{k}", at(1, day=1 + k % 4), 0, 0) for k in range(0, 200, 2)])
    counts = rows_per_day(incoming, "id_date")
    fresh = new_documents(incoming, held, counts)
    want = insert_if_absent(incoming, held, "_id", "partition", "offset")
    key = ("text", "id_date", "offset")
    assert sorted(rows(fresh, *key)) == sorted(rows(want, *key)) and fresh.count() == 101
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(fresh).count("Exchange") == 1
    one_day = fresh.withColumn("t", F.spark_partition_id()).groupBy("t", "id_date").count()
    assert one_day.count() <= int(spark.conf.get("spark.sql.shuffle.partitions")) + 4


def test_crowded_ids_are_cut_before_the_shuffle(spark, rows, tmp_path, monkeypatch):
    incoming = copies(spark)
    hot = dated(spark, *[("hot", at(3), 0, 1000 + k) for k in range(300)]).unionByName(incoming)
    columns = ("_id", "offset")
    save = lambda df, name: save_new_documents(df.drop("id_date"), 0, str(tmp_path / name))
    show = lambda name: sorted(rows(spark.read.parquet(str(tmp_path / name)), *columns), key=str)
    save(hot, "whole")
    monkeypatch.setattr("isobar.streaming.stores.CROWD", 50)
    assert rows_and_crowds(hot)[1] and not rows_and_crowds(incoming.filter("id_time > TIMESTAMP '2030-01-01'"))[1]
    assert rows_and_crowds(hot)[0] == rows_per_day(hot, "id_date")
    save(hot, "cut")
    assert show("whole") == show("cut") and len(show("cut")) == 201 and ("hot", 1000) in show("cut")


def test_full_days_have_tasks_of_their_own(spark):
    df = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 4 AS INT)) AS d FROM range(8000)")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = spread_by_day(df, "d", rows_per_day(df, "d"), ["id"]).withColumn("t", F.spark_partition_id())
    most = spread.groupBy("t").count().agg(F.max("count")).first()[0]
    assert tasks < 4 or most < 2.2 * 8000 / tasks


def test_a_batch_keeps_each_message_in_one_form(spark, rows):
    empty = record(FREE_WEATHER, "", 2)
    records = log(spark, record(FREE_WEATHER, free(20.0), 0), record(FREE_WEATHER, "{broken", 1), (None, None, *empty[2:]))
    parsed = parse_envelopes(records, FREE_WEATHER)
    kept = parsed_once(parsed)
    assert sorted(rows(kept.selectExpr("offset", "value IS NULL AS v", "envelope IS NULL AS e"))) == [(0, True, False), (1, False, True), (2, True, True)]
    assert sorted(rows(rejected_records(kept), "offset", "value")) == sorted(rows(rejected_records(parsed), "offset", "value")) == [(1, "{broken"), (2, None)]
    assert rows(good_records(kept), "offset", "envelope") == rows(good_records(parsed), "offset", "envelope")
