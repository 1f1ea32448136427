from datetime import date, datetime

import pytest
from messages import OPEN_WEATHER, log, open_weather, record
from pyspark.sql import functions as F

from isobar.operators.reshape import provider_documents
from isobar.streaming import versions as vs
from isobar.streaming.ingest import ingest_batch
from isobar.streaming.packing import drop_packed, pack_days, packs, read_store
from isobar.streaming.stores import document_schema
from isobar.streaming.versions import VersionedTable, start_published_upserts

ROWS = "p STRING, timestamp TIMESTAMP, x DOUBLE"


def readings(spark, *rows):
    return spark.createDataFrame([(p, None if d is None else datetime(2024, 1, d, h), x) for p, d, h, x in rows], ROWS)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, f"{tmp_path}/t", readings(spark).schema)


def upsert(table, *rows):
    return table.upsert(readings(table.spark, *rows), ["p", "timestamp"], ["x"])


def shown(df):
    return sorted((r["p"], r["timestamp"] and (r["timestamp"].day, r["timestamp"].hour), r["x"]) for r in df.collect())


def test_readers_see_the_old_or_the_new_table(spark, table):
    upsert(table, ("a", 1, 1, 1.0), ("a", 2, 1, 1.0), ("b", None, 0, 5.0))
    before = table.read()
    table.show_as("readings_now")
    view = spark.table("readings_now")
    upsert(table, ("a", 1, 1, 9.0), ("a", 1, 2, 2.0))
    old = [("a", (1, 1), 1.0), ("a", (2, 1), 1.0), ("b", None, 5.0)]
    assert shown(before) == shown(view) == old
    assert shown(table.read()) == [("a", (1, 1), 9.0), ("a", (1, 2), 2.0), ("a", (2, 1), 1.0), ("b", None, 5.0)]
    assert shown(table.read([date(2024, 1, 2), None])) == [("a", (2, 1), 1.0), ("b", None, 5.0)]
    assert shown(table.read(number=1)) == old
    assert shown(spark.table("readings_now")) == old
    table.show_as("readings_now")
    assert len(shown(spark.table("readings_now"))) == 4


def test_a_failed_change_leaves_the_old_table(spark, table, monkeypatch):
    upsert(table, ("a", 1, 1, 1.0))

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(vs.storage, "touch", fail)
        with pytest.raises(OSError):
            upsert(table, ("a", 1, 1, 2.0))
    assert shown(table.read()) == [("a", (1, 1), 1.0)]
    upsert(table, ("a", 1, 1, 3.0))
    assert shown(table.read()) == [("a", (1, 1), 3.0)]


def test_a_publisher_that_died_after_its_claim(spark, table):
    upsert(table, ("a", 1, 1, 1.0))
    vs.storage.touch(spark, f"{table.folder}/claims/{2:012d}")
    with pytest.raises(RuntimeError):
        upsert(table, ("a", 1, 1, 2.0))
    table.release_claim()
    upsert(table, ("a", 1, 1, 2.0))
    assert shown(table.read()) == [("a", (1, 1), 2.0)]


def test_two_changes_of_one_state(spark, table):
    day = F.to_date("timestamp").alias("event_date")
    upsert(table, ("a", 1, 1, 1.0))
    rows = readings(spark, ("a", 1, 1, 2.0)).select("*", day)
    table.publish(rows, [date(2024, 1, 1)], ["p"], before=1)
    with pytest.raises(RuntimeError):
        table.publish(rows, [date(2024, 1, 1)], ["p"], before=1)
    with pytest.raises(ValueError):
        table.publish(rows, [date(2024, 1, 2)], ["p"])
    table.publish(rows.limit(0), [date(2024, 1, 1)], ["p"])
    assert table.read().count() == 0 and upsert(table) == []


def test_old_versions_go(spark, table, tmp_path):
    for x in range(5):
        upsert(table, ("a", 1, 1, float(x)), ("a", 2, 1, 0.0))
    upsert(table, ("a", 3, 1, 1.0))
    assert table.clean(keep=2) == 8
    assert shown(table.read()) == [("a", (1, 1), 4.0), ("a", (2, 1), 0.0), ("a", (3, 1), 1.0)]
    assert len(list((tmp_path / "t/data/event_date=2024-01-01").iterdir())) == 1
    assert table.clean(keep=2) == 0


def test_a_stream_publishes(spark, tmp_path, table):
    schema = readings(spark).withColumn("n", F.lit(1).cast("long")).schema
    target = lambda s: VersionedTable(s, f"{tmp_path}/s", schema)
    for rows in ([("a", 1, 1, 1.0)], [("a", 1, 1, 3.0), ("b", 2, 5, 1.0)]):
        readings(spark, *rows).write.mode("append").parquet(f"{tmp_path}/in")
        means = spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in").groupBy("p", "timestamp").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
        start_published_upserts(means, target, f"{tmp_path}/c", ["p", "timestamp"], ["n"], lambda t: t.show_as("published")).awaitTermination()
    assert shown(target(spark).read()) == [("a", (1, 1), 2.0), ("b", (2, 5), 1.0)]


# Packing of document stores.


@pytest.fixture
def store(spark, tmp_path):
    folder = str(tmp_path / "store")
    schema = document_schema(provider_documents(log(spark), OPEN_WEATHER))
    days = [1930788000, 1930788000 + 86400, 1930788000 + 2 * 86400]
    for batch in range(6):
        rows = [record(OPEN_WEATHER, open_weather(300.0 + batch, dt=day + batch // 2), 10 * batch + k) for k, day in enumerate(days)]
        ingest_batch(log(spark, *rows), batch, OPEN_WEATHER, folder, run=f"r{batch % 2}")
    return f"{folder}/{OPEN_WEATHER}", schema, folder


def ids(df):
    return sorted((r["_id"], r["offset"], r["run"], r["batch"]) for r in df.select("_id", "offset", "run", "batch").collect())


def files(folder, pattern):
    from pathlib import Path

    return list(Path(folder).glob(f"{pattern}/*.parquet"))


def test_packing_keeps_rows_and_bounds_files(spark, store):
    folder, schema, _ = store
    before = ids(read_store(spark, folder, schema))
    days = sorted(r[0] for r in read_store(spark, folder, schema).select("id_date").distinct().collect())
    assert len(days) == 3 and len(before) == 9
    pack_days(spark, folder, schema, days[:2], rows_per_file=2)
    assert ids(read_store(spark, folder, schema)) == before
    assert all(len(files(folder, f"_packs/data/id_date={d}/version=*")) <= 2 for d in days[:2])
    assert drop_packed(spark, folder, schema) == 6
    assert ids(read_store(spark, folder, schema)) == before and read_store(spark, folder, schema, days[:1]).count() == 3
    assert not files(folder, f"id_date={days[0]}/run=*/batch=*") and files(folder, f"id_date={days[2]}/run=*/batch=*")
    # Packing again, with nothing new, and with the last day.
    pack_days(spark, folder, schema, days)
    assert ids(read_store(spark, folder, schema)) == before
    assert drop_packed(spark, folder, schema) == 3 and drop_packed(spark, folder, schema) == 0
    assert ids(read_store(spark, folder, schema)) == before


def test_replay_and_new_rows_after_packing(spark, store):
    folder, schema, root = store
    before = ids(read_store(spark, folder, schema))
    days = [r[0] for r in read_store(spark, folder, schema).select("id_date").distinct().collect()]
    pack_days(spark, folder, schema, days)
    old = [record(OPEN_WEATHER, open_weather(999.0, dt=1930788000 + k), 900 + k) for k in range(3)]
    ingest_batch(log(spark, *old), 0, OPEN_WEATHER, root, run="replay")
    assert ids(read_store(spark, folder, schema)) == before
    drop_packed(spark, folder, schema)
    ingest_batch(log(spark, *old), 1, OPEN_WEATHER, root, run="replay")
    # A batch that was packed runs again.
    ingest_batch(log(spark, record(OPEN_WEATHER, open_weather(300.0, dt=1930788000), 0)), 0, OPEN_WEATHER, root, run="r0")
    assert ids(read_store(spark, folder, schema)) == before
    ingest_batch(log(spark, record(OPEN_WEATHER, open_weather(1.0, dt=1930788050), 70)), 2, OPEN_WEATHER, root, run="replay")
    assert len(ids(read_store(spark, folder, schema))) == len(before) + 1
    pack_days(spark, folder, schema, days)
    drop_packed(spark, folder, schema)
    assert len(ids(read_store(spark, folder, schema))) == len(before) + 1


def test_ids_stored_twice_are_packed_once(spark, store):
    folder, schema, root = store
    rows = read_store(spark, folder, schema).withColumns({"run": F.lit("twin"), "batch": F.lit(0).cast("long"), "offset": F.col("offset") + 100})
    rows.write.mode("append").partitionBy("id_date", "run", "batch").parquet(folder)
    assert read_store(spark, folder, schema).count() == 18
    days = [r[0] for r in rows.select("id_date").distinct().collect()]
    pack_days(spark, folder, schema, days)
    found = ids(read_store(spark, folder, schema))
    assert len(found) == 9 and all(r[2] != "twin" for r in found)
    assert drop_packed(spark, folder, schema) > 9 and ids(read_store(spark, folder, schema)) == found


def test_no_store(spark, tmp_path):
    schema = document_schema(provider_documents(log(spark), OPEN_WEATHER))
    assert read_store(spark, f"{tmp_path}/none", schema).count() == 0
    assert drop_packed(spark, f"{tmp_path}/none", schema) == 0 and packs(spark, f"{tmp_path}/none", schema).versions() == {}
