from datetime import datetime, timedelta

import pytest
from messages import OPEN_WEATHER, log, open_weather, record
from pyspark.sql import functions as F

from isobar.sources.messages import stream_landed
from isobar.streaming.closing import start_closing_hours
from isobar.streaming.rates import RateListener, read_rates, start_measured_ingest


@pytest.fixture
def listener(spark, tmp_path):
    made = RateListener(spark, f"{tmp_path}/rates")
    spark.streams.addListener(made)
    yield made
    spark.streams.removeListener(made)


def test_accepted_and_rejected_per_batch(spark, rows, tmp_path, listener):
    batches = [
        [record(OPEN_WEATHER, open_weather(300.0), 0), record(OPEN_WEATHER, "{broken", 1)],
        [record(OPEN_WEATHER, open_weather(300.0 + k, dt=k), 10 + k) for k in range(5)],
    ]
    for part in batches:
        log(spark, *part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = start_measured_ingest(stream_landed(spark, f"{tmp_path}/in"), OPEN_WEATHER, f"{tmp_path}/store", f"{tmp_path}/c")
        query.awaitTermination()
        assert listener.wait(query)
    found = read_rates(spark, f"{tmp_path}/rates").orderBy("batch")
    assert rows(found, "query", "batch", "input_rows", "accepted", "rejected", "late") == [
        (f"ingest-{OPEN_WEATHER}", 0, 2, 1, 1, None), (f"ingest-{OPEN_WEATHER}", 1, 5, 5, 0, None),
    ]
    assert found.filter("lag_seconds IS NULL OR batch_ms IS NULL").count() == 0 and not listener.failed
    assert spark.read.parquet(f"{tmp_path}/store/{OPEN_WEATHER}").count() == 6


def test_late_rows_are_reported(spark, rows, tmp_path, listener):
    shape = "p STRING, ts TIMESTAMP, x DOUBLE"
    for minutes in ([5, 300], [6, 7, 310], [900]):
        made = [("a", datetime(2024, 1, 1) + timedelta(minutes=m), 1.0) for m in minutes]
        spark.createDataFrame(made, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(shape).parquet(f"{tmp_path}/in")
        query = start_closing_hours(source, "ts", ["p"], ["x"], f"{tmp_path}/out", f"{tmp_path}/c", "1 hour")
        query.awaitTermination()
        assert listener.wait(query)
    sums = read_rates(spark, f"{tmp_path}/rates").agg(F.sum("late").alias("late"), F.sum("closed").alias("closed"))
    assert rows(sums) == [(2, 3)]
