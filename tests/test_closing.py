from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.streaming.closing import HourCloser, closing_hours, means, open_hours, saved_rows, start_closing_hours

SHAPE = "p STRING, ts TIMESTAMP, x DOUBLE, y DOUBLE"
T0 = datetime(2024, 1, 1)


@pytest.fixture
def stream(spark, tmp_path):
    """Lands rows (p, minutes, x, y) and drains them by the same query; gives its closed, late and open rows."""

    def land(*rows):
        made = [(p, None if m is None else T0 + timedelta(minutes=m), x, y) for p, m, x, y in rows]
        spark.createDataFrame(made, SHAPE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SHAPE).parquet(f"{tmp_path}/in")
        start_closing_hours(source, "ts", ["p"], ["x", "y"], f"{tmp_path}/out", f"{tmp_path}/check", "1 hour").awaitTermination()

    land.saved = lambda kind: saved_rows(spark, f"{tmp_path}/out", [spark.createDataFrame([], SHAPE).schema["p"]], ["x", "y"], kind)
    land.open = lambda: open_hours(spark, f"{tmp_path}/check", ["p"], ["x", "y"])
    return land


def counted(df):
    return df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).first()["s"]


def test_late_rows_are_put_aside(spark, rows, stream):
    stream(("a", 1, 1.0, None), ("a", 50, 3.0, 5.0), ("b", 10, 3.0, 1.0), (None, 20, 1.0, 1.0))
    assert counted(stream.saved("closed")) == 0 and counted(stream.open()) == 4
    stream(("a", 200, 4.0, 4.0), ("b", 230, 4.0, 4.0), ("a", 30, 5.0, 1.0))
    # The watermark stood before the first hour's end when the last row came, so it still counts.
    stream(("a", 20, 100.0, None), ("a", 210, 5.0, 1.0), ("b", 400, 1.0, 1.0), ("a", None, 1.0, 1.0))
    closed, late = stream.saved("closed"), stream.saved("late")
    hours = {(r["p"], (r["timestamp"] - T0) // timedelta(hours=1)): r for r in means(closed, ["p"], ["x", "y"]).collect()}
    assert {k: (r["n"], r["x"], r["y"]) for k, r in hours.items()} == {
        ("a", 0): (3, 3.0, 3.0), ("b", 0): (1, 3.0, 1.0), (None, 0): (1, 1.0, 1.0), ("a", 3): (2, 4.5, 2.5), ("b", 3): (1, 4.0, 4.0),
    }
    assert rows(late, "p", "ts", "x_n", "x_sum", "y_n") == [("a", T0 + timedelta(minutes=20), 1, 100.0, 0)]
    assert counted(closed) + counted(late) + counted(stream.open()) == 10
    corrected = means(closed.unionByName(late), ["p"], ["x", "y"]).filter("p = 'a' AND n = 4").first()
    assert corrected["x"] == pytest.approx(109 / 4)


def test_a_closed_hour_stays_closed(spark, rows, stream):
    stream(("a", 10, 1.0, 1.0), ("a", 300, 1.0, 1.0))
    stream(("a", 11, 2.0, 2.0), ("c", 12, 3.0, 3.0))
    stream(("a", 13, 4.0, 4.0), ("a", 400, 1.0, 1.0))
    assert rows(stream.saved("closed").filter("timestamp < '2024-01-01 01:00:00'"), "p", "n", "x_sum") == [("a", 1, 1.0)]
    assert sorted(rows(stream.saved("late"), "p", "x_sum")) == [("a", 2.0), ("a", 4.0), ("c", 3.0)]


def test_processor_without_a_session():
    class Timer:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, new):
            self.held = new

        def clear(self):
            self.held = None

    class Handle:
        timers = ()

        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            self.timers += (at,)

    import pandas as pd

    closer, handle = HourCloser(1, ["x"]), Handle()
    closer.init(handle)
    part = pd.DataFrame({"micros": [1, 2], "x": [1.0, None]})
    for _ in range(2):
        assert list(closer.handleInputRows(("a", 2), iter([part, part]), Timer(0))) == []
    assert handle.timers == (3 * 3_600_000,) and closer.sums.get() == (8, 4, 4.0)
    assert next(closer.handleExpiredTimer(("a", 2), None, None)).values.tolist() == [["a", 2, "closed", None, 8, 4, 4.0]]
    late = list(closer.handleInputRows(("a", 2), iter([part]), Timer(3 * 3_600_000)))
    assert late[0].values.tolist() == [["a", 2, "late", 1, 1, 1, 1.0], ["a", 2, "late", 2, 1, 0, 0.0]]


def test_needs_the_columns(spark):
    with pytest.raises(Exception):
        closing_hours(spark.createDataFrame([], SHAPE), "ts", ["gone"], ["x"])
