import hashlib

import pytest
from pyspark.sql import functions as F

from isobar.functions import times as tf
from isobar.functions.ids import binary_text_id, concat_id
from isobar.functions.paths import json_path, path_or_null


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t STRING")


def stamps(spark, *values):
    return texts(spark, *values).select(F.to_timestamp("t").alias("ts"), "t")


def test_reading_times_in_all_forms(spark, rows):
    df = texts(
        spark, "2031-03-09 09:15", "2031-03-09T09:15", "2031-03-09 09:15:02+07:00",
        "2031-03-09 09:15:02.123456", "no time", None,
    )
    iso = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert rows(df, iso(tf.parse_reading_time("t"))) == [
        ("2031-03-09 09:15:00",), ("2031-03-09 09:15:00",), ("2031-03-09 02:15:02",), (None,), (None,), (None,),
    ]
    assert rows(df, iso(tf.parse_mixed_time("t", "Asia/Jakarta"))) == [
        ("2031-03-09 02:15:00",), ("2031-03-09 02:15:00",), ("2031-03-09 02:15:02",), ("2031-03-09 02:15:02",),
        (None,), (None,),
    ]


MINUTES = (0, 2, 3, 13, 15, 17, 29, 30, 45, 58, 59)


def test_near_slots(spark):
    df = stamps(spark, *[f"2024-02-29 10:{m:02d}:30" for m in MINUTES])

    def kept(*args):
        return [r[0] for r in df.filter(tf.near_slot("ts", *args)).select(F.minute("ts")).collect()]

    assert kept("hourly") == [0, 2]
    assert kept("quarter") == [0, 2, 13, 15, 17, 29, 30, 45]
    assert kept("hourly", 2, True) == [0, 2, 58, 59]
    with pytest.raises(ValueError):
        tf.near_slot("ts", "daily")


def test_buckets_and_labels(spark, rows):
    df = stamps(spark, "2024-02-29 23:14:59", "2024-02-29 23:29:00", "2024-02-29 23:30:00", "2024-12-31 23:59:00")
    assert rows(df, tf.label(tf.quarter_hour_of("ts")), tf.label(tf.nearest_hour("ts")), tf.label(tf.hour_of("ts"))) == [
        ("02-29 23:00", "02-29 23:00", "02-29 23:00"),
        ("02-29 23:15", "02-29 23:00", "02-29 23:00"),
        ("02-29 23:30", "03-01 00:00", "02-29 23:00"),
        ("12-31 23:45", "01-01 00:00", "12-31 23:00"),
    ]


def test_zones(spark, rows):
    df = stamps(spark, "2017-10-28 01:00:00")
    assert rows(df, tf.t_text(tf.shift_zone("ts"))) == [("2017-10-27T15:00",)]
    assert rows(df, tf.zoned_text(F.lit(1930789802))) == [("2031-03-09 09:30:02+07:00",)]
    assert rows(df, tf.append_seconds(F.lit("2025-01-01T14:00"), ":00-07")) == [("2025-01-01 14:00:00-07",)]


@pytest.mark.parametrize("text", ["1930789381123", "2031-03-09 09:30:02+07:00", "a"])
def test_binary_text_id(spark, rows, text):
    bits = "".join(format(ord(c), "08b") for c in text)
    assert rows(texts(spark, text), binary_text_id("t")) == [(hashlib.sha256(bits.encode()).hexdigest(),)]


def test_concat_id_counts_missing_parts(spark, rows):
    df = spark.createDataFrame([("Klojen", "2025-01-01T00:00"), (None, "x")], "d STRING, t STRING")
    want = [(hashlib.sha256(s.encode()).hexdigest(),) for s in ("Klojen2025-01-01T00:00", "Nonex")]
    assert rows(df, concat_id("d", "t")) == want


def test_paths(spark, rows):
    df = spark.sql("""SELECT named_struct('b', named_struct('c', 1)) AS a, '{"x": {"y": "z"}}' AS j, 'bad' AS k""")
    picks = [path_or_null(df.schema, p) for p in ("a.b.c", "a.z", "q")]
    assert rows(df, *picks, json_path("j", "x.y"), json_path("j", "x.q"), json_path("k", "x")) == [
        (1, None, None, "z", None, None)
    ]
