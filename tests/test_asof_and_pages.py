import random
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.operators.asof import asof_join
from isobar.sources.pages import Pages

T0 = datetime(2024, 1, 1)


def at(m):
    return None if m is None else T0 + timedelta(minutes=m)


def frames(spark, seed=1, n=400):
    pick = random.Random(seed)
    left = [(pick.choice(["a", "a", "a", "b", None, "only left"]), pick.randrange(3000), i) for i in range(n)] + [("a", None, -1)]
    right = list({(pick.choice(["a", "a", "b", None, "only right"]), pick.randrange(3000)) for _ in range(n)})
    right = [(p, m, float(i)) for i, (p, m) in enumerate(right)] + [("a", None, 9.0)]
    lf = spark.createDataFrame([(p, at(m), i, "x") for p, m, i in left], "p STRING, ts TIMESTAMP, i INT, `odd name` STRING")
    rf = spark.createDataFrame([(p, at(m), v) for p, m, v in right], "p STRING, ts TIMESTAMP, v DOUBLE")
    return left, right, lf, rf


def plain(left, right, direction, tolerance):
    out = {}
    for p, m, i in left:
        times = sorted((rm, v) for rp, rm, v in right if rp == p and rm is not None)
        only = [t for t, _ in times]
        best = None
        if m is not None:
            before = times[bisect_right(only, m) - 1] if bisect_right(only, m) else None
            after = times[bisect_left(only, m)] if bisect_left(only, m) < len(times) else None
            options = {"backward": [before], "forward": [after], "nearest": [before, after]}[direction]
            best = min((o for o in options if o and abs(o[0] - m) <= tolerance), key=lambda o: abs(o[0] - m), default=None)
        out[i] = (at(best[0]), best[1]) if best else (None, None)
    return out


@pytest.mark.parametrize("target_rows", [1_000_000, 40])
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, "30 minutes"])
def test_nearest_readings(spark, direction, tolerance, target_rows):
    left, right, lf, rf = frames(spark)
    got = asof_join(lf, rf, ["p"], ["v"], direction=direction, tolerance=tolerance, target_rows=target_rows)
    found = {r["i"]: (r["ts_of_reading"], r["v"]) for r in got.collect()}
    assert found == plain(left, right, direction, 30 if tolerance else 10**9)
    assert got.columns == ["p", "ts", "i", "odd name", "ts_of_reading", "v"] and got.count() == len(left)


def test_guards_and_empty_sides(spark):
    _, _, lf, rf = frames(spark, n=10)
    with pytest.raises(ValueError):
        asof_join(lf, rf, ["p"], ["v"], direction="sideways")
    assert asof_join(lf, rf.limit(0), ["p"], ["v"]).filter("v IS NOT NULL").count() == 0
    assert asof_join(lf.limit(0), rf, ["p"], ["v"]).count() == 0


def test_pages_equal_the_order_and_read_each_file_about_once(spark, tmp_path):
    ids = [f"{random.Random(3).random():.6f}-{i * 7919 % 1000:03}" for i in range(1000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "_id STRING, n INT").repartition(7)
    Pages.write(df, f"{tmp_path}/p", rows_per_file=130)
    pages = Pages(spark, f"{tmp_path}/p", 90)
    assert len(pages) == 12 and pages.rows == 1000
    walked, files = [], []
    for page in pages.walk():
        walked += [r["_id"] for r in page.collect()]
        files += page.inputFiles()
    assert walked == sorted(ids)
    assert len(set(files)) == 8 and len(files) <= len(set(files)) + len(pages)
    last, keyed, reads = None, [], []
    while True:
        page = pages.after(last)
        rows = page.collect()
        if not rows:
            break
        keyed += [r["_id"] for r in rows]
        reads.append(len(page.inputFiles()))
        last = rows[-1]["_id"]
    assert keyed == sorted(ids) and max(reads) <= 3
    assert pages.after(sorted(ids)[500] + "x").first()["_id"] == sorted(ids)[501]
    assert pages.page(99).count() == 0 and pages.after("z").count() == 0


def test_pages_with_repeated_and_missing_keys(spark, tmp_path):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 1), (None, 2), ("b", 3)], "_id STRING, n INT")
    Pages.write(df, f"{tmp_path}/p", rows_per_file=20)
    pages = Pages(spark, f"{tmp_path}/p", 16)
    got = [tuple(r) for page in pages.walk() for r in page.collect()]
    assert sorted(got, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)
    assert [k for k, _ in got] == [None] * 2 + ["a"] * 50 + ["b"]
    assert [tuple(r) for r in pages.after("a").collect()] == [("b", 3)]


def test_no_pages(spark, tmp_path):
    Pages.write(spark.createDataFrame([], "_id STRING, n INT"), f"{tmp_path}/p")
    pages = Pages(spark, f"{tmp_path}/p", 10)
    assert len(pages) == 0 and pages.page(0).count() == 0 and pages.after(None).count() == 0
    assert pages.page(0).columns == ["_id", "n"] and pages.page(0).withColumn("x", F.lit(1)).count() == 0
