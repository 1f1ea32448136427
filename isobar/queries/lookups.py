"""Nearest readings in time, and pages by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators.asof import asof_join
from isobar.queries.registry import SQL_K, events, ntz, payload_k, query
from isobar.session import shared_folder
from isobar.sources.pages import Pages

_SQL_SIDES = f"""WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type IN ('click', 'view')),
    r AS (SELECT user_id, date_trunc('minute', ts) AS ts, max({SQL_K}) AS k FROM events
        WHERE event_type IN ('purchase', 'error') GROUP BY ALL)"""


def _sides(spark, sf):
    rows = events(spark, sf)
    left = rows.filter("event_type IN ('click', 'view')").select("event_id", "user_id", "ts")
    right = rows.filter("event_type IN ('purchase', 'error')").groupBy("user_id", F.date_trunc("minute", "ts").alias("ts"))
    return left, right.agg(F.max(payload_k()).alias("k"))


def _sql_asof(test: str) -> str:
    return f"SELECT l.*, r.ts AS ts_of_reading, k FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts {test} r.ts"


def _joined(spark, sf, direction, tolerance=None):
    left, right = _sides(spark, sf)
    found = asof_join(left, right, ["user_id"], ["k"], direction=direction, tolerance=tolerance)
    return found.withColumns({c: ntz(c) for c in ("ts", "ts_of_reading")})


@query("asof_backward", f"{_SQL_SIDES} {_sql_asof('>=')}")
def asof_backward(spark, sf):
    """Each reading with the last one of another provider at its place, at or before it."""
    return _joined(spark, sf, "backward")


@query("asof_forward", f"{_SQL_SIDES} {_sql_asof('<=')}")
def asof_forward(spark, sf):
    return _joined(spark, sf, "forward")


@query(
    "nearest_reading",
    f"""{_SQL_SIDES}, b AS ({_sql_asof('>=')}), f AS ({_sql_asof('<=')}),
    c AS (SELECT event_id, b.user_id, b.ts, b.ts_of_reading AS before, b.k AS bk, f.ts_of_reading AS after, f.k AS fk,
        after IS NOT NULL AND (before IS NULL OR epoch_us(after) - epoch_us(b.ts) < epoch_us(b.ts) - epoch_us(before)) AS later
        FROM b JOIN f USING (event_id)),
    n AS (SELECT event_id, user_id, ts, CASE WHEN later THEN after ELSE before END AS t, CASE WHEN later THEN fk ELSE bk END AS k FROM c)
    SELECT event_id, user_id, ts, CASE WHEN abs(epoch_us(t) - epoch_us(ts)) <= 21600000000 THEN t END AS ts_of_reading,
        CASE WHEN abs(epoch_us(t) - epoch_us(ts)) <= 21600000000 THEN k END AS k FROM n""",
)
def nearest_reading(spark, sf):
    """Each reading with the nearest one in time, at most six hours away."""
    return _joined(spark, sf, "nearest", "6 hours")


_SQL_DOCUMENTS = "(SELECT md5(CAST(event_id AS VARCHAR)) AS _id, event_id FROM events)"


def _pages(spark, sf) -> Pages:
    """Events as documents in pages of a fifth of them, in files of a seventh."""
    rows = events(spark, sf).select(F.md5(F.col("event_id").cast("string")).alias("_id"), "event_id")
    n, folder = rows.count(), shared_folder(spark, "pages")
    Pages.write(rows, folder, rows_per_file=n // 7 + 1)
    return Pages(spark, folder, n // 5 + 1)


@query(
    "paged_walk",
    f"""SELECT (row_number() OVER (ORDER BY _id) - 1) // (SELECT count(*) // 5 + 1 FROM events) AS page, _id, event_id
    FROM {_SQL_DOCUMENTS}""",
)
def paged_walk(spark, sf):
    """All pages of a table by number; together they are the table."""
    pages = _pages(spark, sf)
    out = [page.withColumn("page", F.lit(k).cast("long")) for k, page in enumerate(pages.walk())]
    found = out[0]
    for page in out[1:]:
        found = found.unionByName(page)
    return found


@query(
    "page_after_key",
    f"SELECT _id, event_id FROM {_SQL_DOCUMENTS} WHERE _id > '7' ORDER BY _id LIMIT (SELECT count(*) // 5 + 1 FROM events)",
)
def page_after_key(spark, sf):
    return _pages(spark, sf).after("7")
