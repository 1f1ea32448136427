"""Null profiles, summaries, gap filling, z-scores, row positions and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from isobar.operators import ordered, quality, sketches
from isobar.operators.project import cast_column, without_rows
from isobar.operators.forecast import context_rows
from isobar.plans.quality import null_report, null_spans
from isobar.queries.registry import SQL_GAPPED, events, gapped_events, query, r6, table
from isobar.session import shared_folder

_GAPPED = ("event_id", "value", "props")


@query(
    "null_profile",
    f"""SELECT count(*) - count(event_id) AS event_id, count(*) - count(value) AS value,
        count(*) - count(props) AS props FROM {SQL_GAPPED}""",
)
def null_profile(spark, sf):
    return quality.null_counts(gapped_events(spark, sf), _GAPPED)


@query(
    "null_pct",
    f"""SELECT round(100.0 * (count(*) - count(event_id)) / count(*), 6) AS event_id,
        round(100.0 * (count(*) - count(value)) / count(*), 6) AS value,
        round(100.0 * (count(*) - count(props)) / count(*), 6) AS props FROM {SQL_GAPPED}""",
)
def null_pct(spark, sf):
    shares = quality.null_shares(gapped_events(spark, sf), _GAPPED)
    return shares.select(*[r6(c).alias(c) for c in _GAPPED])


_SQL_POSITIONS = f"""(SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM {SQL_GAPPED})"""


@query(
    "null_row_index",
    f"""SELECT 'value' AS column_name, row_index FROM {_SQL_POSITIONS} WHERE value IS NULL
    UNION ALL SELECT 'props', row_index FROM {_SQL_POSITIONS} WHERE props IS NULL""",
)
def null_row_index(spark, sf):
    return quality.null_row_indices(gapped_events(spark, sf), ["value", "props"], "ts", ["event_id"])


@query(
    "row_index",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events",
)
def row_index(spark, sf):
    return ordered.with_row_index(events(spark, sf), "ts", ["event_id"]).select("event_id", "row_index")


@query(
    "row_index_per_series",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS row_index
    FROM events""",
)
def row_index_per_series(spark, sf):
    indexed = ordered.with_row_index(events(spark, sf), "ts", ["event_id"], ["user_id"])
    return indexed.select("event_id", "row_index")


@query(
    "null_filter",
    f"""SELECT event_id, 'value' AS column_name FROM {SQL_GAPPED} WHERE value IS NULL
    UNION ALL SELECT event_id, 'props' FROM {SQL_GAPPED} WHERE props IS NULL""",
)
def null_filter(spark, sf):
    return quality.rows_with_null(gapped_events(spark, sf), _GAPPED, ["event_id"])


@query(
    "complete_rows",
    f"SELECT event_id, value FROM {SQL_GAPPED} WHERE value IS NOT NULL AND props IS NOT NULL",
)
def complete_rows(spark, sf):
    return quality.complete_rows(gapped_events(spark, sf)).select("event_id", "value")


@query(
    "quality_report",
    f"""SELECT 'value' AS column_name, count(*) AS n_rows, count(*) - count(value) AS n_null,
        round(100.0 * (count(*) - count(value)) / count(*), 6) AS pct_null FROM {SQL_GAPPED}
    UNION ALL SELECT 'props', count(*), count(*) - count(props),
        round(100.0 * (count(*) - count(props)) / count(*), 6) FROM {SQL_GAPPED}""",
)
def quality_report(spark, sf):
    report = null_report(gapped_events(spark, sf), ["value", "props"])
    return report.withColumn("pct_null", r6("pct_null"))


@query(
    "null_spans",
    f"""SELECT 'value' AS column_name, count(*) AS n_null, min(row_index) AS first_index,
        max(row_index) AS last_index FROM {_SQL_POSITIONS} WHERE value IS NULL
    UNION ALL SELECT 'props', count(*), min(row_index), max(row_index) FROM {_SQL_POSITIONS}
        WHERE props IS NULL""",
)
def null_span_report(spark, sf):
    return null_spans(gapped_events(spark, sf), ["value", "props"], "ts", ["event_id"])


@query(
    "schema_facts",
    """SELECT 'doc_id' AS column_name, 'bigint' AS column_type, count(*) AS n_rows, count(doc_id) AS n_values
        FROM documents
    UNION ALL SELECT 'lang', 'string', count(*), count(lang) FROM documents
    UNION ALL SELECT 'text', 'string', count(*), count(text) FROM documents
    UNION ALL SELECT 'source', 'string', count(*), count(source) FROM documents
    UNION ALL SELECT 'n_chars', 'bigint', count(*), count(n_chars) FROM documents""",
)
def schema_facts(spark, sf):
    return quality.schema_facts(table(spark, sf, "documents"))


def _sql_describe(column, source):
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 6) AS mean,
        round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS q1,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS median,
        round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS q3,
        CAST(max({column}) AS DOUBLE) AS max FROM {source}"""


@query(
    "describe_numeric",
    _sql_describe("l_quantity", "lineitem")
    + " UNION ALL "
    + _sql_describe("l_extendedprice", "lineitem")
    + " UNION ALL "
    + _sql_describe("l_discount", "lineitem"),
)
def describe_numeric(spark, sf):
    out = quality.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({c: r6(c) for c in ("mean", "std", "q1", "median", "q3")})


@query(
    "bfill_one",
    f"""SELECT event_id, coalesce(value, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS value
    FROM {SQL_GAPPED}""",
)
def bfill_one(spark, sf):
    filled = quality.backfill_one(gapped_events(spark, sf), "value", ["user_id"], "ts", ["event_id"])
    return filled.select("event_id", "value")


@query(
    "bfill_one_whole_table",
    f"""SELECT event_id, coalesce(value, lead(value) OVER (ORDER BY ts, event_id)) AS value FROM {SQL_GAPPED}""",
)
def bfill_one_whole_table(spark, sf):
    filled = quality.backfill_one(gapped_events(spark, sf), "value", [], "ts", ["event_id"])
    return filled.select("event_id", "value")


@query(
    "zscore",
    """SELECT event_id, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) AS z
    FROM events WINDOW w AS (PARTITION BY event_type)""",
)
def zscore(spark, sf):
    return quality.zscore(events(spark, sf), "value", ["event_type"]).select("event_id", r6("z").alias("z"))


@query(
    "zscore_whole_table",
    "SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS z FROM events",
)
def zscore_whole_table(spark, sf):
    return quality.zscore(events(spark, sf), "value").select("event_id", r6("z").alias("z"))


@query("zscore_inverse", "SELECT event_id, round(value, 6) AS value FROM events")
def zscore_inverse(spark, sf):
    scored = quality.zscore(events(spark, sf), "value", ["user_id"]).drop("value")
    return quality.zscore_inverse(scored).select("event_id", r6("value").alias("value"))


_SQL_RANKED = """(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newest,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS oldest FROM events)"""
_ORDER = ["ts", "event_id"]


@query("series_tail", f"SELECT user_id, event_id, value FROM {_SQL_RANKED} WHERE newest <= 8")
def series_tail(spark, sf):
    return ordered.newest(events(spark, sf), 8, ["user_id"], _ORDER).select("user_id", "event_id", "value")


@query("train_test_split", f"SELECT event_id, newest <= 24 AS is_test FROM {_SQL_RANKED}")
def train_test_split(spark, sf):
    return ordered.split_newest(events(spark, sf), 24, ["user_id"], _ORDER).select("event_id", "is_test")


@query("skip_head", f"SELECT user_id, event_id FROM {_SQL_RANKED} WHERE oldest > 15")
def skip_head(spark, sf):
    return ordered.skip_oldest(events(spark, sf), 15, ["user_id"], _ORDER).select("user_id", "event_id")


@query("drop_tail", f"SELECT user_id, event_id FROM {_SQL_RANKED} WHERE newest > 24")
def drop_tail(spark, sf):
    return ordered.drop_newest(events(spark, sf), 24, ["user_id"], _ORDER).select("user_id", "event_id")


@query("context_window", f"SELECT user_id, event_id, newest <= 24 AS is_test FROM {_SQL_RANKED} WHERE newest <= 34")
def context_window(spark, sf):
    rows = events(spark, sf).withColumn("ds", F.struct(*_ORDER))
    marked = ordered.split_newest(rows, 24, ["user_id"], ["ds"])
    return context_rows(marked, 10, ["user_id"]).select("user_id", "event_id", "is_test")


@query(
    "reject_list",
    """SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (
        SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY ALL""",
)
def reject_list(spark, sf):
    rejects = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept = without_rows(table(spark, sf, "lineitem"), rejects, ["l_orderkey"])
    return kept.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cast_text",
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority,
        TRY_CAST(o_orderstatus AS DOUBLE) AS status FROM orders""",
)
def cast_text(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    return cast_column(cast_column(rows, "priority", "double"), "status", "double")


_SQL_FACTS = f"""SELECT CAST(ts AS DATE) AS day, 'value' AS column_name, value AS x FROM {SQL_GAPPED}
    UNION ALL SELECT CAST(ts AS DATE), 'user_id', CAST(user_id AS DOUBLE) FROM {SQL_GAPPED}"""


def _kept_days(spark, sf):
    """The facts of every day, made in two goes as if the second half had come later."""
    rows, folder = gapped_events(spark, sf), shared_folder(spark, "facts")
    day = F.to_date("ts")
    days = sorted(r[0] for r in rows.select(day).distinct().collect())
    for part in (days[: len(days) // 2], days[len(days) // 2 :]):
        sketches.keep_facts(rows, day, folder, part, ["value", "user_id"])
    return sketches.kept_facts(spark, folder)


@query(
    "daily_facts",
    f"""SELECT day, column_name, count(*) AS n_rows, count(x) AS n_values, round(avg(x), 6) AS mean, min(x) AS min, max(x) AS max
    FROM ({_SQL_FACTS}) GROUP BY day, column_name""",
)
def daily_facts(spark, sf):
    """Facts kept per day and column; a later day leaves the others as they are."""
    kept = _kept_days(spark, sf)
    return kept.select("day", "column_name", "n_rows", "n_values", r6("mean").alias("mean"), "min", "max")


@query(
    "profile_of_span",
    f"""SELECT day >= DATE '2024-01-15' AS late, column_name, count(*) AS n_rows, count(x) AS n_values,
        round(100.0 * (count(*) - count(x)) / count(*), 6) AS pct_null, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
        min(x) AS min, max(x) AS max, TRUE AS close_median, TRUE AS close_distinct FROM ({_SQL_FACTS}) GROUP BY ALL""",
)
def profile_of_span(spark, sf):
    """Profiles of two spans merged from kept days; the estimates are held against the rows."""
    late = F.col("day") >= F.lit("2024-01-15").cast("date")
    merged = sketches.merged_profile(_kept_days(spark, sf).withColumn("late", late), (0.5,), ["late"])
    rows = gapped_events(spark, sf).withColumn("day", F.to_date("ts"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in ("value", "user_id")])
    each = rows.select(late.alias("late"), F.inline(pairs))
    bounds = merged.select("late", "column_name", F.col("q")[0].alias("median"), "n_distinct")
    # Two spans of two columns.
    held = each.join(F.broadcast(bounds), ["late", "column_name"]).groupBy("late", "column_name")
    held = held.agg(
        F.count_if(F.col("x") < F.col("median")).alias("below"),
        F.count_if(F.col("x") <= F.col("median")).alias("upto"),
        F.count("x").alias("n"),
        F.count_distinct("x").alias("distinct"),
    )
    near = (F.col("below") <= (0.5 + sketches.RANK_ERROR) * F.col("n")) & (F.col("upto") >= (0.5 - sketches.RANK_ERROR) * F.col("n"))
    same = F.abs(F.col("n_distinct") / F.col("distinct") - 1) < sketches.DISTINCT_ERROR
    out = merged.join(F.broadcast(held), ["late", "column_name"])
    return out.select(
        "late", "column_name", "n_rows", "n_values", r6("pct_null").alias("pct_null"), r6("mean").alias("mean"), r6("std").alias("std"),
        "min", "max", near.alias("close_median"), same.alias("close_distinct"),
    )
