"""Registration of queries, and the given tables as observations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# `k` of the payload text, in the SQL of the queries.
SQL_K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations: event type as provider, user as place, value as reading; `ts` as an instant."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def payload_k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def gapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with gaps: errors carry no reading and views no payload."""
    return events(spark, sf_dir).withColumns(
        {
            "value": F.when(F.col("event_type") != "error", F.col("value")),
            "props": F.when(F.col("event_type") != "view", F.col("props")),
        }
    )


SQL_GAPPED = """(SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_type <> 'error' THEN value END AS value,
    CASE WHEN event_type <> 'view' THEN props END AS props FROM events)"""


def ntz(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def r8(column: Column | str) -> Column:
    """For means of few values, which may end on a five at the seventh place."""
    return F.round(F.col(column) if isinstance(column, str) else column, 8)
