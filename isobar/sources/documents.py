"""Document tables: scans, finds and flattened or field-mapped exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.paths import path_or_null
from isobar.functions.times import as_column


def read_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON-lines documents; declared schema when given, else inferred."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def scan_all(documents: DataFrame, key: str = "_id") -> DataFrame:
    """Every document but the design documents."""
    return documents.filter(~F.col(key).startswith("_design/"))


def page_after(documents: DataFrame, last: str | None, size: int, key: str = "_id") -> DataFrame:
    """The next `size` documents by key. Full scans should use `scan_all`, which has no order."""
    rest = documents if last is None else documents.filter(F.col(key) > last)
    return scan_all(rest, key).orderBy(key).limit(size)


def find(
    documents: DataFrame,
    selector: Column | None = None,
    fields: Sequence[str] | None = None,
    sort: Sequence[Column] | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """Selector, projection, sort and limit. Sort and limit together stay a per-task top-k.

    A find gives 100 documents unless another limit is asked for; None gives all.
    """
    out = documents if selector is None else documents.filter(selector)
    if sort:
        out = out.orderBy(*sort)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*fields) if fields else out


def since(documents: DataFrame, ts: str, as_of: Column, lookback: str = "2 hours") -> DataFrame:
    """Documents no older than the look-back; compares real timestamps."""
    return documents.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {lookback}"))


def until_hour(documents: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Documents up to the full hour at or before `as_of`."""
    return documents.filter(F.col(ts) <= F.date_trunc("hour", as_of))


def export_mapped(documents: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """One column per header, from a dotted path or an expression; absent paths are null."""
    schema = documents.schema
    return documents.select(
        *[
            (path_or_null(schema, source) if isinstance(source, str) else as_column(source)).alias(
                header
            )
            for header, source in fields.items()
        ]
    )


def sorted_columns(flat: DataFrame) -> DataFrame:
    """Columns in the alphabetical order of a CSV header."""
    return flat.select(*[F.col(f"`{name}`") for name in sorted(flat.columns)])


def align_to_header(flat: DataFrame, header: Sequence[str]) -> DataFrame:
    """Exactly the header's columns: extras dropped, gaps null."""
    present = set(flat.columns)
    return flat.select(
        *[
            F.col(f"`{name}`") if name in present else F.lit(None).cast("string").alias(name)
            for name in header
        ]
    )
