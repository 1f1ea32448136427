"""Projections: canonical names, constants, defaults, casts and renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.ids import concat_id
from isobar.functions.times import iso_text
from isobar.schemas import (
    CANONICAL_NAMES,
    DEFAULT_LOCATION,
    LATEST_PROJECTION,
    WEATHER_DATA_DEFAULTS,
    WEATHER_SUMMARY_SOURCES,
)


def standardize_names(
    df: DataFrame, names: Mapping[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Mapped columns under their canonical names, in input order; others go unless kept."""
    names = CANONICAL_NAMES if names is None else names
    return df.select(
        *[
            F.col(f"`{c}`").alias(names.get(c, c) if c not in keep else c)
            for c in df.columns
            if c in names or c in keep
        ]
    )


def with_location(df: DataFrame, source: str = "name", default: str = DEFAULT_LOCATION) -> DataFrame:
    """`location_name` from the source column where there is one, else the default."""
    if source in df.columns:
        return df.withColumnRenamed(source, "location_name")
    return df.withColumn("location_name", F.lit(default))


def with_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_metadata(df: DataFrame, *parts: str, as_of: Column | None = None) -> DataFrame:
    """Adds `_id`, a hash of the parts, and `last_updated`."""
    updated = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({"_id": concat_id(*parts), "last_updated": iso_text(updated)})


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drops the names that exist; the others are no error."""
    return df.drop(*names)


def strip_prefix(df: DataFrame, prefix: str = "avg_") -> DataFrame:
    return df.toDF(*[name.removeprefix(prefix) for name in df.columns])


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[F.col(f"`{n}`") for n in names if n in df.columns])


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def without_rows(df: DataFrame, rejects: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not on the reject list."""
    return df.join(rejects.select(*keys).distinct(), list(keys), "left_anti")


def cast_column(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Text that does not read as the type becomes null."""
    return df.withColumn(column, F.col(column).try_cast(kind))


def _or_default(df: DataFrame, name: str, kind: str, default) -> Column:
    present = F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)
    return F.coalesce(present, F.lit(default).cast(kind))


def weather_data_rows(flat: DataFrame, timestamp: Column) -> DataFrame:
    """Flat free-weather readings as serving rows: every column set, defaults for gaps."""
    columns = [_or_default(flat, n, k, d).alias(n) for n, (k, d) in WEATHER_DATA_DEFAULTS.items()]
    return flat.select(*columns[:6], timestamp.alias("timestamp"), *columns[6:])


def weather_summary_rows(flat: DataFrame, timestamp: Column) -> DataFrame:
    """Flat free-weather readings as summary rows (the single-provider mode)."""
    columns = [
        _or_default(flat, source, kind, default).alias(name)
        for name, (source, kind, default) in WEATHER_SUMMARY_SOURCES.items()
    ]
    return flat.select(*columns[:3], timestamp.alias("timestamp"), *columns[3:])


def summary_from_aggregate(aggregate: DataFrame) -> DataFrame:
    """Cross-provider hourly means as summary rows."""
    plain = strip_prefix(aggregate)
    columns = [
        _or_default(plain, name, kind, default).alias(name)
        for name, (_, kind, default) in WEATHER_SUMMARY_SOURCES.items()
    ]
    return plain.select(*columns[:3], "timestamp", *columns[3:])


def latest_projection(rows: DataFrame, grain: str, keep: Sequence[str] = ()) -> DataFrame:
    """Current-conditions columns of a serving table under the dashboard's names."""
    return rows.select(
        *keep, *[F.col(c).alias(name) for c, name in LATEST_PROJECTION[grain].items()]
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
