"""Document tables as CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from isobar.operators.reshape import flatten_by_path
from isobar.schemas import FREE_WEATHER_EXPORT
from isobar.sources.documents import export_mapped, scan_all, sorted_columns
from isobar.sources.files import write_csv


def dataset(documents: DataFrame, items: Mapping[str, int] | None = None) -> DataFrame:
    """Path-flattened documents with sorted columns, wide enough for the longest of each list."""
    return sorted_columns(flatten_by_path(scan_all(documents), items=items))


def write_dataset(documents: DataFrame, folder: str) -> None:
    write_csv(dataset(documents), folder)


def mapped_dataset(
    documents: DataFrame, fields: Mapping[str, str | Column] = FREE_WEATHER_EXPORT
) -> DataFrame:
    return export_mapped(scan_all(documents), fields)


def write_mapped(documents: DataFrame, folder: str, fields=FREE_WEATHER_EXPORT) -> None:
    write_csv(mapped_dataset(documents, fields), folder)
