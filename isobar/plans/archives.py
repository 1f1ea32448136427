"""Historical loads, gap filling, and archives written as CSV with a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.aggregate import union_all
from isobar.operators.quality import distinct_rows
from isobar.schemas import ARCHIVE_FEATURES, DISTRICT_FEATURES
from isobar.session import shared_folder
from isobar.sources.archive import (
    descriptors,
    hourly_rows,
    location_name,
    manifest,
    parse_payloads,
    rejected_payloads,
    whole_payloads,
)
from isobar.sources.files import write_csv

DISTRICT_COLUMNS = ("district", "latitude", "longitude")


def district_history(
    payloads: DataFrame, features: Sequence[str] = DISTRICT_FEATURES, text: str = "value"
) -> DataFrame:
    """Hourly rows of every district and year.

    `payloads` holds the district, its coordinates and one payload text per row, so any number of
    districts and years is one scan.
    """
    return hourly_rows(parse_payloads(payloads, text, features), features, DISTRICT_COLUMNS)


def fill_gap(history: DataFrame, recent: DataFrame, ordered: bool = True) -> DataFrame:
    """History with the forecast feed's rows added; equal rows are kept once."""
    out = distinct_rows(union_all([history, recent]))
    return out.orderBy("district", "time") if ordered else out


def archive_tables(
    payloads: DataFrame, stamp: Column, features: Sequence[str] = ARCHIVE_FEATURES, text: str = "value"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Descriptor rows, data rows and the manifest of landed payloads."""
    return _tables(parse_payloads(payloads, text, features), stamp, features)


def _tables(parsed: DataFrame, stamp: Column, features: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    place = [F.col("payload.latitude").alias("latitude"), F.col("payload.longitude").alias("longitude")]
    described = descriptors(parsed)
    return described, hourly_rows(parsed, features, place, "datetime"), manifest(described, stamp)


def write_archive(
    payloads: DataFrame,
    folder: str,
    stamp: Column,
    features: Sequence[str] = ARCHIVE_FEATURES,
    text: str = "value",
    run: str = "first",
) -> None:
    """Manifest first, then the quarantine, descriptors and data as CSV, the data in one folder per location.

    The payloads are parsed once, into a staged table. All that a run writes is in partitions of its own,
    which running it again replaces, so a retry doubles nothing. Payloads that are no whole archive answer
    go to the quarantine as they came. When the manifest cannot be written, nothing else is. The rebalance
    brings the rows of a small location into one file and cuts those of a large one into several.
    """
    spark = payloads.sparkSession
    staged = shared_folder(spark, "payloads")
    parsed = parse_payloads(payloads, text, features)
    parsed.write.parquet(staged)
    parsed = spark.read.schema(parsed.schema).parquet(staged)
    described, data, names = _tables(whole_payloads(parsed), stamp, features)
    names.write.mode("overwrite").parquet(f"{folder}/manifest/run={run}")
    rejected_payloads(parsed).write.mode("overwrite").parquet(f"{folder}/quarantine/run={run}")
    write_csv(described, f"{folder}/descriptor/run={run}")
    placed = data.withColumn("location", location_name(F.col("latitude"), F.col("longitude")))
    write_csv(placed.hint("rebalance", "location"), f"{folder}/data/run={run}", ["location"])
