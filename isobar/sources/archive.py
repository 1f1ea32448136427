"""Archive payloads: parallel hourly arrays to rows, descriptors, file names and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.schemas import ARCHIVE_FEATURES, archive_payload
from isobar.sources.messages import parse_json


def parse_payloads(texts: DataFrame, text: str = "value", features=ARCHIVE_FEATURES) -> DataFrame:
    """JSON payload texts with their struct in `payload`; a district column stays beside it."""
    return texts.withColumn("payload", parse_json(F.col(text), archive_payload(features)))


def read_payloads(spark: SparkSession, path: str, features=ARCHIVE_FEATURES) -> DataFrame:
    """One JSON payload per file line, many files in one scan."""
    return parse_payloads(spark.read.text(path), "value", features)


def _is_whole(parsed: DataFrame) -> Column:
    """Well-formed JSON with a place and its hours."""
    present = F.col("payload.latitude").isNotNull() & F.col("payload.hourly.time").isNotNull()
    return F.coalesce(F.col("payload._corrupt_record").isNull() & present, F.lit(False))


def whole_payloads(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_is_whole(parsed))


def rejected_payloads(parsed: DataFrame) -> DataFrame:
    """What `whole_payloads` leaves out, without the parsed struct, for the quarantine."""
    return parsed.filter(~_is_whole(parsed)).drop("payload")


def hourly_rows(
    payloads: DataFrame,
    features: Sequence[str] = ARCHIVE_FEATURES,
    keep: Sequence[str | Column] = (),
    time_name: str = "time",
) -> DataFrame:
    """One row per hour of every payload. Payloads that did not parse have no rows here."""
    arrays = [F.col("payload.hourly.time").alias(time_name)]
    arrays += [F.col(f"payload.hourly.{name}").alias(name) for name in features]
    return payloads.select(*keep, F.inline(F.arrays_zip(*arrays)))


def payload_parts(
    payloads: DataFrame, features: Sequence[str] = ARCHIVE_FEATURES, time_name: str = "time"
) -> DataFrame:
    """Hourly rows that also carry the payload's own scalars (the merged form)."""
    scalars = [
        F.col("payload.latitude").alias("lat"),
        F.col("payload.longitude").alias("lon"),
        F.col("payload.utc_offset_seconds"),
        F.col("payload.timezone"),
        F.col("payload.timezone_abbreviation"),
    ]
    return hourly_rows(payloads, features, scalars, time_name)


def descriptors(payloads: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """One row of scalars per payload."""
    return payloads.filter(F.col("payload.latitude").isNotNull()).select(
        *keep,
        F.col("payload.latitude"),
        F.col("payload.longitude"),
        F.col("payload.utc_offset_seconds"),
        F.col("payload.timezone"),
        F.col("payload.timezone_abbreviation"),
    )


def location_name(latitude: Column, longitude: Column) -> Column:
    """`<lat>_<lon>` with dots as underscores."""
    dots = [F.replace(c.cast("string"), F.lit("."), F.lit("_")) for c in (latitude, longitude)]
    return F.concat_ws("_", *dots)


def archive_name(latitude: Column, longitude: Column, kind: str, stamp: Column) -> Column:
    """`<lat>_<lon>_<kind>_<stamp>.csv`, the stamp with dots, blanks and colons as underscores."""
    clean = F.regexp_replace(stamp.cast("string"), "[ .:]", "_")
    return F.concat(location_name(latitude, longitude), F.lit(f"_{kind}_"), clean, F.lit(".csv"))


def manifest(descriptor_rows: DataFrame, stamp: Column) -> DataFrame:
    """File names of each location: its descriptor and its data."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return descriptor_rows.select(
        lat,
        lon,
        archive_name(lat, lon, "descriptor", stamp).alias("descriptor_file_name"),
        archive_name(lat, lon, "data", stamp).alias("data_file_name"),
    ).distinct()


def newest_file(manifest_rows: DataFrame) -> DataFrame:
    """The manifest row that sorts last by data file name."""
    return manifest_rows.orderBy(F.desc("data_file_name")).limit(1)
