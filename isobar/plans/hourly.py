"""The hourly aggregate over all providers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.times import CREATED_FORM, parse_reading_time
from isobar.operators.aggregate import (
    fix_kelvin_by_provider,
    group_means,
    hourly_means,
    round_coordinates,
    scale_units,
    union_common,
)
from isobar.operators.project import numeric_columns, pick, standardize_names, with_location
from isobar.operators.reshape import flatten_by_leaf
from isobar.schemas import HOURLY_AGGREGATE, PLACE_COLUMNS
from isobar.session import shared_root
from isobar.sources.documents import find, since


def recent_documents(
    documents: DataFrame, as_of: Column, lookback: str = "2 hours", limit: int | None = None
) -> DataFrame:
    """Documents created within the look-back, the newest `limit` of them when one is given."""
    timed = documents.withColumn("_created", F.try_to_timestamp("created_at", F.lit(CREATED_FORM)))
    kept = since(timed, "_created", as_of, lookback)
    return find(kept, sort=[F.desc("_created")] if limit else None, limit=limit).drop("_created")


def provider_observations(
    documents: DataFrame, zone: str | None = None, parity: bool = False, places: int | None = None
) -> DataFrame:
    """One provider's documents as canonical observations with a real timestamp, in its own units.

    `places` rounds coordinates, so that providers which locate a city slightly differently meet.
    """
    canonical = standardize_names(flatten_by_leaf(documents), keep=() if parity else ("name",))
    located = with_location(canonical)
    if places is not None:
        located = round_coordinates(located, places)
    return located.withColumn("timestamp", parse_reading_time("date", zone)).drop("date")


def provider_hours(
    documents: Mapping[str, DataFrame],
    zone: str | None = None,
    parity: bool = False,
    places: int | None = None,
    factors: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """Hourly means of every provider in common units, over the measures all of them have.

    Whether a provider reports Kelvin is told by the mean over all its readings. That mean is taken
    from the hours and their counts, and the hours are kept as a checkpoint for it, so the documents
    are read once.
    """
    frames = [
        hourly_means(provider_observations(table, zone, parity, places), counted="temperature_c")
        .withColumn("provider", F.lit(topic))
        for topic, table in documents.items()
    ]
    together = union_common(frames)
    shared_root(together.sparkSession)
    hours = together.checkpoint()
    out = fix_kelvin_by_provider(hours, "provider", list(documents), parity=parity, weight="n_readings")
    for topic, own in (factors or {}).items():
        out = scale_units(out, own, F.col("provider") == topic)
    return out.drop("n_readings")


def hourly_aggregate(
    spark: SparkSession,
    documents: Mapping[str, DataFrame],
    as_of: Column | None = None,
    lookback: str = "2 hours",
    limit: int | None = None,
    zone: str | None = None,
    parity: bool = False,
    newest_first: bool = True,
    factors: Mapping[str, Mapping[str, float]] | None = None,
    places: int | None = None,
) -> DataFrame:
    """Mean over providers of their hourly means, newest hour first.

    `documents` and `factors` are keyed by topic. One provider passes through alone, except under
    `parity`; with none the result is empty but has its columns.
    """
    if not documents:
        return spark.createDataFrame([], HOURLY_AGGREGATE)
    if parity and len(documents) < 2:
        raise ValueError("at least two providers are needed")
    if as_of is not None:
        documents = {t: recent_documents(d, as_of, lookback, limit) for t, d in documents.items()}
    hours = provider_hours(documents, zone, parity, places, factors)
    keys = [*PLACE_COLUMNS, "timestamp"]
    means = group_means(hours, keys, numeric_columns(hours, keys), prefix="avg_")
    known = HOURLY_AGGREGATE.names
    out = pick(means, [*known, *[c for c in means.columns if c not in known]])
    return out.orderBy(F.desc("timestamp"), *PLACE_COLUMNS) if newest_first else out
