"""Hourly means, means over providers, and the unit switch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.times import hour_of
from isobar.operators.project import numeric_columns
from isobar.schemas import PLACE_COLUMNS

KELVIN_ZERO = 273.15


def group_means(
    df: DataFrame, keys: Sequence[str | Column], values: Sequence[str] | None = None, prefix: str = ""
) -> DataFrame:
    """Mean of every numeric column that is not a key. Partial sums keep hot groups harmless."""
    if values is None:
        values = numeric_columns(df, [k for k in keys if isinstance(k, str)])
    return df.groupBy(*keys).agg(*[F.avg(F.col(v)).alias(f"{prefix}{v}") for v in values])


def hourly_means(
    df: DataFrame,
    ts: str = "timestamp",
    keys: Sequence[str] = PLACE_COLUMNS,
    values: Sequence[str] | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Mean per key and full hour; the hour replaces the reading time.

    `counted` names a value whose number of readings is added as `n_readings`.
    """
    if values is None:
        values = numeric_columns(df, [*keys, ts])
    counts = [F.count(counted).alias("n_readings")] if counted else []
    return (
        df.groupBy(*keys, hour_of(ts).alias("_hour"))
        .agg(*[F.avg(v).alias(v) for v in values], *counts)
        .withColumnRenamed("_hour", ts)
    )


def common_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Names all frames have, in the order of the first."""
    shared = set(frames[0].columns).intersection(*[set(f.columns) for f in frames[1:]])
    return [name for name in frames[0].columns if name in shared]


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    names = common_columns(frames)
    return reduce(DataFrame.unionByName, [f.select(*names) for f in frames])


def union_all(frames: Sequence[DataFrame], fill: bool = False) -> DataFrame:
    """Union by name over locations, years or sources; Spark flattens the chain."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def mean_over_frames(
    frames: Sequence[DataFrame],
    keys: Sequence[str] = ("district", "latitude", "longitude"),
    single: bool = False,
) -> DataFrame:
    """Unweighted mean over the frames of every column they share, as `avg_<column>`.

    Two frames at least, unless `single` lets one pass through.
    """
    if not frames or (len(frames) < 2 and not single):
        raise ValueError("at least two frames are needed")
    names = common_columns(frames)
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"key columns {missing} are not common to all frames")
    together = union_common(frames)
    return group_means(together, list(keys), numeric_columns(together, keys), prefix="avg_")


def mean_of_means(
    df: DataFrame,
    provider: str,
    keys: Sequence[str | Column],
    values: Sequence[str],
) -> DataFrame:
    """The same over one frame that names its provider: one scan, provider means, then their mean."""
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(keys)]
    inner = [F.col(k) if isinstance(k, str) else k.alias(n) for k, n in zip(keys, names)]
    per_provider = df.groupBy(*inner, provider).agg(*[F.avg(v).alias(v) for v in values])
    return group_means(per_provider, names, values, prefix="avg_")


def kelvin_to_celsius(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value) - F.lit(KELVIN_ZERO)


def _shift(mean: Column) -> Column:
    return F.when(mean > KELVIN_ZERO, F.lit(KELVIN_ZERO)).otherwise(F.lit(0.0))


def fix_kelvin(
    df: DataFrame, columns: Sequence[str] = ("temperature_c", "feels_like_c"), parity: bool = False
) -> DataFrame:
    """Celsius columns of one provider's frame, whose mean of the first column tells the unit.

    With `parity` only the first column is converted. The mean is a scalar subquery over one column:
    no shuffle of the rows and no trip to the driver.
    """
    first = columns[0]
    mean = df.agg(F.avg(first)).scalar()
    targets = [c for c in ([first] if parity else columns) if c in df.columns]
    return df.withColumns({c: F.col(c) - _shift(mean) for c in targets})


def fix_kelvin_by_provider(
    df: DataFrame,
    provider: str,
    providers: Sequence[str],
    columns: Sequence[str] = ("temperature_c", "feels_like_c"),
    parity: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """`fix_kelvin` on a frame that holds several declared providers.

    All means come from one pass as one row, as wide as the declared list, so nothing is shuffled on
    the provider, of which one may hold most rows. A row of an undeclared provider fails the job, as
    its unit would be unknown. On rows that are means already, `weight` names
    the column with the number of readings behind each mean of the first column.
    """
    first = columns[0]
    entries: list[Column] = []
    for name in providers:
        own = F.col(provider) == name
        if weight is None:
            mean = F.avg(F.when(own, F.col(first)))
        else:
            total = F.sum(F.when(own, F.col(first) * F.col(weight)))
            mean = F.try_divide(total, F.sum(F.when(own & F.col(first).isNotNull(), F.col(weight))))
        entries += [F.lit(name), mean]
    means = df.agg(F.create_map(*entries)).scalar()
    unknown = F.raise_error(F.concat(F.lit("undeclared provider "), F.coalesce(F.col(provider), F.lit("null"))))
    known = F.col(provider).isin(list(providers))
    shift = F.when(known, _shift(F.try_element_at(means, F.col(provider)))).otherwise(unknown.cast("double"))
    targets = [c for c in ([first] if parity else columns) if c in df.columns]
    return df.withColumns({c: F.col(c) - shift for c in targets})


def fix_kelvin_by_day(
    df: DataFrame,
    provider: str,
    day: str,
    weight: str,
    columns: Sequence[str] = ("temperature_c", "feels_like_c"),
) -> DataFrame:
    """`fix_kelvin` on hourly means, the unit told by the mean of each provider's stored day.

    So the unit of an hour does not depend on which other days are at hand.
    """
    first = columns[0]
    told = F.when(F.col(first).isNotNull(), F.col(weight))
    mean = F.try_divide(F.sum(F.col(first) * F.col(weight)), F.sum(told))
    days = df.groupBy(F.col(provider).alias("_p"), F.col(day).alias("_d")).agg(_shift(mean).alias("_shift"))
    same = F.col(provider).eqNullSafe(F.col("_p")) & F.col(day).eqNullSafe(F.col("_d"))
    shifted = df.join(days, same, "left")
    return shifted.withColumns({c: F.col(c) - F.col("_shift") for c in columns if c in df.columns}).drop("_p", "_d", "_shift")


def scale_units(df: DataFrame, factors: Mapping[str, float], where: Column | None = None) -> DataFrame:
    """Optional unit factors per column, such as m/s to km/h for one provider."""
    scaled = {c: F.col(c) * f for c, f in factors.items() if c in df.columns}
    if where is not None:
        scaled = {c: F.when(where, x).otherwise(F.col(c)) for c, x in scaled.items()}
    return df.withColumns(scaled)


def round_coordinates(df: DataFrame, places: int) -> DataFrame:
    """Lets providers whose coordinates differ slightly meet in one group."""
    return df.withColumns({c: F.round(c, places) for c in ("latitude", "longitude")})
