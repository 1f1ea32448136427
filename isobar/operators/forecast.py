"""Forecasts for any number of series in one job, future grids, splits and scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.joins import join_per_key
from isobar.operators.ordered import newest, split_newest
from isobar.session import shared_root

# Step of a frequency in seconds.
STEP_SECONDS = {"H": 3600, "h": 3600, "15min": 900}
DAY_SECONDS = 86_400
# Hours are counted from here, which keeps their squares small.
ORIGIN_SECONDS = 1_577_836_800
# Series whose models, of up to 96 residuals each, are sent to every task.
SEASON_ROWS = 10_000
# Fixed value: smallest denominator of the percentage error.
MAPE_FLOOR = 2.220446049250313e-16


def _need_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are needed")


def _step(freq: str) -> int:
    if freq not in STEP_SECONDS:
        raise ValueError(f"unknown frequency {freq!r}; use one of {sorted(STEP_SECONDS)}")
    return STEP_SECONDS[freq]


def _seconds(ds: str = "ds") -> Column:
    return F.unix_seconds(F.col(ds).cast("timestamp"))


def _hours(ds: str = "ds") -> Column:
    return (F.unix_micros(F.col(ds).cast("timestamp")) / 1e6 - ORIGIN_SECONDS) / 3600.0


def _slot(step: int, ds: str = "ds") -> Column:
    return F.floor(F.pmod(_seconds(ds), F.lit(DAY_SECONDS)) / step).cast("int")


def future_grid(last: DataFrame, periods: int, freq: str = "H", ds: str = "ds") -> DataFrame:
    """`periods` steps after the last time of every row of `last`."""
    step = F.make_dt_interval(secs=F.lit(_step(freq)))
    start = F.col(ds).cast("timestamp") + step
    stop = F.col(ds).cast("timestamp") + F.make_dt_interval(secs=F.lit(_step(freq) * periods))
    return last.withColumn(ds, F.explode(F.sequence(start, stop, step)))


# Model of a series from the moments of its cells: within-cell plus between-cell parts.
_TOTAL = "aggregate(cells, 0D, (a, c) -> a + c.n)"
_MODEL = (
    {
        "tx": f"aggregate(cells, 0D, (a, c) -> a + c.n * c.mx) / {_TOTAL}",
        "ty": f"aggregate(cells, 0D, (a, c) -> a + c.n * c.my) / {_TOTAL}",
    },
    {
        "slope": """coalesce(try_divide(
            aggregate(cells, 0D, (a, c) -> a + c.n * (c.cxy + (c.mx - tx) * (c.my - ty))),
            aggregate(cells, 0D, (a, c) -> a + c.n * (c.vx + (c.mx - tx) * (c.mx - tx)))), 0D)""",
    },
    {"intercept": "ty - slope * tx"},
    {
        "season": """map_from_entries(transform(cells,
            c -> struct(c.slot, c.my - slope * c.mx - intercept)))""",
    },
)


class TrendSeason:
    """Linear trend plus mean residual per slot of the day, per series.

    The rows are read and shuffled once, as partial moments per series and slot, so long and uneven
    series cost no more than short ones. A series then has one row: as many cells as the day has
    slots (24 or 96), from which trend and residuals follow without another pass.
    """

    def __init__(self, freq: str = "H", series: Sequence[str] = ("series",)):
        self.step = _step(freq)
        self.freq = freq
        self.series = list(series)
        self.model: DataFrame | None = None

    def fit(self, df: DataFrame) -> TrendSeason:
        _need_columns(df, "ds", "y", *self.series)
        x, y = _hours(), F.col("y")
        cells = (
            df.filter(y.isNotNull() & F.col("ds").isNotNull())
            .groupBy(*self.series, _slot(self.step).alias("slot"))
            .agg(
                F.count(F.lit(1)).cast("double").alias("n"),
                F.avg(x).alias("mx"),
                F.avg(y).alias("my"),
                F.var_pop(x).alias("vx"),
                F.covar_pop(x, y).alias("cxy"),
                F.max(F.col("ds").cast("timestamp")).alias("ds"),
            )
        )
        model = cells.groupBy(*self.series).agg(
            F.max("ds").alias("ds"),
            F.sort_array(F.collect_list(F.struct("slot", "n", "mx", "my", "vx", "cxy"))).alias("cells"),
        )
        for step in _MODEL:
            model = model.withColumns({name: F.expr(text) for name, text in step.items()})
        self.model = model.select(*self.series, "ds", "slope", "intercept", "season")
        self.history = df
        return self

    def predict(self, periods: int, only_future: bool = True) -> DataFrame:
        """`(series, ds, yhat)` of the next steps, and of the history if that is wanted too."""
        if self.model is None:
            raise ValueError("call fit first")
        times = future_grid(self.model, periods, self.freq)
        if not only_future:
            known = self.history.select(*self.series, F.col("ds").cast("timestamp").alias("ds"))
            fitted = join_per_key(known, self.model.drop("ds"), self.series, "left", SEASON_ROWS)
            times = fitted.unionByName(times)
        residual = F.coalesce(F.try_element_at("season", _slot(self.step)), F.lit(0.0))
        yhat = F.col("slope") * _hours() + F.col("intercept") + residual
        return times.select(*self.series, "ds", yhat.alias("yhat"))


def forecast(
    df: DataFrame,
    periods: int,
    freq: str = "H",
    only_future: bool = True,
    series: Sequence[str] = ("series",),
) -> DataFrame:
    return TrendSeason(freq, series).fit(df).predict(periods, only_future)


def score(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and MAPE, over all rows or per key."""
    error = F.col(y) - F.col(yhat)
    return df.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(F.abs(error) / F.greatest(F.abs(F.col(y)), F.lit(MAPE_FLOOR))).alias("mape"),
    )


def prepare(
    df: DataFrame,
    target: str,
    regressors: Sequence[str],
    date: str,
    series: Sequence[str] = ("series",),
) -> DataFrame:
    """`(series, ds, y, regressors)` of one target."""
    kept = [c for c in regressors if c not in (target, date)]
    return df.select(*series, F.col(date).alias("ds"), F.col(target).cast("double").alias("y"), *kept)


def with_regressors(
    future: DataFrame, known: DataFrame, regressors: Sequence[str], series: Sequence[str] = ("series",)
) -> DataFrame:
    """Future times with the regressors of the rows at the same time; null where there are none."""
    return future.join(known.select(*series, "ds", *regressors), [*series, "ds"], "left")


def _time_features(daily: int, yearly: int) -> dict[str, Column]:
    seconds = _seconds().cast("double")
    features = {"t_trend": _hours() / (24.0 * 365.25)}
    for name, period, order in (("day", DAY_SECONDS, daily), ("year", 365.25 * DAY_SECONDS, yearly)):
        for k in range(1, order + 1):
            angle = seconds * F.lit(2.0 * math.pi * k / period)
            features[f"t_{name}_sin{k}"] = F.sin(angle)
            features[f"t_{name}_cos{k}"] = F.cos(angle)
    return features


class RegressorForecast:
    """Linear model of a target on time features and regressors, with a level per series.

    The level is the series' training mean, taken off before the fit and added back after it; the
    coefficients are shared. The fit is one distributed pass (normal equations); only the
    coefficients, as many as there are features, reach the driver.
    """

    def __init__(
        self,
        regressors: Sequence[str],
        series: Sequence[str] = ("series",),
        daily: int = 2,
        yearly: int = 0,
        ridge: float = 1e-6,
    ):
        self.regressors = list(regressors)
        self.series = list(series)
        self.time = _time_features(daily, yearly)
        self.ridge = ridge
        self.model = None

    def _assembled(self, df: DataFrame) -> DataFrame:
        inputs = list(self.time) + self.regressors
        assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
        return assembler.transform(df.withColumns(self.time))

    def fit(self, train: DataFrame) -> RegressorForecast:
        _need_columns(train, "ds", "y", *self.series, *self.regressors)
        known = train.na.drop(subset=["ds", "y", *self.regressors])
        # Kept: fit and predict both use it.
        shared_root(train.sparkSession)
        self.levels = known.groupBy(*self.series).agg(F.avg("y").alias("_level")).checkpoint()
        centered = join_per_key(known, self.levels, self.series, "inner").withColumn("_y", F.col("y") - F.col("_level"))
        regression = LinearRegression(
            featuresCol="features", labelCol="_y", predictionCol="_p", solver="normal", regParam=self.ridge
        )
        self.model = regression.fit(self._assembled(centered).select("features", "_y"))
        return self

    def predict(self, future: DataFrame) -> DataFrame:
        """Adds `yhat` to rows that hold `ds` and the regressors; it is null in rows with gaps."""
        if self.model is None:
            raise ValueError("call fit first")
        rows = self._assembled(join_per_key(future, self.levels, self.series))
        return (
            self.model.transform(rows)
            .withColumn("yhat", F.col("_p") + F.col("_level"))
            .withColumn("yhat", F.when(~F.isnan("yhat"), F.col("yhat")))
            .drop("features", "_p", "_level", *self.time)
        )


def holdout_forecast(
    df: DataFrame,
    target: str,
    regressors: Sequence[str],
    date: str,
    series: Sequence[str] = ("series",),
    forecast_length: int = 24,
    normalise: bool = False,
    parity: bool = False,
    daily: int = 2,
    yearly: int = 0,
    ridge: float = 1e-6,
    model=None,
) -> DataFrame:
    """Test rows of every series with their forecast: `(series, ds, y, yhat)`.

    `model` has `fit` and `predict` like `RegressorForecast`, which is the default; `SeriesRegression` gives every series
    its own coefficients. The last `forecast_length` rows are held out, and the regressors of the future come from them.
    With `normalise` the target is z-scored first and scaled back at the end, by the statistics of
    the training rows, or under `parity` by those of the test rows as well.
    """
    rows = prepare(df, target, regressors, date, series)
    marked = split_newest(rows, forecast_length, series, ["ds"])
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    names = [c for c in regressors if c not in (target, date)]
    if normalise:
        spread = lambda part: part.groupBy(*series).agg(
            F.avg("y").alias("_m"), F.stddev_pop("y").alias("_s")
        )
        train_stats = spread(train)
        back = spread(test) if parity else train_stats
        train = (
            join_per_key(train, train_stats, series, "inner")
            .withColumn("y", F.try_divide(F.col("y") - F.col("_m"), F.col("_s")))
            .drop("_m", "_s")
        )
    model = model or RegressorForecast(names, series, daily, yearly, ridge)
    predicted = model.fit(train).predict(test)
    if normalise:
        predicted = join_per_key(predicted, back, series, "inner").withColumn(
            "yhat", F.col("yhat") * F.col("_s") + F.col("_m")
        )
    return predicted.select(*series, "ds", "y", "yhat")


def context_rows(marked: DataFrame, previous: int, series: Sequence[str] = ("series",)) -> DataFrame:
    """The last `previous` training rows of each series together with its test rows."""
    train = newest(marked.filter(~F.col("is_test")), previous, series, ["ds"])
    return train.unionByName(marked.filter("is_test"))
