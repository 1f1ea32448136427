"""Least squares for any number of series in one job: moments in one shuffle, a solve per series behind it.

Each task sums the moments of its rows per series: count, means, and a matrix of centred products. Those are shuffled, one
small row per series and task, merged in a stream, and solved where they were merged. No series' rows come together, so a
series with most of the rows costs as much as many small ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.forecast import DAY_SECONDS, _need_columns, _seconds, _step, future_grid
from isobar.operators.joins import join_per_key

# Bytes of matrices a task holds before it passes them on.
HELD_BYTES = 64 << 20
# A pivot below this share of its feature's variance counts as a feature that others make up.
SMALL_PIVOT = 1e-10

Moments = tuple[int, np.ndarray, np.ndarray]


def moments_of(values: np.ndarray) -> Moments:
    """Count, means and centred products of rows of numbers."""
    mean = values.mean(0)
    centred = values - mean
    return len(values), mean, centred.T @ centred


def merged(a: Moments, b: Moments) -> Moments:
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _sums_per_task(keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of key columns, features and target to rows of key columns and packed moments."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        kinds, size = None, 0

        def packed() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(keys)]
            moments = [np.concatenate(([n], mean, products.ravel())).tobytes() for n, mean, products in held.values()]
            return pa.RecordBatch.from_arrays([*columns, pa.array(moments, pa.binary())], [f"k{i}" for i in range(keys)] + ["moments"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.column(i).type for i in range(keys)]
            width = len(batch.column(keys)[0])
            values = np.column_stack((batch.column(keys).flatten().to_numpy().reshape(-1, width), batch.column(keys + 1).to_numpy()))
            seen: dict[tuple, int] = {}
            names = zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True) if keys else [()] * batch.num_rows
            code = np.array([seen.setdefault(k, len(seen)) for k in names])
            order = np.argsort(code, kind="stable")
            edge = np.searchsorted(code[order], np.arange(len(seen) + 1))
            for key, low, high in zip(seen, edge[:-1], edge[1:], strict=True):
                new = moments_of(values[order[low:high]])
                size += 0 if key in held else new[2].nbytes
                held[key] = merged(held[key], new) if key in held else new
            if size >= HELD_BYTES:
                yield packed()
                held, size = {}, 0
        if held:
            yield packed()

    return sums


def _unpacked(raw: bytes) -> Moments:
    numbers = np.frombuffer(raw)
    # 1 + k + k * k numbers.
    k = (math.isqrt(4 * len(numbers) - 3) - 1) // 2
    return int(numbers[0]), numbers[1 : k + 1], numbers[k + 1 :].reshape(k, k)


def solve_per_series(rows: DataFrame, series: Sequence[str], solve: Callable[[Moments], dict], shape: str) -> DataFrame:
    """Solves each series' moments: `rows` has the series, `x` (an array of equal length everywhere) and `y`.

    Rows with a gap in `x` or `y` are left out. `solve` gives the columns of `shape`; the series come first.
    """
    whole = F.col("y").isNotNull() & ~F.isnan("y") & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))
    known = rows.select(*series, F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y")).filter(whole)
    keys = [T.StructField(f"k{i}", known.schema[s].dataType) for i, s in enumerate(series)]
    packed = T.StructType([*keys, T.StructField("moments", T.BinaryType())])
    names = [k.name for k in keys]
    sums = known.mapInArrow(_sums_per_task(len(series)), packed)
    out = T.StructType([*keys, *T.StructType.fromDDL(shape).fields])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, None
        for batch in batches:
            first = first if first is not None else batch.slice(0, 1)
            for raw in batch.column(len(names)).to_pylist():
                total = _unpacked(raw) if total is None else merged(total, _unpacked(raw))
        found = solve(total)
        kinds = {f.name: f.dataType for f in out.fields[len(names) :]}
        values = [pa.array([found[c]], _arrow(kind)) for c, kind in kinds.items()]
        yield pa.RecordBatch.from_arrays([*first.columns[: len(names)], *values], [*names, *kinds])

    model = sums.groupBy(*names).applyInArrow(solved, out)
    return model.withColumnsRenamed(dict(zip(names, series, strict=True)))


def _arrow(kind: T.DataType) -> pa.DataType:
    plain = {T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}
    return pa.list_(plain[kind.elementType]) if isinstance(kind, T.ArrayType) else plain[kind]


def solve_normal(products: np.ndarray, target: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Coefficients of the normal equations by Cholesky, on features scaled to equal variance.

    A feature without variance gets 0. Where features make up each other the smallest coefficients are taken.
    """
    scale = np.sqrt(np.maximum(np.diag(products), 0.0))
    used = scale > 0
    out = np.zeros(len(target))
    if not used.any():
        return out
    scale = scale[used]
    unit = products[np.ix_(used, used)] / np.outer(scale, scale) + ridge * np.eye(len(scale))
    goal = target[used] / scale
    try:
        root = np.linalg.cholesky(unit)
        if np.diag(root).min() ** 2 < SMALL_PIVOT:
            raise np.linalg.LinAlgError
        found = np.linalg.solve(root.T, np.linalg.solve(root, goal))
    except np.linalg.LinAlgError:
        found = np.linalg.lstsq(unit, goal, rcond=SMALL_PIVOT)[0]
    out[used] = found / scale
    return out


def least_squares(moments: Moments, ridge: float = 0.0) -> dict:
    """n, intercept, coefficients and the sum of squared residuals."""
    n, mean, products = moments
    beta = solve_normal(products[:-1, :-1], products[:-1, -1], ridge)
    rest = products[-1, -1] - 2 * beta @ products[:-1, -1] + beta @ products[:-1, :-1] @ beta
    return {"n": n, "intercept": mean[-1] - beta @ mean[:-1], "beta": beta, "rss": max(float(rest), 0.0)}


MODEL = "n long, intercept double, beta array<double>, rss double"


def fitted_value(beta: Column, x: Column, intercept: Column) -> Column:
    """Null where a feature is missing."""
    return F.aggregate(F.zip_with(beta, x, lambda b, v: b * v), intercept, lambda a, v: a + v)


def fourier(orders: dict[str, int]) -> list[Column]:
    """Sines and cosines of `ds` for each period: day, week or year, up to the given order."""
    periods = {"day": float(DAY_SECONDS), "week": 7.0 * DAY_SECONDS, "year": 365.25 * DAY_SECONDS}
    seconds = _seconds().cast("double")
    angles = [seconds * F.lit(2.0 * math.pi * k / periods[name]) for name, order in orders.items() for k in range(1, order + 1)]
    return [wave(angle) for angle in angles for wave in (F.sin, F.cos)]


class SeriesRegression:
    """A linear model per series: trend, seasons and regressors, each series with coefficients of its own.

    The fit reads the rows once. `model` has a row per series: n, intercept, beta in the order of trend, day, week, year and
    regressors, and rss.
    """

    def __init__(
        self, regressors: Sequence[str] = (), series: Sequence[str] = ("series",), daily: int = 2, weekly: int = 0, yearly: int = 0, ridge: float = 0.0
    ):
        self.regressors = list(regressors)
        self.series = list(series)
        self.orders = {"day": daily, "week": weekly, "year": yearly}
        self.ridge = ridge
        self.model: DataFrame | None = None

    def _features(self) -> Column:
        # Years since 2020 keep the trend and its products small.
        trend = (F.unix_micros(F.col("ds").cast("timestamp")) / 1e6 - 1_577_836_800) / (365.25 * DAY_SECONDS)
        return F.array(trend, *fourier(self.orders), *[F.col(r).cast("double") for r in self.regressors])

    def fit(self, train: DataFrame) -> SeriesRegression:
        _need_columns(train, "ds", "y", *self.series, *self.regressors)
        ridge = self.ridge
        rows = train.select(*self.series, self._features().alias("x"), "y")
        self.model = solve_per_series(rows, self.series, lambda m: least_squares(m, ridge), MODEL)
        return self

    def predict(self, future: DataFrame) -> DataFrame:
        """Adds `yhat`; it is null in rows with gaps and for series that were not fitted."""
        if self.model is None:
            raise ValueError("call fit first")
        model = self.model.select(*self.series, F.col("intercept").alias("_i"), F.col("beta").alias("_b"))
        return join_per_key(future, model, self.series).withColumn("yhat", fitted_value(F.col("_b"), self._features(), F.col("_i"))).drop("_i", "_b")


# Trends with change points.


def lasso_path(products: np.ndarray, target: np.ndarray, steps: int = 40, depth: float = 1e-4, sweeps: int = 200) -> list[np.ndarray]:
    """Coefficients along falling penalties, by coordinate descent on the products of features of unit length."""
    beta, out = np.zeros(len(target)), []
    most = np.abs(target).max(initial=0.0)
    if most <= 0:
        return [beta]
    for penalty in most * np.geomspace(1.0, depth, steps):
        for _ in range(sweeps):
            moved = 0.0
            for j in range(len(beta)):
                rest = target[j] - products[j] @ beta + products[j, j] * beta[j]
                new = math.copysign(max(abs(rest) - penalty, 0.0), rest) / products[j, j] if products[j, j] > 0 else 0.0
                moved = max(moved, abs(new - beta[j]))
                beta[j] = new
            if moved < 1e-9 * most:
                break
        out.append(beta.copy())
    return out


def broken_trend(moments: Moments, breaks: int) -> dict:
    """Least squares with a choice among the first `breaks` features, the hinges.

    The other features are always in. Hinges enter along an L1 path on what the others leave; every set of hinges on the path
    is fitted again without a penalty, single ones are taken out while that lowers the Bayesian information criterion, and the
    set with the lowest criterion is kept.
    """
    n, mean, products = moments
    h, u = np.arange(breaks), np.arange(breaks, len(mean) - 1)
    y = len(mean) - 1
    scale = np.sqrt(np.maximum(np.diag(products), 0.0))
    scale[scale == 0] = 1.0
    unit = products / np.outer(scale, scale)

    def cleared(columns: np.ndarray) -> np.ndarray:
        return np.column_stack([solve_normal(unit[np.ix_(u, u)], unit[u, c]) for c in columns]) if len(u) else np.zeros((0, len(columns)))

    both = np.append(h, y)
    left = unit[np.ix_(both, both)] - unit[np.ix_(both, u)] @ cleared(both)
    size = np.sqrt(np.maximum(np.diag(left)[:-1], 0.0))
    # A hinge that the other features make up is no candidate.
    some = np.flatnonzero(size > 1e-6)
    inner = left[np.ix_(some, some)] / np.outer(size[some], size[some])
    goal = left[some, -1] / size[some]
    floor = max(left[-1, -1], 0.0) * 1e-12 + 1e-300

    def refit(chosen: list[int]) -> tuple[float, np.ndarray]:
        beta = solve_normal(inner[np.ix_(chosen, chosen)], goal[chosen]) if chosen else np.zeros(0)
        rest = left[-1, -1] - beta @ goal[chosen] if chosen else left[-1, -1]
        return n * math.log(max(rest, floor)) + 2 * len(chosen) * math.log(n), beta

    tried = {tuple(np.flatnonzero(b)) for b in lasso_path(inner, goal)} | {()} if len(some) else {()}
    best = (*refit([]), [])
    for chosen in sorted(tried, key=lambda c: (len(c), c)):
        chosen = list(chosen)
        value, beta = refit(chosen)
        while chosen:
            value_without, beta_without, without = min(
                ((*refit(chosen[:k] + chosen[k + 1 :]), chosen[:k] + chosen[k + 1 :]) for k in range(len(chosen))), key=lambda r: r[0]
            )
            if value_without > value:
                break
            value, beta, chosen = value_without, beta_without, without
        if value < best[0]:
            best = (value, beta, chosen)
    beta = np.zeros(len(mean) - 1)
    beta[some[best[2]]] = best[1] / size[some[best[2]]]
    if len(u):
        beta[u] = solve_normal(unit[np.ix_(u, u)], unit[u, y] - unit[np.ix_(u, h)] @ beta[h])
    beta = beta / scale[:-1] * scale[-1]
    rest = products[y, y] - 2 * beta @ products[:-1, -1] + beta @ products[:-1, :-1] @ beta
    return {"n": n, "intercept": mean[-1] - beta @ mean[:-1], "beta": beta, "rss": max(float(rest), 0.0)}


class BrokenTrend:
    """Piecewise linear trend and seasons of day, week and year, per series, with the interface of `TrendSeason`.

    Candidates for breaks are `candidates` quantiles of the series' times, in the first `reach` of them; which of them bend
    the trend is chosen as in `broken_trend`. With `breaks`, times that hold for all series, the trend bends at all of them.
    The history is read twice: for the times, and for the moments. The last slope goes on in the future.
    """

    def __init__(
        self,
        freq: str = "H",
        series: Sequence[str] = ("series",),
        candidates: int = 25,
        reach: float = 0.8,
        breaks: Sequence[str] | None = None,
        daily: int = 4,
        weekly: int = 3,
        yearly: int = 0,
    ):
        self.step = _step(freq)
        self.freq = freq
        self.series = list(series)
        self.ranks = [reach * (k + 1) / candidates for k in range(candidates)]
        self.breaks = None if breaks is None else list(breaks)
        self.orders = {"day": daily, "week": weekly, "year": yearly}
        self.model: DataFrame | None = None

    def _features(self) -> Column:
        seconds = F.unix_micros(F.col("ds").cast("timestamp")) / 1e6
        t = (seconds - F.col("_start")) / F.col("_span")
        hinges = F.transform("_knots", lambda k: F.greatest(t - (k - F.col("_start")) / F.col("_span"), F.lit(0.0)))
        return F.concat(hinges, F.array(t, *fourier(self.orders)))

    def fit(self, df: DataFrame) -> BrokenTrend:
        _need_columns(df, "ds", "y", *self.series)
        rows = df.filter(F.col("ds").isNotNull() & F.col("y").isNotNull()).select(*self.series, F.col("ds").cast("timestamp").alias("ds"), "y")
        seconds = F.unix_micros("ds") / 1e6
        if self.breaks is None:
            knots = F.percentile_approx(seconds, self.ranks) if self.ranks else F.array().cast("array<double>")
        else:
            fixed = [F.unix_micros(F.lit(b).cast("timestamp")) / 1e6 for b in self.breaks]
            knots = F.any_value(F.array(*fixed) if fixed else F.array().cast("array<double>"))
        spans = rows.groupBy(*self.series).agg(F.min(seconds).alias("_start"), F.max(seconds).alias("_end"), knots.alias("_knots"))
        times = spans.withColumn("_span", F.greatest(F.col("_end") - F.col("_start"), F.lit(float(self.step)))).checkpoint()
        placed = join_per_key(rows, times, self.series, "inner")
        hinges = len(self.ranks) if self.breaks is None else len(self.breaks)
        solve = least_squares if self.breaks is not None else lambda m: broken_trend(m, hinges)
        model = solve_per_series(placed.select(*self.series, self._features().alias("x"), "y"), self.series, solve, MODEL)
        renamed = [F.col(s).alias(f"_of_{s}") for s in self.series]
        same = [F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in self.series]
        both = times.join(model.select(*renamed, "n", "intercept", "beta", "rss"), same).drop(*[f"_of_{s}" for s in self.series])
        self.model = both.withColumn("ds", F.timestamp_seconds("_end"))
        self.history = rows
        return self

    def change_points(self) -> DataFrame:
        """(series, ds, change): where the trend bends, and by how much per day."""
        bent = F.zip_with("_knots", F.slice("beta", 1, F.size("_knots")), lambda k, b: F.struct(k.alias("k"), b.alias("b")))
        found = self.model.select(*self.series, "_span", F.explode(F.filter(bent, lambda p: p["b"] != 0)).alias("p"))
        return found.select(*self.series, F.timestamp_seconds("p.k").alias("ds"), (F.col("p.b") / F.col("_span") * DAY_SECONDS).alias("change"))

    def predict(self, periods: int, only_future: bool = True) -> DataFrame:
        """`(series, ds, yhat)` of the next steps, and of the history if that is wanted too."""
        if self.model is None:
            raise ValueError("call fit first")
        times = future_grid(self.model, periods, self.freq)
        if not only_future:
            times = join_per_key(self.history.select(*self.series, "ds"), self.model.drop("ds"), self.series, "left", 10_000).unionByName(times)
        return times.select(*self.series, "ds", fitted_value(F.col("beta"), self._features(), F.col("intercept")).alias("yhat"))
