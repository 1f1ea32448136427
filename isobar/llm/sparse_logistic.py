"""Logistic regression over any number of sparse rows, which stay with the workers.

Rows are packed into blocks that are written once. A step sends the weights to the tasks, each of which sums loss and slope over
its blocks, and the sums go to the driver, one row per task; there L-BFGS chooses the next weights. It ends when what is left to
gain, by its own estimate, is a small share of the loss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isobar.llm.staging import staged

#: Rows of a block.
BLOCK_ROWS = 4096
_SHAPE = "start binary, place binary, value binary, target binary, worth binary"


def pack(found: list[bytes], target: np.ndarray, worth: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: features as pairs of place and count (int32), soft label, and how much each counts."""
    for first in range(0, len(found), BLOCK_ROWS):
        own = slice(first, first + BLOCK_ROWS)
        pairs = np.frombuffer(b"".join(found[own]), np.int32).reshape(-1, 2)
        start = np.cumsum([0, *(len(f) // 8 for f in found[own])])
        parts = [start, pairs[:, 0], np.log1p(pairs[:, 1]), target[own], worth[own]]
        kinds = [np.int32, np.int32, np.float32, np.float64, np.float64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.astype(k).tobytes()], pa.binary()) for p, k in zip(parts, kinds, strict=True)],
            [c.split()[0] for c in _SHAPE.split(", ")],
        )


def packed(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The blocks that `run` makes of rows by `pack`, written."""
    return staged(rows.mapInArrow(run, _SHAPE), "blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    kinds = (np.int32, np.int32, np.float32, np.float64, np.float64)
    for batch in batches:
        for k in range(len(batch)):
            yield tuple(np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in enumerate(kinds))


def _summed(blocks: DataFrame, size: int, part: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum of `part` over all blocks, `size` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for block in _blocks(batches):
            total += part(*block)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    found = blocks.mapInArrow(run, "total binary").toArrow()["total"].to_pylist()
    # In one order, whichever task ends first.
    return np.sum([np.zeros(size), *(np.frombuffer(x, np.float64) for x in sorted(found))], 0)


def _moments(d: int):
    def part(start, place, value, target, worth):
        row = np.repeat(np.arange(len(target)), np.diff(start))
        square = np.bincount(place, worth[row] * value**2, minlength=d)
        return np.concatenate([[worth.sum(), (worth * target).sum()], square])

    return part


def _loss_and_slope(weight: np.ndarray, bias: float):
    d = len(weight)

    def part(start, place, value, target, worth):
        row = np.repeat(np.arange(len(target)), np.diff(start))
        odds = np.bincount(row, weight[place] * value, minlength=len(target)) + bias
        loss = worth @ (np.logaddexp(0, odds) - target * odds)
        miss = worth * (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - target)
        return np.concatenate([[loss, miss.sum()], np.bincount(place, miss[row] * value, minlength=d)])

    return part


def minimum(
    f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, scale: np.ndarray, left: float, rounds: int, memory: int = 20
) -> np.ndarray:
    """L-BFGS from `x`, with a guess of the second derivatives, until the gain still expected is `left` of the value."""
    value, slope = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, used = slope.copy(), []
        for s, y, r in reversed(pairs):
            used.append(r * (s @ way))
            way -= used[-1] * y
        if pairs:
            s, y, r = pairs[-1]
            way *= 1 / r / (y @ (y / scale))
        way /= scale
        for (s, y, r), a in zip(pairs, reversed(used), strict=True):
            way += (a - r * (y @ way)) * s
        gain = float(slope @ way)
        if gain <= left * value:
            break
        step = 1.0
        new_value, new_slope = f(x - way)
        while new_value > value - 1e-4 * step * gain and step > 1e-6:
            step /= 2
            new_value, new_slope = f(x - step * way)
        if new_value >= value:
            break
        s, y = -step * way, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y, 1 / (s @ y))][-memory:]
        x, value, slope = x + s, new_value, new_slope
    return x


def fit_logistic(blocks: DataFrame, d: int, ridge: float, left: float = 1e-3, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights of `d` features and intercept for soft labels, over all rows of the blocks. The intercept has no ridge."""
    n, ones, *square = _summed(blocks, d + 2, _moments(d))
    if not n:
        return np.zeros(d), 0.0
    mean = ones / n
    # Second derivatives at most, as the chance of a row is taken for even.
    scale = np.concatenate([[0.25], 0.25 * np.array(square) / n + ridge])

    def f(x: np.ndarray) -> tuple[float, np.ndarray]:
        found = _summed(blocks, d + 2, _loss_and_slope(x[1:], x[0])) / n
        found[2:] += ridge * x[1:]
        return found[0] + ridge / 2 * float(x[1:] @ x[1:]), found[1:]

    start = np.zeros(d + 1)
    start[0] = np.log((mean + 1e-3) / (1 - mean + 1e-3))
    x = minimum(f, start, scale, left, rounds)
    return x[1:], float(x[0])
