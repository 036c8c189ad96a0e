"""Fits as passes over blocks of rows: the rows stay on the executors as arrays, a pass returns one small sum."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps that the quasi-Newton method remembers, and values that its stopping rule looks back on.
MEMORY, LOOK_BACK = 10, 20


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            rest = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("y", "w")]
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (x, *rest)], ["x", "y", "w"])


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y, w = np.frombuffer(row["y"]), np.frombuffer(row["w"])
    return np.frombuffer(row["x"], np.float32).reshape(len(y), -1), y, w


def row_blocks(frame: DataFrame, features: str, label: str, weight: str | None = None) -> RDD:
    """(features, labels, weights) of blocks of rows, one array each, kept on the executors; features are single precision."""
    columns = [vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")]
    known = frame.filter(F.col(label).isNotNull()).select(*columns)
    return known.mapInArrow(_pack, "x binary, y binary, w binary").rdd.map(_unpack).persist(StorageLevel.MEMORY_AND_DISK)


def summed(blocks: RDD, part: Callable) -> np.ndarray:
    """Sum of ``part(block)`` over all blocks; a task returns one array, and they are added in the order of the partitions."""

    def run(found: Iterator) -> Iterator[np.ndarray]:
        total = None
        for block in found:
            one = part(block)
            total = one if total is None else total + one
        if total is not None:
            yield total

    return sum(blocks.mapPartitions(run).collect())


def _line_search(evaluate: Callable, x: np.ndarray, value: float, gradient: np.ndarray, direction: np.ndarray, step: float) -> tuple | None:
    """(point, value, gradient) that meets the strong Wolfe conditions, the best one found after 20 passes, or None."""
    slope = float(gradient @ direction)
    low, high = (0.0, value, slope), None
    best = None
    for _ in range(20):
        point = x + step * direction
        f, g = evaluate(point)
        d = float(g @ direction)
        if np.isfinite(f) and f < value and (best is None or f < best[1]):
            best = point, f, g
        if not np.isfinite(f) or f > value + 1e-4 * step * slope or f >= low[1] and low[0] > 0:
            high = (step, f, d)
        elif abs(d) <= -0.9 * slope:
            return point, f, g
        else:
            if d >= 0 or high is not None and d * (high[0] - low[0]) >= 0:
                high = low
            low = (step, f, d)
        if high is None:
            step *= 2.0
            continue
        # The minimum of the parabola through the better end, kept away from both ends.
        width = high[0] - low[0]
        bend = high[1] - low[1] - low[2] * width
        share = -low[2] * width / (2 * bend) if np.isfinite(bend) and bend > 0 else 0.5
        step = low[0] + min(max(share, 0.1), 0.9) * width
    return best


def _direction(gradient: np.ndarray, steps: list[tuple]) -> np.ndarray:
    """The quasi-Newton direction from the last (step, change of the gradient) pairs."""
    direction, scales = -gradient, []
    for s, y in reversed(steps):
        scales.append((s @ direction) / (s @ y))
        direction = direction - scales[-1] * y
    if steps:
        s, y = steps[-1]
        direction = direction * ((s @ y) / (y @ y))
    for (s, y), scale in zip(steps, reversed(scales)):
        direction = direction + (scale - (y @ direction) / (s @ y)) * s
    return direction


def minimise_along(along: Callable, lengths: tuple, start: np.ndarray, most: int, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS whose line search is one pass: ``along(point, direction)`` returns (value, gradient) at ``lengths`` times the direction.

    The first length is 0. If no length lowers the value, the direction is shortened, at most ten times.
    """
    x = np.asarray(start, "float64")
    value, gradient = along(x, np.zeros_like(x))[0]
    first, values, steps = abs(value), [value], []
    for _ in range(most):
        direction = _direction(gradient, steps)
        if not float(gradient @ direction) < 0:
            break
        if not steps:
            direction = direction / max(float(np.linalg.norm(gradient)), 1e-300)
        for _ in range(10):
            found = along(x, direction)
            best = min(range(1, len(lengths)), key=lambda i: found[i][0])
            if found[best][0] < value:
                break
            direction = direction * lengths[-1]
        else:
            break
        s, y = lengths[best] * direction, found[best][1] - gradient
        if s @ y > 0:
            steps = [*steps, (s, y)][-MEMORY:]
        x, (value, gradient) = x + s, found[best]
        values = [*values, value][-LOOK_BACK:]
        if max(values) - value <= tolerance * first or np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
    return x


def minimise(evaluate: Callable, start: np.ndarray, most: int, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS with the stopping rules of Spark's estimators; ``evaluate`` returns (value, gradient) and is one pass over the rows."""
    x = np.asarray(start, "float64")
    value, gradient = evaluate(x)
    first, values, steps = abs(value), [value], []
    for _ in range(most):
        direction = _direction(gradient, steps)
        if not float(gradient @ direction) < 0:
            break
        found = _line_search(evaluate, x, value, gradient, direction, 1.0 if steps else 1.0 / max(float(np.linalg.norm(gradient)), 1e-300))
        if found is None:
            break
        s, y = found[0] - x, found[2] - gradient
        if s @ y > 0:
            steps = [*steps, (s, y)][-MEMORY:]
        x, value, gradient = found
        values = [*values, value][-LOOK_BACK:]
        if max(values) - value <= tolerance * first or np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            break
    return x
