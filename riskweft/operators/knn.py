"""Exact k-nearest-neighbour join.

Space is cut into cells by planes that halve a sample of the candidates, so that a cell holds a bounded number of them. A point is
compared with its own cell first; the distance to the k-th neighbour found there bounds the search, and the point goes on to those
other cells alone whose box of candidates is not farther away. A task sees one block of points and one of candidates, both of
bounded size. It cuts both into boxes again, and boxes farther apart than the k-th neighbours so far are not compared. Matrix products
with a bound of their rounding pick the pairs whose distance is then added up coordinate by coordinate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweft.functions.exprs import order_key
from riskweft.session import scratch_path

# Candidates of a box within a task, and rows of a block on either side of a task.
POINTS_PER_PIVOT = 256
BLOCK_ROWS = 32768
# Fewer points are not worth a block of their own.
LEAST_BLOCK = 2048
# Beyond so many cells, cells grow with the data and are cut into more blocks.
MAX_CELLS = 4096
# Sampled candidates for each cell: the planes go through their medians.
SAMPLE_PER_CELL = 32
# Boxes that are compared at once at most.
BOXES_AT_ONCE = 16
# Widening of bounds that covers rounding in the distances they are built from.
SLACK = 1e-9


def as_points(df: DataFrame, point_id: str, columns: list[str]) -> DataFrame:
    """(id, v): the id and the coordinates as an array; one array column or several numeric columns."""
    if len(columns) == 1 and df.schema[columns[0]].dataType.typeName() == "array":
        vector = F.col(columns[0]).cast("array<double>")
    else:
        vector = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.col(point_id).cast("bigint").alias("id"), vector.alias("v"))


def written(df: DataFrame, name: str = "neighbours") -> DataFrame:
    """The rows, read back from the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _finite(points: DataFrame) -> DataFrame:
    """Points without a null, NaN or infinite coordinate; the others are near nothing."""
    return points.filter(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def _thin_copies(points: DataFrame, keep: int) -> DataFrame:
    """Of identical points only the ``keep`` smallest ids can be among anyone's nearest, so the others are dropped.

    The rank filter is applied before the shuffle as well, so a flood of copies does not travel.
    """
    # The hash comes first, so that sorting seldom compares coordinates.
    rank = F.row_number().over(Window.partitionBy(F.xxhash64("v"), "v").orderBy("id"))
    return points.withColumn("_r", rank).filter(F.col("_r") <= keep).drop("_r")


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if not rows:
        return np.zeros((0, 1))
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(rows, -1)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


# ---- cells -----------------------------------------------------------------------------------------------------------


class _Planes:
    """A complete binary tree of cuts (coordinate, place); a cell is the number of a leaf."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(2**depth - 1, "int64")
        self.place = np.full(2**depth - 1, np.inf)
        parts = [sample]
        for node in range(2**depth - 1):
            part = parts[node]
            if len(part) > 1:
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                values = np.sort(part[:, axis])
                # The last value of the lower half; with many equal ones, the last below them.
                place = values[(len(values) - 1) // 2]
                if place == values[-1]:
                    smaller = values[values < place]
                    place = smaller[-1] if len(smaller) else np.inf
                self.axis[node], self.place[node] = axis, place
            low = part[:, self.axis[node]] <= self.place[node]
            parts += [part[low], part[~low]]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), "int64")
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.place[node])
        return (node - (2**self.depth - 1)).astype("int32")


def _celled(points: DataFrame, planes: _Planes) -> DataFrame:
    """(id, v, cell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell = planes.cell(_matrix(batch.column("v"), len(batch)))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell)], ["id", "v", "cell"])

    return points.mapInArrow(run, "id bigint, v array<double>, cell int")


def _cell_boxes(points: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest coordinates of the points of each cell (an empty cell is infinitely far away)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if len(batch):
                v, cell = _matrix(batch.column("v"), len(batch)), batch.column("cell").to_numpy()
                if low is None:
                    low, high = np.full((cells, v.shape[1]), np.inf), np.full((cells, v.shape[1]), -np.inf)
                np.minimum.at(low, cell, v)
                np.maximum.at(high, cell, v)
        if low is not None:
            cell, axis = np.nonzero(low <= high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype("int32")), pa.array(axis.astype("int32")), pa.array(low[cell, axis]), pa.array(high[cell, axis])],
                ["cell", "axis", "low", "high"],
            )

    parts = points.mapInArrow(run, "cell int, axis int, low double, high double")
    rows = parts.groupBy("cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    width = 1 + max(r["axis"] for r in rows)
    low, high = np.full((cells, width), np.inf), np.full((cells, width), np.inf)
    for r in rows:
        low[r["cell"], r["axis"]], high[r["cell"], r["axis"]] = r["low"], r["high"]
    return low, high


# ---- one pair of blocks ----------------------------------------------------------------------------------------------


def _boxes(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in runs of at most ``size`` near points, by cuts at the median of the widest coordinate."""
    found, open_runs = [], [np.arange(len(points))]
    while open_runs:
        rows = open_runs.pop()
        if len(rows) <= size:
            found.append(rows)
            continue
        part = points[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(part[:, axis], half)
        open_runs += [rows[order[:half]], rows[order[half:]]]
    return found


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of equal number, coordinates added in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        gap = a[:, j] - b[:, j]
        total += gap * gap
    return total


def _nearest(
    points: np.ndarray, ids: np.ndarray, others: np.ndarray, other_ids: np.ndarray, k: int, size: int, exclude_self: bool, bound: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and ids of the k nearest others of each point that are no farther than ``bound``; infinite and -1 where there are fewer."""
    best, near = np.full((len(points), k), np.inf), np.full((len(points), k), -1, "int64")
    if not len(points) or not len(others):
        return best, near
    runs = _boxes(others, size)
    order = np.concatenate(runs)
    others, other_ids = others[order], other_ids[order]
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    low, high = np.minimum.reduceat(others, starts), np.maximum.reduceat(others, starts)
    need, rounding = k + exclude_self, 8 * (others.shape[1] + 8) * np.finfo("float64").eps
    for rows in _boxes(points, size):
        mine, own = points[rows], ids[rows]
        gap = np.maximum(0, np.maximum(low - mine.max(axis=0), mine.min(axis=0) - high))
        apart = (gap * gap).sum(axis=1) * (1 - SLACK)
        turn = np.argsort(apart, kind="stable")
        centre = mine.mean(axis=0)
        here = mine - centre
        norm = (here * here).sum(axis=1)
        doubled = np.concatenate([2 * here, np.full((len(here), 1), -1.0)], axis=1)
        found_d, found_id, limit = best[rows], near[rows], bound[rows]
        done, step = 0, 1
        while done < len(turn):
            some = turn[done : done + step]
            some = some[apart[some] <= limit.max()]
            if not len(some):
                break
            done, step = done + step, min(2 * step, BOXES_AT_ONCE)
            at = np.concatenate([np.arange(starts[b], ends[b]) for b in some])
            there = others[at] - centre
            norms = (there * there).sum(axis=1)
            # The true distance is within ``rounding`` times both norms of the one from the product.
            if len(at) > need and not np.isfinite(limit).all():
                d = norm[:, None] + norms[None, :] - 2 * (here @ there.T)
                limit = np.fmin(limit, np.partition(d + rounding * (norm[:, None] + norms[None, :]), need - 1, axis=1)[:, need - 1])
            # The norms of the others take part in the product, so that one comparison is left for each pair.
            product = doubled @ np.concatenate([there.T, norms[None, :] * (1 - rounding)])
            i, j = np.divmod(np.flatnonzero(~(product < (norm * (1 - rounding) - limit)[:, None])), len(at))
            true = _exact(mine[i], others[at[j]])
            keep = np.isfinite(true) & (true <= limit[i] * (1 + SLACK))
            if exclude_self:
                keep &= own[i] != other_ids[at[j]]
            i, true, j = i[keep], true[keep], other_ids[at[j[keep]]]
            if not len(i):
                continue
            held = np.repeat(np.arange(len(rows)), k)
            i, true, j = np.concatenate([held, i]), np.concatenate([found_d.ravel(), true]), np.concatenate([found_id.ravel(), j])
            order = np.lexsort((j, true, i))
            i, true, j = i[order], true[order], j[order]
            first = np.searchsorted(i, np.arange(len(rows)))
            place = np.arange(len(i)) - first[i]
            found_d, found_id = true[place < k].reshape(-1, k), j[place < k].reshape(-1, k)
            limit = np.fmin(limit, found_d[:, -1])
        best[rows], near[rows] = found_d, found_id
    return best, near


def _cells_within(points: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray, home: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of point, cell) for the other cells whose box is no farther than the point's bound."""
    rows, cells = [], []
    for start in range(0, len(points), 1024):
        some = points[start : start + 1024]
        apart = np.zeros((len(some), len(low)))
        for axis in range(some.shape[1]):
            x = some[:, axis, None]
            gap = np.maximum(0, np.maximum(low[None, :, axis] - x, x - high[None, :, axis]))
            apart += gap * gap
        # An empty cell lies at infinity.
        reached = (apart * (1 - SLACK) <= bound[start : start + 1024, None]) & np.isfinite(low[:, 0])[None, :]
        reached[:, home] = False
        row, cell = np.nonzero(reached)
        rows.append(row + start)
        cells.append(cell)
    return np.concatenate(rows), np.concatenate(cells)


SEARCHED = "id bigint, neighbours array<bigint>, distances array<double>, v array<double>, bound double, cells array<int>"


def knn_join(
    left: DataFrame,
    right: DataFrame,
    k: int,
    exclude_self: bool = False,
    points_per_pivot: int = POINTS_PER_PIVOT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, neighbour, distance_sq, place): the k nearest ``right`` points of every ``left`` point, ties by id.

    Both inputs come from ``as_points``. With ``exclude_self`` a point is not its own neighbour. ``points_per_pivot`` is the number of
    points of a box, ``block_rows`` that of a block.
    """
    spark = left.sparkSession
    candidates = written(_thin_copies(_finite(right), k + 1 if exclude_self else k))
    size = candidates.count()
    depth = max(0, min(math.ceil(math.log2(max(size, 1) / block_rows)), int(math.log2(MAX_CELLS))))
    if depth:
        keyed = candidates.select("v", "id", order_key(7, "id").alias("_k")).orderBy("_k", "id").limit(SAMPLE_PER_CELL * 2**depth)
        planes = _Planes(np.array([r["v"] for r in keyed.collect()], dtype="float64"), depth)
        rights, queries = written(_celled(candidates, planes)), written(_celled(_finite(left), planes))
        low, high = _cell_boxes(rights, 2**depth)
    else:
        rights = candidates.withColumn("cell", F.lit(0))
        queries = written(_finite(left).withColumn("cell", F.lit(0)))
        low = high = np.zeros((1, 1))

    def sizes(points: DataFrame) -> dict[int, int]:
        return {r["cell"]: r["n"] for r in points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def blocks(counts: dict[int, int], rows: int) -> F.Column:
        """Number of blocks per cell, as a lookup of at most MAX_CELLS literals."""
        numbers = [max(1, math.ceil(counts.get(i, 0) / rows)) for i in range(2**depth)]
        return F.element_at(F.array(*[F.lit(n) for n in numbers]), F.col("cell") + 1)

    def every(count) -> F.Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    right_blocks = blocks(sizes(rights), block_rows)

    def searched(points: DataFrame, on: bool) -> DataFrame:
        """The neighbours of the points (id, v, bound, cell) within their cells; with ``on``, the other cells to search."""
        counts = sizes(points)
        rows = min(block_rows, max(LEAST_BLOCK, math.ceil(sum(counts.values()) / (2 * spark.sparkContext.defaultParallelism))))
        left_blocks = blocks(counts, rows)
        own = lambda count: F.pmod(F.xxhash64("id"), count).cast("int")
        lefts = points.select("id", "v", "bound", "cell", own(left_blocks).alias("lb"), every(right_blocks).alias("rb"))
        theirs = rights.select("id", "v", "cell", own(right_blocks).alias("rb"), every(left_blocks).alias("lb"))

        def run(key: tuple, mine: pa.Table, others: pa.Table) -> pa.Table:
            cell, _, rb = [int(x.as_py()) for x in key]
            points, ids = _matrix(mine["v"], len(mine)), mine["id"].to_numpy()
            bound = mine["bound"].to_numpy()
            best, near = _nearest(points, ids, _matrix(others["v"], len(others)), others["id"].to_numpy(), k, points_per_pivot, exclude_self, bound)
            filled = np.isfinite(best)
            bound = np.fmin(bound, best[:, -1])
            # Any block's bound holds for the whole cell, so one block sends the points on.
            sent, cells = _cells_within(points, bound, low, high, cell) if on and rb == 0 and len(mine) else (np.zeros(0, "int64"),) * 2
            numbers = np.bincount(sent, minlength=len(mine))
            going = numbers > 0
            width = points.shape[1]
            columns = [
                pa.array(ids, pa.int64()),
                _lists(near[filled], filled.sum(axis=1), pa.int64()),
                _lists(best[filled], filled.sum(axis=1), pa.float64()),
                _lists(points[going].ravel(), going * width, pa.float64()),
                pa.array(bound, pa.float64()),
                _lists(cells, numbers, pa.int32()),
            ]
            return pa.Table.from_arrays(columns, ["id", "neighbours", "distances", "v", "bound", "cells"])

        keys = ["cell", "lb", "rb"]
        return written(lefts.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(run, SEARCHED))

    found = searched(queries.withColumn("bound", F.lit(float("inf"))), depth > 0)
    if depth:
        further = written(found.select("id", "v", "bound", F.explode("cells").alias("cell")))
        found = found.select("id", "neighbours", "distances").union(searched(further, False).select("id", "neighbours", "distances"))
    pairs = found.select("id", F.inline(F.arrays_zip(F.col("neighbours").alias("neighbour"), F.col("distances").alias("distance_sq"))))
    place = F.row_number().over(Window.partitionBy("id").orderBy("distance_sq", "neighbour"))
    return pairs.toDF("id", "neighbour", "distance_sq").withColumn("place", place).filter(F.col("place") <= k)


def knn_classify(
    train: DataFrame, test: DataFrame, columns: list[str], label: str, row_id: str, k: int = 5, **kw
) -> DataFrame:
    """(id, predicted, share): majority label among the k nearest training rows (smallest on ties), and its share."""
    near = knn_join(as_points(test, row_id, columns), as_points(train, row_id, columns), k, **kw)
    labels = train.select(F.col(row_id).alias("neighbour"), F.col(label).alias("_label"))
    votes = near.join(labels, "neighbour").groupBy("id", "_label").agg(F.count(F.lit(1)).alias("n"))
    # At most k rows per point.
    ranked = votes.groupBy("id").agg(F.max_by(F.struct(F.col("_label").alias("l"), F.col("n").alias("n")), F.struct("n", -F.col("_label"))).alias("top"), F.sum("n").alias("all"))
    return ranked.select("id", F.col("top.l").alias("predicted"), (F.col("top.n") / F.col("all")).alias("share"))
