"""Gradient-boosted trees with logistic loss, grown level by level from sums over blocks of split places.

Where rows are few, an ensemble grows within one task that has all blocks. Beyond that, several ensembles over the same rows grow in step:
a level is one pass over kept blocks, which answers all of them.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.operators import passes
from riskweft.session import shared_folder

#: Split points of a feature at most.
POINTS = 31
#: Bytes of sums that a task returns at most; a level with more nodes takes several passes.
PASS_BYTES = 16_000_000
#: Rounds after which the margins are written to the shared folder, so that they don't hang on all rounds before.
WRITTEN_ROUNDS = 25
#: Rows of a kept block, about: a node costs something in every block.
BLOCK_ROWS = 50_000
#: Cells of a bundle of features at most (a place is one byte), and the rows a node has at least where bundles are counted.
BUNDLE_CELLS, BUNDLE_ROWS = 256, 400
#: Nodes whose splits are compared at once.
NODES_AT_ONCE = 128
#: An ensemble grows within one task while the rows' blocks and margins take so many bytes at most, and the rows are at most so many for
#: each ensemble (up to the slots): passes cost a job a level, which few rows don't repay.
TASK_BYTES, TASK_ROWS = 256_000_000, 1_000_000
#: Tasks for each slot that ensembles are dealt to, at most; every task is sent all blocks.
TASKS_PER_SLOT = 4


@dataclass(frozen=True)
class Boost:
    """Settings of one ensemble. ``positive`` multiplies the weights of the positive rows."""

    rounds: int
    depth: int
    rate: float
    rows: float = 1.0
    columns: float = 1.0
    smallest: int = 1
    seed: int = 42
    positive: float = 1.0


def split_points(base: DataFrame, width: int, most: int) -> list[np.ndarray]:
    """Sorted split points of every feature in ``_x``: its smallest value and quantiles, without the largest value."""
    shares = [(i + 1) / most for i in range(most - 1)]
    x = [F.col("_x")[i] for i in range(width)]
    found = [F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.percentile_approx(c, shares, 1000).alias("points")).alias(f"f{i}") for i, c in enumerate(x)]
    row = base.agg(*found).first()
    values = [np.unique(np.array([r["low"], *(r["points"] or [])], "float64")) for r in row]
    return [v[v < r["high"]] for v, r in zip(values, row)]


# ---- trees -----------------------------------------------------------------------------------------------------------


class Tree:
    """Nodes by number: a split has a feature, a place (or threshold) and its left child, the right one is the next number."""

    def __init__(self) -> None:
        self.feature, self.place, self.left, self.value, self.depth = [0], [255], [0], [0.0], 0

    def split(self, node: int, feature: int, place: int, values: tuple[float, float]) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.place[node], self.left[node] = feature, place, left
        for child, value in zip((left, left + 1), values):
            self.feature.append(0)
            self.place.append(255)  # no place is larger: a row stays in a leaf
            self.left.append(child)
            self.value.append(value)
        return left, left + 1

    def arrays(self) -> tuple:
        return np.array(self.feature), np.array(self.place, np.uint8), np.array(self.left), np.array(self.value), self.depth


def _nodes(tree: tuple, codes: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The node of every row (a column of ``codes``), or of the given ones, after all levels of the tree."""
    feature, place, left, _, depth = tree
    rows = np.arange(codes.shape[1]) if rows is None else rows
    if not depth:
        return np.zeros(len(rows), int)
    node = left[0] + (codes[feature[0]].take(rows) > place[0])
    flat, starts = codes.reshape(-1), feature * codes.shape[1]
    for _ in range(depth - 1):
        at = starts.take(node)
        at += rows
        right = flat.take(at) > place.take(node)
        node = left.take(node)
        node += right
    return node


def _hashes(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number below 2 ** 53 of a row's key and a tree's seed (splitmix64)."""
    z = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) >> np.uint64(11)


# ---- bundles ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Column:
    """What is counted at once: a row of the codes, its number of places, its features' cells, and the sums of places by those cells."""

    row: int
    size: int
    cells: np.ndarray
    sums: np.ndarray | None = None


class Layout:
    """Cells of all features side by side. Features with few places share a bundle, whose place stands for all of theirs."""

    def __init__(self, sizes: list[int]):
        self.sizes, self.starts = sizes, np.concatenate([[0], np.cumsum(sizes)])
        self.plain = [Column(i, size, self._cells(i)) for i, size in enumerate(sizes)]
        found: list[list[int]] = []
        products: list[int] = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fit = next((b for b, product in enumerate(products) if product * sizes[i] <= BUNDLE_CELLS), None)
            if fit is None:
                found.append([i])
                products.append(sizes[i])
            else:
                found[fit].append(i)
                products[fit] *= sizes[i]
        self.bundles = [features for features in found if len(features) > 1]
        self.bundled = [self.plain[features[0]] for features in found if len(features) == 1]
        for row, features in enumerate(self.bundles, len(sizes)):
            places = np.unravel_index(np.arange(int(np.prod([sizes[f] for f in features]))), [sizes[f] for f in features])
            sums = np.concatenate([place[:, None] == np.arange(sizes[f]) for place, f in zip(places, features)], axis=1).astype("float64")
            self.bundled.append(Column(row, len(sums), np.concatenate([self._cells(f) for f in features]), sums))

    def __reduce__(self):
        # A task is sent the sizes alone; a process makes the rest once.
        return layout_of, (tuple(self.sizes),)

    def _cells(self, feature: int) -> np.ndarray:
        return np.arange(self.starts[feature], self.starts[feature + 1])

    def with_bundles(self, codes: np.ndarray) -> np.ndarray:
        rows = list(codes)
        for features in self.bundles:
            whole = codes[features[0]]
            for f in features[1:]:
                whole = whole * np.uint8(self.sizes[f]) + codes[f]
            rows.append(whole)
        return np.stack(rows)


@lru_cache(16)
def layout_of(sizes: tuple[int, ...]) -> Layout:
    return Layout(list(sizes))


# ---- passes ----------------------------------------------------------------------------------------------------------


def _code(points: list[np.ndarray], layout: Layout):
    def packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        codes, *rest = [np.concatenate(arrays, axis=-1) for arrays in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (layout.with_bundles(codes), *rest)], ["codes", "y", "w", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(points))
                codes = np.stack([np.searchsorted(p, x[:, i]).astype(np.uint8) for i, p in enumerate(points)])
                parts.append([codes, *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "key")]])
                rows += batch.num_rows
                if rows >= BLOCK_ROWS:
                    yield packed(parts)
                    parts, rows = [], 0
        if parts:
            yield packed(parts)

    return run


def _block(rows: int, sampled: bool):
    """(codes, signs, weights or None where all are 1, keys where they are needed, margins by member)."""

    def run(row) -> tuple:
        sign, w = (2 * np.frombuffer(row["y"]) - 1).astype(np.int8), np.frombuffer(row["w"])
        codes = np.frombuffer(row["codes"], np.uint8).reshape(rows, -1)
        return codes, sign, None if (w == 1).all() else w, np.frombuffer(row["key"], np.uint64) if sampled else None, {}

    return run


def _grown(trees: dict[int, tuple], going: list[int]):
    """A block with the trees' values added to the margins of the members that go on."""

    def run(block: tuple) -> tuple:
        codes, sign, w, key, margins = block
        return codes, sign, w, key, {m: margins.get(m, 0.0) + trees[m][3].take(_nodes(trees[m], codes)) for m in going}

    return run


def _sums(boosts: list[Boost], turn: int, layout: Layout, work: list[tuple]):
    """(rows, weights, weighted residuals) by node, feature and place of a block, for every (member, tree, nodes) of ``work``."""

    def run(block: tuple) -> np.ndarray:
        codes, signs, w, key, margins = block
        hashes: dict[int, np.ndarray] = {}
        found = []
        for m, tree, nodes in work:
            boost = boosts[m]
            rows = np.arange(len(signs))
            if boost.rows < 1:
                if boost.seed not in hashes:
                    hashes[boost.seed] = _hashes(key, boost.seed + turn)
                rows = np.flatnonzero(hashes[boost.seed] < np.uint64(int(boost.rows * (1 << 53))))
            slot = None  # of every row among the nodes; a single node has all rows
            if len(nodes) > 1 or tree[4]:
                slots = np.full(len(tree[0]), -1)
                slots[nodes] = np.arange(len(nodes))
                slot = slots.take(_nodes(tree, codes, rows))
                keep = np.flatnonzero(slot >= 0)
                slot, rows = slot.take(keep), rows.take(keep)
            sign = signs.take(rows)
            positive = np.flatnonzero(sign > 0)
            weight = None if w is None else w.take(rows)
            # What the trees so far leave over: the first tree takes the labels themselves.
            rest = sign.astype("float64") if turn == 0 else 4 * sign / (1 + np.exp(np.minimum(2 * sign * margins[m].take(rows), 700)))
            if boost.positive != 1 and weight is not None:
                weight[positive] *= boost.positive
            if weight is not None:
                rest *= weight
            elif boost.positive != 1:
                rest[positive] *= boost.positive
            columns = layout.bundled if len(rows) >= BUNDLE_ROWS * len(nodes) else layout.plain
            stride = max(c.size for c in columns)
            cells = len(nodes) * stride
            base = None if slot is None or len(nodes) == 1 else slot * stride
            sums = np.empty((3, len(nodes), layout.starts[-1]))
            for column in columns:
                cell = codes[column.row].take(rows).astype(np.int64)
                if base is not None:
                    cell += base
                count = np.bincount(cell, minlength=cells).astype("float64")
                if weight is not None:
                    weighed = np.bincount(cell, weight, cells)
                elif boost.positive != 1:
                    weighed = count + (boost.positive - 1) * np.bincount(cell.take(positive), minlength=cells)
                else:
                    weighed = count
                part = np.stack([count, weighed, np.bincount(cell, rest, cells)]).reshape(3, len(nodes), stride)[:, :, : column.size]
                first, last = column.cells[0], column.cells[-1] + 1
                if column.sums is None:
                    sums[:, :, first:last] = part
                else:
                    sums[:, :, column.cells] = part @ column.sums
            found.append(sums.ravel())
        return np.concatenate(found)

    return run


def _passes(work: list[tuple], cells: int) -> Iterator[list[tuple]]:
    """The work in parts whose sums stay below PASS_BYTES."""
    most, part, used = max(1, PASS_BYTES // (cells * 24)), [], 0
    for m, tree, nodes in work:
        while nodes:
            taken, nodes = nodes[: most - used], nodes[most - used :]
            part.append((m, tree, taken))
            used += len(taken)
            if used == most:
                yield part
                part, used = [], 0
    if part:
        yield part


def _allowed(boost: Boost, turn: int, node: int, width: int) -> list[int]:
    """The features that a node may split on."""
    if boost.columns >= 1:
        return list(range(width))
    rng = np.random.default_rng([boost.seed, turn, node])
    return sorted(rng.permutation(width)[: int(np.ceil(boost.columns * width))].tolist())


def _best(sums: np.ndarray, layout: Layout, nodes: list[tuple[Boost, int]], turn: int) -> list[tuple | None]:
    """(gain, feature, place, left value, right value) of the largest fall in variance for each node's sums; the first of equal ones."""
    sizes = np.array(layout.sizes)
    width, places = len(sizes), np.arange(max(sizes.max() - 1, 1))
    real = places < sizes[:, None] - 1
    # Places that a feature doesn't have read an empty cell behind all others.
    cells = np.where(real, layout.starts[:-1, None] + places, layout.starts[-1])
    found: list[tuple | None] = []
    for begin in range(0, len(nodes), NODES_AT_ONCE):
        some, own = sums[begin : begin + NODES_AT_ONCE], nodes[begin : begin + NODES_AT_ONCE]
        whole = some[:, :, : sizes[0]].sum(axis=2)
        left = np.concatenate([some, np.zeros((len(some), 3, 1))], axis=2)[:, :, cells].cumsum(axis=3)
        right = whole[:, :, None, None] - left
        least = np.array([boost.smallest for boost, _ in own])[:, None, None]
        good = real & (left[:, 0] >= least) & (right[:, 0] >= least) & (left[:, 1] > 0) & (right[:, 1] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            square = whole[:, 2] ** 2 / whole[:, 1]
            gains = np.where(good, left[:, 2] ** 2 / left[:, 1] + right[:, 2] ** 2 / right[:, 1] - square[:, None, None], -np.inf)
        # Equal splits of the rows differ by rounding alone.
        top = gains.max(axis=2, keepdims=True)
        place = np.argmax(gains >= top - abs(top) * 1e-9, axis=2)
        gain = np.take_along_axis(gains, place[:, :, None], axis=2)[:, :, 0]
        for i, (boost, node) in enumerate(own):
            best = None
            if whole[i, 1] > 0:
                own_gains = gain[i].tolist()
                for f in _allowed(boost, turn, node, width):
                    if own_gains[f] > 1e-10 * square[i] and (best is None or own_gains[f] > own_gains[best] * (1 + 1e-9)):
                        best = f
            if best is None:
                found.append(None)
                continue
            at = int(place[i, best])
            (_, lw, lr), (_, rw, rr) = left[i, :, best, at], right[i, :, best, at]
            found.append((own_gains[best], best, at, float(lr / lw), float(rr / rw)))
    return found


def _grow(summed: Callable, boosts: list[Boost], turn: int, layout: Layout, importances: list[np.ndarray]) -> dict[int, Tree]:
    """The trees of one round, by member: sums of the smaller child of every split are counted, the other's are the difference."""
    sizes, cells = layout.sizes, int(layout.starts[-1])
    trees = {m: Tree() for m, b in enumerate(boosts) if turn < b.rounds}
    known: dict[tuple[int, int], np.ndarray] = {}
    wanted = {m: [0] for m in trees}
    others: dict[tuple[int, int], tuple[int, int]] = {}
    while any(wanted.values()):
        work = [(m, trees[m].arrays(), nodes) for m, nodes in wanted.items() if nodes]
        for part in _passes(work, cells):
            found, at = summed(_sums(boosts, turn, layout, part)), 0
            for m, _, nodes in part:
                size = 3 * len(nodes) * cells
                for node, sums in zip(nodes, np.moveaxis(found[at : at + size].reshape(3, len(nodes), -1), 1, 0)):
                    known[m, node] = sums
                at += size
        for (m, node), (parent, sibling) in others.items():
            known[m, node] = known[m, parent] - known[m, sibling]
        frontier = [(m, node) for m, nodes in wanted.items() for node in nodes] + list(others)
        wanted, others = {m: [] for m in trees}, {}
        kept = {}
        frontier.sort()
        splits = _best(np.stack([known[one] for one in frontier]), layout, [(boosts[m], node) for m, node in frontier], turn)
        for (m, node), split in zip(frontier, splits):
            tree, sums = trees[m], known[m, node]
            if node == 0:
                weight, rest = sums[1:, : sizes[0]].sum(axis=1)
                tree.value[0] = float(rest / weight) if weight > 0 else 0.0
            if split is None:
                continue
            gain, feature, place, low, high = split
            left, right = tree.split(node, feature, place, (low, high))
            importances[m][feature] += gain
            begin = layout.starts[feature]
            rows, less = sums[0, : sizes[0]].sum(), sums[0, begin : begin + place + 1].sum()
            small, large = (left, right) if 2 * less <= rows else (right, left)
            kept[m, node] = sums
            wanted[m].append(small)
            others[m, large] = node, small
        for m, tree in trees.items():
            tree.depth += bool(wanted[m])
            if tree.depth >= boosts[m].depth:
                wanted[m] = []
        others = {k: v for k, v in others.items() if wanted[k[0]]}
        known = kept
    return trees


def _boosted(summed: Callable, advance: Callable, boosts: list[Boost], layout: Layout, points: list[np.ndarray]) -> list[str]:
    """States of the ensembles. ``summed`` adds a function's arrays over all blocks, ``advance`` takes a round's trees into the margins."""
    found: list[list] = [[] for _ in boosts]
    importances = [np.zeros(len(points)) for _ in boosts]
    for turn in range(max(b.rounds for b in boosts)):
        trees = _grow(summed, boosts, turn, layout, importances)
        ready = {}
        for m, tree in trees.items():
            scale = 1.0 if turn == 0 else boosts[m].rate
            tree.value = [scale * v for v in tree.value]
            ready[m] = tree.arrays()
            # Leaves keep a threshold that no row passes.
            own = [float(points[f][p]) if l != i else None for i, (f, p, l) in enumerate(zip(tree.feature, tree.place, tree.left))]
            found[m].append({"feature": tree.feature, "threshold": own, "left": tree.left, "value": tree.value, "depth": tree.depth})
        advance(turn, _grown(ready, [m for m in trees if turn + 1 < boosts[m].rounds]))
    return [json.dumps({"trees": t, "importances": list(i), "width": len(points)}) for t, i in zip(found, importances)]


def _in_passes(blocks: RDD, boosts: list[Boost], layout: Layout, points: list[np.ndarray]) -> list[str]:
    """All ensembles in step: a level is one pass for all of them."""
    kept = [blocks.persist(StorageLevel.MEMORY_AND_DISK)]

    def advance(turn: int, grown: Callable) -> None:
        while len(kept) > 1:
            kept.pop(0).unpersist()  # the passes of this round have read the blocks that were made of it
        if turn + 1 < max(b.rounds for b in boosts):
            kept.append(kept[-1].map(grown).persist(StorageLevel.MEMORY_AND_DISK))
            if turn % WRITTEN_ROUNDS == WRITTEN_ROUNDS - 1:
                kept[-1].checkpoint()

    try:
        return _boosted(lambda part: passes.summed(kept[-1], part), advance, boosts, layout, points)
    finally:
        for one in kept:
            one.unpersist()


def _in_tasks(blocks: RDD, boosts: list[Boost], layout: Layout, points: list[np.ndarray], tasks: int) -> list[str]:
    """Every ensemble within one task, which has all blocks; the longest ones are dealt out first."""
    dealt: list[list[int]] = [[] for _ in range(tasks)]
    work = [0.0] * tasks
    for m in sorted(range(len(boosts)), key=lambda m: -boosts[m].rounds * boosts[m].depth):
        least = work.index(min(work))
        dealt[least].append(m)
        work[least] += boosts[m].rounds * boosts[m].depth

    def copies(part: int, found: Iterator) -> Iterator[tuple]:
        for i, block in enumerate(found):
            for task in range(tasks):
                yield task, ((part, i), block)

    def run(found: Iterator) -> Iterator[tuple[int, str]]:
        sent, task = [], 0
        for task, block in found:
            sent.append(block)
        sent.sort(key=lambda pair: pair[0])
        for m in dealt[task] if sent else []:
            own = [block for _, block in sent]

            def advance(turn: int, grown: Callable) -> None:
                own[:] = [grown(block) for block in own]

            yield m, _boosted(lambda part: sum(map(part, own)), advance, [boosts[m]], layout, points)[0]

    states = dict(blocks.mapPartitionsWithIndex(copies).partitionBy(tasks, lambda task: task).mapPartitions(run).collect())
    return [states[m] for m in range(len(boosts))]


def boost_together(frame: DataFrame, boosts: list[Boost], features: str, label: str, weight: str | None = None, keys: list[str] = [], fits: int = 1) -> list[BoostedTrees]:
    """An ensemble for each of the settings, all on the same rows; ``keys`` name a row in the trees' samples, ``fits`` such calls run side by side."""
    session = frame.sparkSession
    shared_folder(session)
    x = vector_to_array(features)
    key = F.xxhash64(*keys) if keys else F.xxhash64(x)
    base = frame.filter(F.col(label).isNotNull()).select(
        x.alias("_x"), F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"), key.alias("key")
    )
    width, rows = base.agg(F.max(F.size("_x")), F.count(F.lit(1))).first()
    points = split_points(base, width, POINTS)
    layout = layout_of(tuple(len(p) + 1 for p in points))
    height = width + len(layout.bundles)
    coded = base.mapInArrow(_code(points, layout), "codes binary, y binary, w binary, key binary").rdd
    blocks = coded.map(_block(height, any(b.rows < 1 for b in boosts)))
    slots = session.sparkContext.defaultParallelism
    if rows * (height + 25) <= TASK_BYTES and rows <= TASK_ROWS * min(len(boosts), slots):
        states = _in_tasks(blocks, boosts, layout, points, min(len(boosts), TASKS_PER_SLOT * max(1, math.ceil(slots / fits))))
    else:
        states = _in_passes(blocks, boosts, layout, points)
    return [BoostedTrees(state=state) for state in states]


class BoostedTreesClassifier(Estimator):
    """One ensemble of boosted trees."""

    def __init__(self, boost: Boost, features: str, label: str, weight: str | None = None, row_id: str = "event_id"):
        super().__init__()
        self.boost, self.features, self.label, self.weight, self.row_id = boost, features, label, weight, row_id

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        keys = [c for c in (self.row_id, "copy") if c in dataset.columns]
        return boost_together(dataset, [self.boost], self.features, self.label, self.weight, keys)[0]


class BoostedTrees(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "trees and importances as JSON", TypeConverters.toString)
    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None, inputCol="features"):
        super().__init__()
        self._setDefault(inputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    @property
    def getNumTrees(self) -> int:
        return len(self.fitted()["trees"])

    @property
    def featureImportances(self) -> DenseVector:
        values = np.array(self.fitted()["importances"])
        return Vectors.dense(values / (values.sum() or 1.0))

    def first(self, trees: int) -> BoostedTrees:
        """The model after its first rounds; the importances stay those of all rounds."""
        state = self.fitted()
        return BoostedTrees(state=json.dumps({**state, "trees": state["trees"][:trees]}), inputCol=self.getOrDefault("inputCol"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = []
        for t in self.fitted()["trees"]:
            threshold = np.array([np.inf if v is None else v for v in t["threshold"]])
            trees.append((np.array(t["feature"]), threshold, np.array(t["left"]), np.array(t["value"]), t["depth"]))

        @F.pandas_udf("double")
        def margin(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            x = np.ascontiguousarray(np.stack(rows.to_numpy()).T)
            total = np.zeros(x.shape[1])
            for tree in trees:
                total += tree[3][_nodes(tree, x)]
            return pd.Series(1 / (1 + np.exp(np.clip(-2 * total, -700, 700))))

        scored = dataset.withColumn("_p", margin(vector_to_array(self.getOrDefault("inputCol"))))
        return scored.select(
            *dataset.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )
