"""Classifier registry. Every builder returns a ``pyspark.ml`` estimator that yields ``probability`` and ``prediction``."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweft.operators import passes
from riskweft.operators.boosting import Boost, BoostedTrees, BoostedTreesClassifier, split_points
from riskweft.operators.knn import as_points, knn_join
from riskweft.session import scratch_path

FEATURES, TARGET = "features", "label"
SCRATCH_COLUMNS = ["rawPrediction", "probability", "prediction", "svm_raw", "svm_prediction", "svm_margin", "rbf"]


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def with_probability(model: Model, df: DataFrame, output: str) -> DataFrame:
    """The input columns and the positive-class probability of the model."""
    return model.transform(df).select(*df.columns, positive_probability().alias(output))


# ---- kernel machine --------------------------------------------------------------------------------------------------


#: Random features of the Gaussian kernel (Rahimi and Recht, 2007).
KERNEL_WIDTH = 128
#: Steps along a direction that one pass tries; losses and gradients of all of them come from the same products.
STEPS = (0.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.01)


def kernel_map(inputs: int, width: int, seed: int, gamma: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and offsets of the random features; ``gamma`` 0 stands for 1 / inputs."""
    rng = np.random.default_rng(seed)
    scale = math.sqrt(2 * (gamma or 1.0 / inputs))
    return rng.normal(0.0, scale, (inputs, width)), rng.uniform(0.0, 2 * math.pi, width)


def kernel_features(x: np.ndarray, projection: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """The random features of the rows in the precision of the projection; the rows themselves without one."""
    if projection is None:
        return x
    z = x.astype(projection[0].dtype, copy=False) @ projection[0]
    z += projection[1]
    np.cos(z, out=z)
    z *= z.dtype.type(math.sqrt(2.0 / z.shape[1]))
    return z


def hinge_sums(block: tuple, projection: tuple | None, centre: np.ndarray, point: np.ndarray, direction: np.ndarray) -> np.ndarray:
    """For every step of STEPS: weighted hinge loss at ``point + step * direction`` and its gradient. The last coefficient is the offset."""
    x, labels, weights = block
    total = np.zeros((len(STEPS), len(point) + 1))
    both = np.stack([point, direction], axis=1).astype(np.float32)
    for begin in range(0, len(labels), CHUNK):
        values = kernel_features(x[begin : begin + CHUNK], projection) - centre
        sign, w = 2 * labels[begin : begin + CHUNK] - 1, weights[begin : begin + CHUNK]
        margins = (values @ both[:-1] + both[-1]).astype("float64")
        short = 1 - sign[:, None] * (margins[:, :1] + margins[:, 1:] * np.array(STEPS))
        active = np.where(short > 0, w[:, None], 0.0)
        total[:, 0] += (active * short).sum(axis=0)
        pull = -sign[:, None] * active
        total[:, 1:-1] += pull.astype(np.float32).T @ values
        total[:, -1] += pull.sum(axis=0)
    return total.ravel()


class KernelMachine(Estimator):
    """Linear machine with hinge loss on kernel features, with a one-variable logistic model turning margins into probabilities.

    The rows are kept as they are, in single precision; a pass makes the kernel features of a few rows at a time, so memory follows the
    inputs and not the wider features. Every iteration of L-BFGS is one pass, which tries several steps along its direction.
    """

    def __init__(self, kernel: str, regularisation: float, weight: str | None, seed: int, most: int = 100, tolerance: float = 1e-6):
        super().__init__()
        self.kernel, self.regularisation, self.weight, self.seed = kernel, regularisation, weight, seed
        self.most, self.tolerance = most, tolerance

    def _fit(self, dataset: DataFrame) -> KernelMachineModel:
        blocks = passes.row_blocks(dataset, FEATURES, TARGET, self.weight)
        try:
            return self._fit_blocks(blocks)
        finally:
            blocks.unpersist()

    def _fit_blocks(self, blocks) -> KernelMachineModel:
        inputs = blocks.map(lambda block: block[0].shape[1]).first()
        projection = tuple(part.astype(np.float32) for part in kernel_map(inputs, KERNEL_WIDTH, self.seed)) if self.kernel == "rbf" else None

        def moments(block: tuple) -> np.ndarray:
            x, _, w = block
            sums = 0
            for begin in range(0, len(w), CHUNK):
                values, own = kernel_features(x[begin : begin + CHUNK], projection).astype("float64"), w[begin : begin + CHUNK]
                sums = sums + np.concatenate([[own.sum()], own @ values, own @ (values * values)])
            return sums

        found = passes.summed(blocks, moments)
        total, (mean, square) = found[0], found[1:].reshape(2, -1) / found[0]
        # As in Spark's machine, the optimiser sees standardised features, and the penalty is on their coefficients.
        spread_of = np.sqrt(np.maximum(square - mean**2, 0.0))
        scale = np.where(spread_of > 1e-9 * np.maximum(np.abs(mean), 1e-9), 1 / np.where(spread_of > 0, spread_of, 1), 0.0)
        scale, centre = np.append(scale, 1.0), mean.astype(np.float32)
        penalty = np.append(np.full(len(mean), self.regularisation), 0.0)

        def along(point: np.ndarray, direction: np.ndarray) -> list[tuple[float, np.ndarray]]:
            sums = passes.summed(blocks, lambda block: hinge_sums(block, projection, centre, point * scale, direction * scale)).reshape(len(STEPS), -1) / total
            at = [point + step * direction for step in STEPS]
            return [(float(s[0] + 0.5 * (penalty * p * p).sum()), s[1:] * scale + penalty * p) for s, p in zip(sums, at)]

        solved = passes.minimise_along(along, STEPS, np.zeros(len(mean) + 1), self.most, self.tolerance) * scale
        slopes, offset = solved[:-1], float(solved[-1] - solved[:-1] @ mean)
        curve = self._calibrated(blocks, projection, slopes, offset)
        return KernelMachineModel(state=json.dumps({"inputs": inputs, "seed": self.seed if projection else None, "slopes": list(slopes), "offset": offset, "curve": list(curve)}))

    def _calibrated(self, blocks, projection, slopes: np.ndarray, offset: float) -> np.ndarray:
        """Slope and offset of the logistic curve over the margins, unweighted, by Newton's method with halved steps."""
        margins = blocks.map(lambda block: (machine_margins(block[0], projection, slopes, offset), block[1])).persist(StorageLevel.MEMORY_AND_DISK)

        def loss(curve: np.ndarray) -> np.ndarray:
            def sums(pair: tuple) -> np.ndarray:
                m, y = pair
                z = curve[0] * m + curve[1]
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                rest, bend = p - y, p * (1 - p)
                return np.array([len(y), (np.logaddexp(0, z) - y * z).sum(), rest @ m, rest.sum(), bend @ (m * m), bend @ m, bend.sum()])

            found = passes.summed(margins, sums)
            return found[1:] / found[0]

        try:
            curve, now = np.zeros(2), loss(np.zeros(2))
            for _ in range(100):
                gradient, bend = now[1:3], np.array([[now[3], now[4]], [now[4], now[5]]])
                step = np.linalg.solve(bend + 1e-12 * np.eye(2), gradient)
                for _ in range(20):
                    following = loss(curve - step)
                    if following[0] <= now[0]:
                        break
                    step /= 2
                else:
                    break
                fall, curve, now = now[0] - following[0], curve - step, following
                if fall <= 1e-6 * max(now[0], 1e-6):
                    break
            return curve
        finally:
            margins.unpersist()


def machine_margins(x: np.ndarray, projection: tuple | None, slopes: np.ndarray, offset: float) -> np.ndarray:
    parts = [kernel_features(x[begin : begin + CHUNK], projection).astype("float64") @ slopes for begin in range(0, len(x), CHUNK)]
    return np.concatenate(parts) + offset


class KernelMachineModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "coefficients and calibration as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = json.loads(self.getOrDefault("state"))
        slopes, (slope, offset) = np.array(s["slopes"]), s["curve"]

        @F.pandas_udf("double")
        def probability(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            projection = kernel_map(s["inputs"], len(slopes), s["seed"]) if s["seed"] is not None else None
            margins = machine_margins(np.stack(rows.to_numpy()), projection, slopes, s["offset"])
            return pd.Series(1 / (1 + np.exp(-np.clip(slope * margins + offset, -700, 700))))

        scored = dataset.withColumn("_p", probability(vector_to_array(F.col(FEATURES))))
        return scored.select(
            *dataset.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )


# ---- adaptive boosting -----------------------------------------------------------------------------------------------


def _stump_side(stump: dict) -> Column:
    """Prediction of a one-split tree as an expression over the feature array ``_x``."""
    if stump["feature"] is None:
        return F.lit(stump["left"])
    return F.when(F.col("_x")[stump["feature"]] <= F.lit(stump["threshold"]), stump["left"]).otherwise(stump["right"])


#: Split points of a feature that a stump may take, at most; a place among them is one byte.
STUMP_POINTS = 255


def _place_rows(points: list[np.ndarray]):
    """A batch becomes one row: the place of every value among its feature's split points, and the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(points))
                places = np.stack([np.searchsorted(p, x[:, i]).astype(np.uint8) for i, p in enumerate(points)])
                labels = batch.column(TARGET).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (places, labels)], ["places", "labels"])

    return run


def _weigh_places(width: int, stumps: list[tuple], log_total: float):
    """(cell, weight of the negatives, of the positives) of a task; a cell is a feature's number * 256 + place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width * 256))
        for batch in batches:
            for places, labels in zip(*[batch.column(c).to_pylist() for c in ("places", "labels")]):
                labels = np.frombuffer(labels, np.uint8)
                places = np.frombuffer(places, np.uint8).reshape(width, -1)
                logs = np.full(len(labels), -log_total)
                for feature, place, left, right, alpha in stumps:
                    side = np.where(places[feature] <= place, left, right) if feature is not None else left
                    logs += alpha * (side != labels)
                weights = np.exp(logs)
                for kind in (0, 1):
                    of_kind = labels == kind
                    for i in range(width):
                        sums[kind, i * 256 : i * 256 + 256] += np.bincount(places[i][of_kind], weights[of_kind], 256)
        some = np.flatnonzero(sums.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[0, some]), pa.array(sums[1, some])], ["cell", "n", "p"])

    return run


def _best_stump(weights: np.ndarray) -> tuple[int | None, int, float, float, float]:
    """(feature, place, left, right, error) of the largest fall in Gini impurity; no feature if nothing falls."""
    left = weights.cumsum(axis=2)  # class, feature, place
    whole = left[:, :1, -1:]
    right = np.maximum(whole - left, 0.0)

    def impurity(part: np.ndarray) -> np.ndarray:
        size = part.sum(axis=0)
        return np.divide(2 * part[0] * part[1], size, out=np.zeros_like(size), where=size > 0)

    total = float(whole.sum())
    after = impurity(left) + impurity(right)
    after[(left.sum(axis=0) <= 0) | (right.sum(axis=0) <= total * 1e-15)] = np.inf
    feature, place = np.unravel_index(int(after.argmin()), after.shape)
    if not after[feature, place] < float(impurity(whole).item()) * (1 - 1e-12):
        side = float(whole[1].item() > whole[0].item())
        return None, 0, side, side, float(whole.min()) / total
    own, other = left[:, feature, place], right[:, feature, place]
    return int(feature), int(place), float(own[1] > own[0]), float(other[1] > other[0]), float(own.min() + other.min()) / total


class AdaBoost(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted one-split trees (SAMME; Zhu et al., 2009).

    Split points are found once; a row is kept as one byte a feature. A round is one aggregation of the weights by feature, place and
    class, where the weights follow from the stumps so far, so no round depends on the materialised output of the one before.
    """

    rounds = Param(Params._dummy(), "rounds", "number of stumps", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rounds=50, rate=1.0, seed=42):
        super().__init__()
        self._setDefault(rounds=50, rate=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> AdaBoostModel:
        get = self.getOrDefault
        base = dataset.filter(F.col(TARGET).isNotNull()).select(vector_to_array(FEATURES).alias("_x"), TARGET)
        width = base.agg(F.max(F.size("_x"))).first()[0]
        points = split_points(base, width, STUMP_POINTS)
        blocks = base.mapInArrow(_place_rows(points), "places binary, labels binary").persist()
        stumps: list[tuple] = []
        found: list[dict] = []
        # Logarithm of the rows' weight against that of the first round: weights stay near 1 on average, so none overflows.
        log_total = 0.0
        try:
            for _ in range(get("rounds")):
                cells = blocks.mapInArrow(_weigh_places(width, stumps, log_total), "cell int, n double, p double")
                weights = np.zeros((2, width * 256))
                for r in cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect():  # 256 for each feature at most
                    weights[:, r["cell"]] = r["n"], r["p"]
                feature, place, left, right, error = _best_stump(weights.reshape(2, width, 256))
                if error >= 0.5:
                    break
                alpha = get("rate") * math.log((1 - max(error, 1e-12)) / max(error, 1e-12))
                stumps.append((feature, place, left, right, alpha))
                threshold = float(points[feature][place]) if feature is not None else 0.0
                found.append({"feature": feature, "threshold": threshold, "left": left, "right": right, "alpha": alpha})
                if error <= 0:
                    break
                log_total += math.log(1 - error + error * math.exp(alpha))
        finally:
            blocks.unpersist()
        return AdaBoostModel(state=json.dumps(found))


class AdaBoostModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "stumps as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stumps = json.loads(self.getOrDefault("state"))
        total = sum(s["alpha"] for s in stumps) or 1.0
        decision: Column = F.lit(0.0)
        for s in stumps:
            decision = decision + F.lit(s["alpha"]) * (2 * _stump_side(s) - 1)
        p = 1 / (1 + F.exp(-decision / F.lit(total)))
        scored = dataset.withColumn("_x", vector_to_array(FEATURES)).withColumn("_p", p)
        return scored.select(
            *dataset.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )


# ---- neural network --------------------------------------------------------------------------------------------------


#: Rows that go through the network at once: their values stay in the processor's cache.
CHUNK = 1000


def network_loss(layers: list[int], weights: np.ndarray, block: tuple) -> np.ndarray:
    """(sum of the cross-entropies, number of rows, gradient by the weights) of a block: logistic layers, soft-max at the end.

    Weights lie as in Spark's network: of every layer the matrix by input, then the offsets.
    """
    x, labels, _ = block
    one, parts, at = np.float32(1), [], 0
    for wide, narrow in zip(layers, layers[1:]):
        end = at + wide * narrow
        parts.append((weights[at:end].reshape(wide, narrow).astype(np.float32), weights[end : end + narrow].astype(np.float32)))
        at = end + narrow
    sums, loss = [[np.zeros(m.shape), np.zeros(o.shape)] for m, o in parts], 0.0
    for begin in range(0, len(labels), CHUNK):
        values = [x[begin : begin + CHUNK]]
        for matrix, offsets in parts[:-1]:
            z = values[-1] @ matrix
            z += offsets
            np.exp(np.negative(np.maximum(z, -80, out=z), out=z), out=z)
            z += one
            values.append(np.reciprocal(z, out=z))
        # The last layer has few columns: they are kept as rows.
        z = (parts[-1][0].T @ values[-1].T).astype("float64") + parts[-1][1][:, None]
        z -= z.max(axis=0)
        e = np.exp(z)
        total = e.sum(axis=0)
        own = labels[begin : begin + CHUNK].astype(int), np.arange(z.shape[1])
        loss += float(np.log(total).sum() - z[own].sum())
        e /= total
        e[own] -= 1.0
        delta = np.ascontiguousarray(e.T, dtype=np.float32)
        ones = np.ones(len(delta), np.float32)
        for (matrix, _), value, into in zip(reversed(parts), reversed(values), reversed(sums)):
            into[0] += value.T @ delta
            into[1] += ones @ delta
            if value is not values[0]:
                delta = delta @ matrix.T
                delta *= value
                delta *= np.subtract(one, value, out=value)
    return np.concatenate([[loss, len(labels)], *[part.ravel() for pair in sums for part in pair]])


class NeuralNetwork(Estimator):
    """Spark's multilayer perceptron, its weights found by passes of matrix products in single precision over blocks of rows.

    The start, the loss, the optimiser and its stopping rules are those of Spark's estimator, which makes the model of the weights.
    """

    def __init__(self, layers: list[int], most: int, seed: int):
        super().__init__()
        self.layers, self.most, self.seed = layers, most, seed

    def _fit(self, dataset: DataFrame) -> Model:
        layers, spark = self.layers, dataset.sparkSession
        # Without an iteration the estimator returns the weights that it starts from.
        two = spark.createDataFrame([([0.0] * layers[0], float(i)) for i in range(layers[-1])], "x array<double>, label double")
        still = MultilayerPerceptronClassifier(layers=layers, maxIter=0, seed=self.seed, featuresCol=FEATURES, labelCol=TARGET)
        shape = two.select(array_to_vector("x").alias(FEATURES), F.col("label").alias(TARGET))
        blocks = passes.row_blocks(dataset, FEATURES, TARGET)

        def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
            found = passes.summed(blocks, lambda block: network_loss(layers, weights, block))
            return found[0] / found[1], found[2:] / found[1]

        try:
            weights = passes.minimise(evaluate, still.fit(shape).weights.toArray(), self.most)
        finally:
            blocks.unpersist()
        return still.copy().setInitialWeights(Vectors.dense(weights)).fit(shape)


# ---- nearest neighbours ----------------------------------------------------------------------------------------------


class NearestNeighbours(Estimator):
    """Share of positives among the k nearest training rows; both tables need the row id column.

    The training rows are written to the shared folder, so the model outlives the frame that it was fitted on.
    """

    def __init__(self, k: int = 5, row_id: str = "event_id"):
        super().__init__()
        self.k, self.row_id = k, row_id

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        path = scratch_path(dataset.sparkSession, "neighbours")
        dataset.select(self.row_id, FEATURES, TARGET).write.parquet(path)
        return NearestNeighboursModel(train=dataset.sparkSession.read.parquet(path), k=self.k, rowId=self.row_id)


class _NeighboursWriter(MLWriter):
    """Parameters beside the training rows as Parquet."""

    def __init__(self, model: NearestNeighboursModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.train.write.parquet(f"{path}/rows")


class _NeighboursReader(MLReader):
    def load(self, path: str) -> NearestNeighboursModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NearestNeighboursModel(train=self.sparkSession.read.parquet(f"{path}/rows"))
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._resetUid(metadata["uid"])


class NearestNeighboursModel(Model, MLReadable, MLWritable):
    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    rowId = Param(Params._dummy(), "rowId", "row id column", TypeConverters.toString)

    def __init__(self, train: DataFrame, k: int = 5, rowId: str = "event_id"):
        super().__init__()
        self.train = train
        self._set(k=k, rowId=rowId)

    def write(self) -> MLWriter:
        return _NeighboursWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NeighboursReader()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        row_id = self.getOrDefault("rowId")

        def points(df: DataFrame) -> DataFrame:
            return as_points(df.select(row_id, vector_to_array(FEATURES).alias("_x")), row_id, ["_x"])

        near = knn_join(points(dataset), points(self.train), self.getOrDefault("k"))
        labels = self.train.select(F.col(row_id).alias("neighbour"), F.col(TARGET).alias("_label"))
        votes = near.join(labels, "neighbour").groupBy("id").agg(F.avg("_label").alias("_p"))
        joined = dataset.join(votes.withColumnRenamed("id", row_id), row_id, "left")
        return joined.select(
            *dataset.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )


# ---- registry --------------------------------------------------------------------------------------------------------

# Default hyper-parameters per model.
DEFAULTS: dict[str, dict] = {
    "logistic": {"max_iter": 1000, "C": 1.0, "l1_ratio": 0.0},
    "decision_tree": {"max_depth": 20, "min_samples_leaf": 1, "criterion": "gini"},
    "random_forest": {"n_estimators": 100, "max_depth": 20, "min_samples_leaf": 2},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1},
    "xgboost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 3, "scale_pos_weight": 100},
    "lightgbm": {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_samples": 20, "scale_pos_weight": 100},
    "catboost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample_bytree": 1.0, "min_child_weight": 1},
    "svm": {"C": 1.0, "kernel": "rbf"},
    "adaboost": {"n_estimators": 50, "learning_rate": 1.0},
    "mlp": {"hidden_layer_sizes": (100, 50), "max_iter": 200, "alpha": 0.0001},
    "knn": {"n_neighbors": 5},
    "naive_bayes": {},
}
# How the positive class is weighted in training: "balanced" class weights, or a positive weight.
WEIGHTING = {
    "logistic": "balanced",
    "decision_tree": "balanced",
    "random_forest": "balanced",
    "svm": "balanced",
    "lightgbm": "positive",
    "xgboost": "positive",
    "catboost": "positive",
}


#: Models whose first rounds are themselves the fit of fewer rounds.
BOOSTED = ("gradient_boosting", "xgboost", "lightgbm", "catboost")


def model_names() -> list[str]:
    return list(DEFAULTS)


def parameters(name: str, overrides: dict | None = None) -> dict:
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name!r}, choose one of {model_names()}")
    return {**DEFAULTS[name], **(overrides or {})}


def boost_settings(p: dict, seed: int, positive: float = 1.0) -> Boost:
    depth = p.get("max_depth") or max(1, math.ceil(math.log2(p.get("num_leaves", 31))))
    smallest = int(p.get("min_child_weight", p.get("min_child_samples", 1)))
    return Boost(p["n_estimators"], depth, p["learning_rate"], p["subsample"], p["colsample_bytree"], smallest, seed, positive)


def build_classifier(
    name: str,
    overrides: dict | None = None,
    inputs: int | None = None,
    weight_col: str | None = None,
    seed: int = 42,
    row_id: str = "event_id",
    total: float = 1000.0,
) -> Estimator:
    """Estimator over ``features`` and ``label``. ``inputs`` (number of features) is needed by the neural network.

    ``total`` is the sum of the row weights: the loss is averaged here, so a penalty C stands for 1 / (C x total).
    """
    p = parameters(name, overrides)
    weight = {"weightCol": weight_col} if weight_col else {}
    common = {"featuresCol": FEATURES, "labelCol": TARGET, **weight}
    if name == "logistic":
        penalty = {} if p["C"] is None else {"regParam": 1.0 / (p["C"] * total), "elasticNetParam": float(p["l1_ratio"])}
        return LogisticRegression(maxIter=p["max_iter"], **penalty, **common)
    if name == "decision_tree":
        return DecisionTreeClassifier(maxDepth=p["max_depth"], minInstancesPerNode=p["min_samples_leaf"], impurity=p["criterion"], seed=seed, **common)
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=p["n_estimators"], maxDepth=p["max_depth"], minInstancesPerNode=p["min_samples_leaf"], maxMemoryInMB=1024, seed=seed, **common
        )
    if name in BOOSTED:
        return BoostedTreesClassifier(boost_settings(p, seed), FEATURES, TARGET, weight_col, row_id)
    if name == "svm":
        return KernelMachine(p["kernel"], 1.0 / (p["C"] * total), weight_col, seed)
    if name == "adaboost":
        return AdaBoost(rounds=p["n_estimators"], rate=float(p["learning_rate"]), seed=seed)
    if name == "mlp":
        if inputs is None:
            raise ValueError("the neural network needs the number of inputs")
        layers = [inputs, *p["hidden_layer_sizes"], 2]
        return NeuralNetwork(layers, p["max_iter"], seed)
    if name == "knn":
        return NearestNeighbours(p["n_neighbors"], row_id)
    return NaiveBayes(modelType="gaussian", **common)


def first_trees(model: BoostedTrees, trees: int) -> BoostedTrees:
    """The model after its first ``trees`` rounds, equal to a fit of that many rounds with the other settings unchanged."""
    return model.first(trees)


def model_info(name: str, model: Model, features: list[str]) -> dict:
    core = model.stages[-1] if hasattr(model, "stages") else model
    return {"model": name, "class_name": type(core).__name__, "n_features": len(features), "has_importances": hasattr(core, "featureImportances")}
