"""Fits as passes over blocks of rows: the network's loss and its optimiser against plain versions and Spark's own estimator."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskweft.operators import models, passes


@pytest.fixture(scope="module")
def ring(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = ((x[:, 0] ** 2 + x[:, 1] > 0.6) ^ (rng.random(1500) < 0.05)).astype(float)
    rows = [(list(map(float, r)), float(k)) for r, k in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, label double").repartition(4).select(array_to_vector("x").alias("features"), "label").cache()


def test_gradient_of_the_network_is_its_slope():
    rng = np.random.default_rng(1)
    layers = [3, 4, 3, 2]
    size = sum(a * b + b for a, b in zip(layers, layers[1:]))
    weights, block = rng.normal(size=size), (rng.normal(size=(1200, 3)).astype(np.float32), (rng.random(1200) < 0.3).astype(float), None)
    found = models.network_loss(layers, weights, block)
    assert found[1] == 1200 and len(found) == size + 2
    for i in range(size):
        up, down = weights.copy(), weights.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        slope = (models.network_loss(layers, up, block)[0] - models.network_loss(layers, down, block)[0]) / 2e-2
        assert slope == pytest.approx(found[2 + i], rel=1e-2, abs=5e-2)


def test_network_fits_as_sparks_estimator(ring):
    def loss(model):
        p = vector_to_array("probability")
        return model.transform(ring).agg(F.avg(-F.log(F.when(F.col("label") == 1, p[1]).otherwise(p[0])))).first()[0]

    own = models.build_classifier("mlp", {"hidden_layer_sizes": (6, 4), "max_iter": 60}, inputs=3).fit(ring)
    spark_own = MultilayerPerceptronClassifier(layers=[3, 6, 4, 2], maxIter=60, seed=42, featuresCol="features", labelCol="label").fit(ring)
    assert type(own) is type(spark_own) and loss(own) < loss(spark_own) + 0.02
    start = models.build_classifier("mlp", {"hidden_layer_sizes": (6, 4), "max_iter": 0}, inputs=3).fit(ring)
    # Spark's single step and this one leave the same weights.
    one = models.build_classifier("mlp", {"hidden_layer_sizes": (6, 4), "max_iter": 1}, inputs=3).fit(ring)
    other = MultilayerPerceptronClassifier(layers=[3, 6, 4, 2], maxIter=1, seed=42, featuresCol="features", labelCol="label").fit(ring)
    assert np.allclose(one.weights.toArray(), other.weights.toArray(), atol=1e-3) and not np.allclose(one.weights.toArray(), start.weights.toArray(), atol=1e-2)


def test_minimum_of_a_bent_valley():
    calls = []

    def valley(x):
        calls.append(1)
        return (1 - x[0]) ** 2 + 100 * (x[1] - x[0] ** 2) ** 2, np.array([-2 * (1 - x[0]) - 400 * x[0] * (x[1] - x[0] ** 2), 200 * (x[1] - x[0] ** 2)])

    assert np.allclose(passes.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-12), 1.0, atol=1e-3) and len(calls) < 100
