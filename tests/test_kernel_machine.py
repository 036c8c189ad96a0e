"""The kernel machine fitted by passes over the rows' own values: its gradient, and its loss against Spark's machine."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskweft.operators import models, passes


@pytest.fixture(scope="module")
def ring(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 3)) * [1.0, 5.0, 0.2]
    y = ((x[:, 0] ** 2 + x[:, 1] / 5 > 0.6) ^ (rng.random(1500) < 0.05)).astype(float)
    rows = [(list(map(float, r)), float(k), 1.0 + i % 3) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x array<double>, label double, weight double").repartition(4)
    return x, y, df.select(array_to_vector("x").alias("features"), "label", "weight").cache()


def test_gradient_of_the_hinge_is_its_slope():
    rng = np.random.default_rng(1)
    block = rng.normal(size=(1200, 3)).astype(np.float32), (rng.random(1200) < 0.3).astype(float), 1 + rng.random(1200)
    projection, centre = models.kernel_map(3, 5, 1), np.zeros(5, np.float32)
    point, direction = rng.normal(size=6), rng.normal(size=6)
    found = models.hinge_sums(block, projection, centre, point, direction).reshape(len(models.STEPS), -1)
    for step, sums in zip(models.STEPS, found):
        at, zero = point + step * direction, np.zeros(6)
        assert models.hinge_sums(block, projection, centre, at, zero)[: 7] == pytest.approx(sums, rel=1e-3, abs=1e-1)
        for i in range(6):
            move = np.eye(6)[i] * 1e-3
            slope = (models.hinge_sums(block, projection, centre, at + move, zero)[0] - models.hinge_sums(block, projection, centre, at - move, zero)[0]) / 2e-3
            assert slope == pytest.approx(sums[i + 1], rel=2e-2, abs=3)


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_as_good_as_sparks_machine_on_narrow_blocks(spark, ring, kernel, monkeypatch):
    x, y, df = ring
    widths, calls = [], []
    summed = passes.summed
    monkeypatch.setattr(passes, "summed", lambda blocks, part: calls.append(1) or summed(blocks, part))
    kept = passes.row_blocks
    monkeypatch.setattr(passes, "row_blocks", lambda *a: widths.append(1) or kept(*a))
    machine = models.build_classifier("svm", {"kernel": kernel}, inputs=3, weight_col="weight", total=3000.0).fit(df)
    state = models.json.loads(machine.getOrDefault("state"))
    projection = models.kernel_map(3, models.KERNEL_WIDTH, 42) if kernel == "rbf" else None
    assert state["inputs"] == 3 and len(widths) == 1 and len(calls) < 350
    wide, w = models.kernel_features(x, projection), 1.0 + np.arange(1500) % 3
    table = spark.createDataFrame([(list(map(float, r)), float(k), float(v)) for r, k, v in zip(wide, y, w)], "x array<double>, label double, weight double")
    other = LinearSVC(regParam=1 / 3000, maxIter=100, weightCol="weight").fit(table.select(array_to_vector("x").alias("features"), "label", "weight"))

    def loss(slopes, offset):
        centre, scale = wide.T @ w / w.sum(), wide.std(axis=0)
        short = np.maximum(1 - (2 * y - 1) * (wide @ slopes + offset), 0)
        return (w @ short) / w.sum() + 0.5 / 3000 * ((slopes * scale) ** 2).sum() + 0 * centre.sum()

    assert loss(np.array(state["slopes"]), state["offset"]) < loss(other.coefficients.toArray(), other.intercept) * 1.02
    p = machine.transform(df).agg(F.avg(F.abs(vector_to_array("probability")[1] - F.col("label")))).first()[0]
    assert p < (0.2 if kernel == "rbf" else 0.5)
