"""Boosted stumps: one aggregation a round, equal to a plain version."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskweft.operators import models


def plain(x: np.ndarray, y: np.ndarray, rounds: int) -> list[tuple]:
    """(feature, threshold, left, right, alpha) with every value as a split point."""
    w, found = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for t in np.unique(x[:, f])[:-1]:
                parts = [[w[side & (y == k)].sum() for k in (0, 1)] for side in (x[:, f] <= t, x[:, f] > t)]
                after = sum(2 * a * b / (a + b) for a, b in parts)
                if best is None or after < best[0] - 1e-9:
                    best = after, f, t, *[float(b > a) for a, b in parts], sum(map(min, parts)) / w.sum()
        _, f, t, left, right, error = best
        alpha = math.log((1 - error) / error)
        found.append((f, t, left, right, alpha))
        w = w * np.exp(alpha * (np.where(x[:, f] <= t, left, right) != y))
    return found


def test_stumps_equal_plain_version_without_a_tree_fit_a_round(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 9, 900), rng.integers(0, 40, 900), rng.random(900) < 0.02], axis=1).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] < 9) | (x[:, 2] > 0) ^ (rng.random(900) < 0.1)).astype(float)
    rows = [(list(map(float, r)), float(k)) for r, k in zip(x, y)]
    df = spark.createDataFrame(rows, "x array<double>, label double").repartition(3).select(array_to_vector("x").alias("features"), "label")

    def refuse(*args, **kw):
        raise AssertionError("a tree is fitted")

    monkeypatch.setattr(models, "DecisionTreeClassifier", refuse)
    model = models.AdaBoost(rounds=6).fit(df)
    stumps = json.loads(model.getOrDefault("state"))
    wanted = plain(x, y, 6)
    assert [(s["feature"], s["threshold"], s["left"], s["right"]) for s in stumps] == [w[:4] for w in wanted]
    assert np.allclose([s["alpha"] for s in stumps], [w[4] for w in wanted])
    votes = sum(a * (2 * np.where(x[:, f] <= t, left, right) - 1) for f, t, left, right, a in wanted)
    assert model.transform(df).agg(F.sum("prediction")).first()[0] == (votes > 0).sum()


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([([1.0, 2.0], 0.0)] * 20, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    model = models.AdaBoost(rounds=3).fit(df)
    assert model.transform(df).agg(F.max("prediction")).first()[0] == 0.0
