"""Boosted trees grown in passes over blocks: equal to a plain version, alike to Spark's, and the same alone and together."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskweft.operators import boosting, models


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = np.stack([rng.integers(0, 12, 900), rng.integers(0, 9, 900), rng.random(900) < 0.2], axis=1).astype(float)
    y = ((x[:, 0] * (1 + x[:, 2]) + x[:, 1] > 11) ^ (rng.random(900) < 0.1)).astype(float)
    rows = [(i, list(map(float, r)), float(k), 1.0 + i % 3) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "event_id long, x array<double>, label double, weight double").repartition(5)
    return x, y, df.select("event_id", array_to_vector("x").alias("features"), "label", "weight").cache()


def plain(x, y, w, boost):
    """Margins of boosted trees that are grown by trying every split of every node."""

    def tree(rows, rest, depth):
        value = (w[rows] * rest[rows]).sum() / w[rows].sum()
        best = None
        for f in range(x.shape[1]) if depth else []:
            for t in np.unique(x[rows, f])[:-1]:
                sides = [rows[x[rows, f] <= t], rows[x[rows, f] > t]]
                if min(map(len, sides)) >= boost.smallest:
                    gain = sum((w[s] * rest[s]).sum() ** 2 / w[s].sum() for s in sides) - value**2 * w[rows].sum()
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, sides
        if best is None:
            return [(rows, value)]
        return [leaf for side in best[1] for leaf in tree(side, rest, depth - 1)]

    sign, margins = 2 * y - 1, np.zeros(len(y))
    for turn in range(boost.rounds):
        rest = sign if turn == 0 else 4 * sign / (1 + np.exp(2 * sign * margins))
        for rows, value in tree(np.arange(len(y)), rest, boost.depth):
            margins[rows] += value * (boost.rate if turn else 1.0)
    return margins


def found(model, df):
    rows = model.transform(df).select("event_id", vector_to_array("probability")[1].alias("p")).orderBy("event_id").collect()
    return np.array([r["p"] for r in rows])


@pytest.mark.parametrize("bytes_", [boosting.PASS_BYTES, 1])
def test_trees_equal_plain_version(data, monkeypatch, bytes_):
    monkeypatch.setattr(boosting, "PASS_BYTES", bytes_)
    monkeypatch.setattr(boosting, "WRITTEN_ROUNDS", 2)
    x, y, df = data
    boosts = [boosting.Boost(5, 3, 0.3, smallest=4), boosting.Boost(3, 2, 0.1, positive=5.0)]
    together = boosting.boost_together(df, boosts, "features", "label", "weight", ["event_id"])
    for boost, model in zip(boosts, together):
        w = (1.0 + np.arange(900) % 3) * np.where(y > 0, boost.positive, 1.0)
        assert found(model, df) == pytest.approx(1 / (1 + np.exp(-2 * plain(x, y, w, boost))), abs=1e-9)
        assert model.getNumTrees == boost.rounds and model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_samples_do_not_depend_on_partitions_and_company(data):
    _, y, df = data
    boosts = [boosting.Boost(4, 3, 0.3, 0.7, 0.6), boosting.Boost(6, 4, 0.2, 0.9)]
    together = boosting.boost_together(df, boosts, "features", "label", None, ["event_id"])
    alone = boosting.boost_together(df.repartition(2), boosts[:1], "features", "label", None, ["event_id"])[0]
    assert found(together[0], df) == pytest.approx(found(alone, df), abs=1e-9)


def test_as_good_as_sparks_trees(data):
    _, y, df = data
    own = models.build_classifier("gradient_boosting", {"n_estimators": 10}).fit(df)
    other = GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, stepSize=0.1, maxDepth=3, seed=42).fit(df)
    assert found(own, df) == pytest.approx(found(other, df), abs=0.02)


def test_one_class_and_missing_labels(spark):
    rows = [(i, [float(i % 5), 1.0], None if i % 7 == 0 else 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, x array<double>, label double").select("event_id", array_to_vector("x").alias("features"), "label")
    model = models.build_classifier("xgboost", {"n_estimators": 3}).fit(df)
    assert model.transform(df).agg(F.max("prediction")).first()[0] == 0.0
