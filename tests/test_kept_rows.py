"""What a fit keeps on the executors while the estimator keeps its own copy of the feature vectors."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from riskweft.operators import training
from riskweft.schema import REQUIRED_COLUMNS


@pytest.mark.parametrize("name,kind,overrides", [("logistic", LogisticRegression, {"max_iter": 3}), ("decision_tree", DecisionTreeClassifier, {"max_depth": 2})])
def test_feature_vectors_are_not_kept_twice(spark, txn, monkeypatch, name, kind, overrides):
    df = txn.select("event_id", *REQUIRED_COLUMNS)
    before, seen = spark.sparkContext._jsc.getPersistentRDDs().size(), []
    fit = kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, frame: seen.append((frame.storageLevel.useMemory, spark.sparkContext._jsc.getPersistentRDDs().size())) or fit(self, frame))
    first = training.train(df, name, overrides=overrides)
    again = training.train(df, name, overrides=overrides, preprocessor=first.preprocessor)
    assert seen == [(False, before + 1)] * 2  # the input rows alone
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    both = again.score(first.score(df, "x"), "y")
    assert both.filter(F.abs(F.col("x") - F.col("y")) > 1e-9).count() == 0
