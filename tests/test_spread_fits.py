"""Fits over inputs of few partitions, shared sketches, and fits side by side."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from riskweft.operators import ensembles, order_stats, selection, training, tuning
from riskweft.operators.preprocess import Preprocessor
from riskweft.schema import REQUIRED_COLUMNS


def test_neighbouring_ranks_share_one_sketch(spark, monkeypatch):
    asked = []
    sketch = F.percentile_approx
    monkeypatch.setattr(order_stats.F, "percentile_approx", lambda *a: asked.append(1) or sketch(*a))
    rng = np.random.default_rng(5)
    columns = {"a": rng.normal(size=4000), "b": rng.integers(0, 2, 4000).astype(float), "c": rng.integers(0, 900, 4000).astype(float)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], "a double, b double, c double")
    found = order_stats.exact_quantiles(df, list(columns), [0.25, 0.5, 0.75], sort_limit=2000)[None]
    assert len(asked) == 3  # one for each column, not one for each of its six ranks
    for c, values in columns.items():
        assert np.allclose(found[c], np.quantile(values, [0.25, 0.5, 0.75]), rtol=0, atol=1e-12)


def test_fits_deal_an_input_of_one_partition_to_all_slots(spark, txn, monkeypatch):
    """The passes of preprocessing and of forests see even partitions."""
    whole = txn.select("event_id", *REQUIRED_COLUMNS)
    one = whole.coalesce(1)
    seen = []
    fit = Preprocessor._fit
    monkeypatch.setattr(Preprocessor, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    training.train(one, "naive_bayes")
    tuning.cross_validate(one, "naive_bayes", folds=2)
    tuning.search(one, "naive_bayes", [{}], folds=2)
    ensembles.bagging(one, "decision_tree", members=2, overrides={"max_depth": 2})
    assert len(seen) == 6 and min(seen) >= spark.sparkContext.defaultParallelism
    frames = []
    forest = selection.RandomForestClassifier.fit
    monkeypatch.setattr(selection.RandomForestClassifier, "fit", lambda self, df: frames.append(df.rdd.getNumPartitions()) or forest(self, df))
    selection.eliminate_features(one, ["amount", "oldbalanceOrg", "step"], "isFraud", 2, trees=2, depth=2)
    assert min(frames) >= spark.sparkContext.defaultParallelism


def test_large_tables_are_fitted_one_after_another(spark):
    assert training.side_by_side(spark, 1000) == training.MOST_FITS
    assert training.side_by_side(spark, training.SIDE_ROWS) == 1
    assert training.side_by_side(spark, 100 * training.SIDE_ROWS) == 1


def test_models_fitted_together_equal_single_fits(spark, txn):
    df = txn.select("event_id", *REQUIRED_COLUMNS)
    together = ensembles.train_models(df, ["naive_bayes", "decision_tree"], {"decision_tree": {"max_depth": 3}})
    alone = training.train(df, "decision_tree", overrides={"max_depth": 3})
    both = alone.score(together["decision_tree"].score(df, "x"), "y")
    assert both.filter(F.abs(F.col("x") - F.col("y")) > 1e-9).count() == 0
