"""Preprocessing of all folds from shared passes."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.operators import order_stats
from riskweft.operators.preprocess import Preprocessor
from riskweft.operators.splits import stratified_folds
from riskweft.schema import REQUIRED_COLUMNS


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(a), float(b) if b > 0.1 else None, float(c), float(100 * (g == 1) + a)) for g, a, b, c in zip(rng.integers(0, 3, 3000), rng.normal(size=3000), rng.random(3000), rng.integers(0, 2, 3000))]
    return rows, spark.createDataFrame(rows, "fold int, a double, b double, c double, moved double").repartition(4).cache()


@pytest.mark.parametrize("limit", [order_stats.SORT_LIMIT, 8])
def test_medians_of_what_is_left(folded, limit):
    """``moved`` has its medians far from that of all rows; with a small limit every part is searched alone."""
    rows, df = folded
    found = order_stats.left_out_medians(df, ["a", "b", "c", "moved"], "fold", limit)
    assert set(found) == {None, 0, 1, 2}
    for fold, medians in found.items():
        for i, c in enumerate(["a", "b", "c", "moved"], 1):
            values = [r[i] for r in rows if r[0] != fold and r[i] is not None]
            assert medians[c] == pytest.approx(float(np.median(values)), abs=1e-12)


def test_columns_without_values(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, None, 2.0), (1, None, 4.0)], "fold int, empty double, x double")
    assert order_stats.left_out_medians(df, ["empty", "x"], "fold") == {
        None: {"empty": None, "x": 2.0}, 0: {"empty": None, "x": 3.0}, 1: {"empty": None, "x": 1.0}
    }


def test_fits_of_all_folds_equal_single_fits_and_share_the_sketches(spark, txn, monkeypatch):
    df = stratified_folds(txn.select("event_id", *REQUIRED_COLUMNS), 3).cache()
    asked = []
    sketch = F.percentile_approx
    monkeypatch.setattr(order_stats.F, "percentile_approx", lambda *a: asked.append(1) or sketch(*a))
    found = Preprocessor().fit_left_out(df, "fold", 4)
    assert len(asked) == len(found[None].fitted()["numeric"])  # one for each column, not one for each of its folds
    for fold, model in found.items():
        kept = df if fold is None else df.filter(F.col("fold") != fold)
        alone, own = Preprocessor().fit(kept.drop("fold")).fitted(), model.fitted()
        for c in alone["numeric"]:
            assert own["scaling"].pop(c) == pytest.approx(alone["scaling"].pop(c), rel=1e-9)
        assert json.dumps(own) == json.dumps(alone)
