"""Boosted trees that grow within tasks: as in passes, and beyond the bounds in passes."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from riskweft.operators import boosting


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([np.round(rng.normal(size=(1500, 2)), 2), rng.integers(0, 2, (1500, 9)), rng.integers(0, 7, (1500, 1)), np.ones((1500, 1))], axis=1)
    y = (x[:, 0] + x[:, 2] * x[:, 11] + rng.normal(size=1500) > 2).astype(float)
    table = [(i, list(map(float, r)), float(k), 1.0 + i % 2) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(table, "event_id long, x array<double>, label double, weight double").repartition(3)
    return df.select("event_id", array_to_vector("x").alias("features"), "label", "weight").cache()


BOOSTS = [boosting.Boost(4, 4, 0.3, 0.8, 0.7, 3, 42, 9.5), boosting.Boost(2, 2, 0.1), boosting.Boost(3, 6, 0.2, smallest=2)]


def no_passes(*args):
    raise AssertionError("a pass over few rows")


@pytest.mark.parametrize("weight", [None, "weight"])
def test_tasks_and_passes_grow_the_same_trees(rows, monkeypatch, weight):
    monkeypatch.setattr(boosting, "BUNDLE_ROWS", 0)
    with monkeypatch.context() as m:
        m.setattr(boosting.passes, "summed", no_passes)
        tasks = boosting.boost_together(rows, BOOSTS, "features", "label", weight, ["event_id"])
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    monkeypatch.setattr(boosting, "BUNDLE_ROWS", 10**9)
    passes = boosting.boost_together(rows, BOOSTS, "features", "label", weight, ["event_id"])
    for boost, one, other in zip(BOOSTS, tasks, passes):
        a, b = one.fitted(), other.fitted()
        assert one.getNumTrees == other.getNumTrees == boost.rounds
        assert [(t["feature"], t["threshold"], t["left"]) for t in a["trees"]] == [(t["feature"], t["threshold"], t["left"]) for t in b["trees"]]
        for s, t in zip(a["trees"], b["trees"]):
            assert s["value"] == pytest.approx(t["value"], abs=1e-9)
        assert a["importances"] == pytest.approx(b["importances"])


def test_bundles_keep_every_place():
    sizes = [32, 2, 2, 7, 1, 2, 24, 2, 32]
    layout = boosting.layout_of(tuple(sizes))
    rng = np.random.default_rng(1)
    codes = np.stack([rng.integers(0, size, 500).astype(np.uint8) for size in sizes])
    whole = layout.with_bundles(codes)
    assert len(layout.bundled) < len(sizes) and len(whole) == len(sizes) + len(layout.bundles)
    found = np.zeros(sum(sizes))
    for column in layout.bundled:
        counts = np.bincount(whole[column.row], minlength=column.size).astype(float)
        found[column.cells] = counts if column.sums is None else counts @ column.sums
    assert found.tolist() == np.concatenate([np.bincount(c, minlength=s) for c, s in zip(codes, sizes)]).tolist()


def test_tasks_are_dealt_and_states_are_whole(rows, monkeypatch):
    monkeypatch.setattr(boosting, "TASKS_PER_SLOT", 1)
    found = boosting.boost_together(rows, BOOSTS * 4, "features", "label", None, ["event_id"], fits=8)
    assert [m.getNumTrees for m in found] == [b.rounds for b in BOOSTS * 4]
    assert all(json.loads(m.getOrDefault("state"))["width"] == 13 for m in found)
