"""Feature elimination leaves the memory of the executors to its forests."""

from __future__ import annotations

from pyspark import StorageLevel

from riskweft.operators import selection


def test_elimination_leaves_memory_to_the_forest(spark, txn, monkeypatch):
    levels = []
    keep = type(txn).persist
    monkeypatch.setattr(type(txn), "persist", lambda self, level=StorageLevel.MEMORY_AND_DISK: levels.append(level) or keep(self, level))
    kept, dropped = selection.eliminate_features(txn, ["amount", "oldbalanceOrg", "step"], "isFraud", 2, trees=2, depth=2)
    assert len(kept) == 2 and len(dropped) == 1 and [level.useMemory for level in levels] == [False]
