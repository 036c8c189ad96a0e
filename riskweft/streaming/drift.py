"""Drift of every micro-batch against a stored reference.

The handler reads the stored distribution, never the reference's rows; a batch meets the buckets of its own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskweft.operators.reference import StoredReference
from riskweft.streaming.runner import BatchHandler, write_batch

DRIFT_SCHEMA = "feature string, n_reference bigint, n_current bigint, statistic double, p_value double, drifted int"


def drift_handler(path: str, out: str) -> BatchHandler:
    """Tests each batch against the reference stored at ``path``."""
    held: list[StoredReference] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not held:
            held.append(StoredReference(batch.sparkSession, path))
        batch = batch.select(*[c for c in held[0].boundaries if c in batch.columns]).persist()
        try:
            write_batch(held[0].report(batch), out, batch_id)
        finally:
            batch.unpersist()

    return handle
