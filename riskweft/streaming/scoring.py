"""Streaming validation and scoring: the batch functions applied to each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.operators.scoring import response_records, score_requests
from riskweft.operators.training import Trained
from riskweft.operators.validation import cast_schema, split_valid
from riskweft.streaming.runner import BatchHandler, write_batch


def scoring_handler(trained: Trained, scored_out: str, quarantine_out: str, threshold: float = 0.5) -> BatchHandler:
    """Scored valid requests to one table, rejected requests with their reason to another."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            scored, rejected = score_requests(batch, trained, threshold)
            write_batch(scored, scored_out, batch_id)
            write_batch(rejected, quarantine_out, batch_id)
        finally:
            batch.unpersist()

    return handle


def validation_handler(valid_out: str, quarantine_out: str) -> BatchHandler:
    """Typed valid requests to one table, rejected requests with their reason to another."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            valid, rejected = split_valid(batch)
            write_batch(cast_schema(valid), valid_out, batch_id)
            write_batch(rejected, quarantine_out, batch_id)
        finally:
            batch.unpersist()

    return handle


def response_stream(scored: DataFrame, probability: str, row_id: str = "event_id", threshold: float = 0.5) -> DataFrame:
    """Response records of the scored rows of a stream; stateless, so any streaming sink takes it as it is.

    The rows without a probability are those of ``unscored_stream``.
    """
    return response_records(scored.filter(F.col(probability).isNotNull()), probability, row_id, threshold)


def unscored_stream(scored: DataFrame, probability: str) -> DataFrame:
    """The rows that got no probability, with the reason, for the quarantine."""
    return scored.filter(F.col(probability).isNull()).withColumn("error", F.lit(f"{probability} is missing"))


def response_handler(probability: str, out: str, quarantine_out: str, row_id: str = "event_id", threshold: float = 0.5) -> BatchHandler:
    """Response records to one table, rows without a probability with the reason to another: no row is lost."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_batch(response_stream(batch, probability, row_id, threshold), out, batch_id)
            write_batch(unscored_stream(batch, probability), quarantine_out, batch_id)
        finally:
            batch.unpersist()

    return handle
