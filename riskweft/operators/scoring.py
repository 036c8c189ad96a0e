"""Scoring records: decisions, response records, confidence bands and score analysis."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.operators.models import FEATURES
from riskweft.operators.profile import describe
from riskweft.operators.training import Trained
from riskweft.operators.validation import cast_schema, split_valid

HIGH_RISK = 0.8


def score_batch(df: DataFrame, trained: Trained, threshold: float = 0.5) -> DataFrame:
    """Input columns, ``predicted_fraud`` (the model's own decision), ``fraud_probability`` and ``is_fraud`` (p >= threshold)."""
    prepared = trained.preprocessor.transform(df)
    scored = trained.model.transform(prepared)
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("predicted_fraud"),
        vector_to_array("probability")[1].alias("fraud_probability"),
    ).withColumn("is_fraud", (F.col("fraud_probability") >= threshold).cast("int"))


def score_both_classes(df: DataFrame, trained: Trained) -> DataFrame:
    """Input columns with both class probabilities, the decision and the larger probability as confidence."""
    scored = trained.model.transform(trained.preprocessor.transform(df)).drop(FEATURES)
    both = vector_to_array("probability")
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        both[1].alias("fraud_probability"),
        both[0].alias("legitimate_probability"),
        F.greatest(both[0], both[1]).alias("confidence"),
    ).withColumn("is_fraud", (F.col("prediction") == 1).cast("int"))


def two_level_confidence(p: Column) -> Column:
    return F.when((p > 0.8) | (p < 0.2), "high").otherwise("medium")


def five_level_confidence(p: Column) -> Column:
    bands = F.when(p > 0.8, "high_fraud").when(p > 0.6, "medium_fraud").when(p > 0.4, "low_confidence")
    return bands.when(p > 0.2, "medium_legitimate").otherwise("high_legitimate")


def response_records(df: DataFrame, probability: str, row_id: str = "event_id", threshold: float = 0.5) -> DataFrame:
    """(row id, transaction_id, is_fraud, fraud_probability, confidence); the transaction id is the clock step."""
    p = F.col(probability)
    return df.select(
        row_id,
        F.col("step").alias("transaction_id"),
        (p >= threshold).cast("int").alias("is_fraud"),
        p.alias("fraud_probability"),
        two_level_confidence(p).alias("confidence"),
    )


def response_json(records: DataFrame, row_id: str = "event_id") -> DataFrame:
    """(row id, response) with the record as JSON text."""
    fields = [c for c in records.columns if c != row_id]
    return records.select(row_id, F.to_json(F.struct(*fields)).alias("response"))


def banded_records(df: DataFrame, probability: str, row_id: str = "event_id", threshold: float = 0.5) -> DataFrame:
    """(row id, prediction, fraud_probability, is_fraud, confidence in five bands, threshold_used)."""
    p = F.col(probability)
    return df.select(
        row_id,
        (p > 0.5).cast("int").alias("prediction"),
        p.alias("fraud_probability"),
        (p >= threshold).cast("int").alias("is_fraud"),
        five_level_confidence(p).alias("confidence"),
        F.lit(float(threshold)).alias("threshold_used"),
    )


def analyze_scores(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    """One row: rows, flagged rows and rate in percent, high-risk rows."""
    flagged = F.col(probability) >= threshold
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(flagged).alias("flagged"),
        (F.avg(flagged.cast("double")) * F.lit(100.0)).alias("flagged_pct"),
        F.count_if(F.col(probability) > HIGH_RISK).alias("high_risk"),
    )


def describe_high_risk(df: DataFrame, probability: str, columns: list[str]) -> DataFrame:
    """Describe the columns over the rows above the high-risk limit."""
    return describe(df.filter(F.col(probability) > HIGH_RISK), columns)


def score_requests(df: DataFrame, trained: Trained, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests, quarantine): the whole request path, for batches and streams alike."""
    valid, rejected = split_valid(df)
    return score_batch(cast_schema(valid), trained, threshold), rejected
