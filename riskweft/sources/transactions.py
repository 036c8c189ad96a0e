"""Views over the driver tables, with the same view as text for the SQL check.

``txn`` is the typed transaction table, ``txn_gaps`` the same rows with nulls, negatives and infinities,
``txn_text`` the same rows as untyped text with defects. The three are pure projections of ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK_WORDS = {
    "STEP": "timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)",
    "STR": "STRING",
    "INF": "double('Infinity')",
}
_DUCK_WORDS = {
    "STEP": "date_diff('hour', TIMESTAMP '2024-01-01', ts)",
    "STR": "VARCHAR",
    "INF": "CAST('Infinity' AS DOUBLE)",
}

_TXN = """
SELECT *,
  greatest(oldbalanceOrg - amount, 0.0e0) AS newbalanceOrig,
  oldbalanceDest + amount AS newbalanceDest,
  CASE WHEN type = 'TRANSFER' AND amount > 100000 AND oldbalanceOrg > 0 THEN 1 ELSE 0 END AS isFraud,
  CASE WHEN type = 'TRANSFER' AND amount > 200000 THEN 1 ELSE 0 END AS isFlaggedFraud,
  least(1.0e0, floor(amount / 2500.0e0) / 100.0e0) AS score
FROM (
  SELECT event_id, ts, {STEP} AS step,
    CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'CASH_IN'
                    WHEN 'signup' THEN 'DEBIT' ELSE 'TRANSFER' END AS type,
    value * 1000.0e0 AS amount,
    concat('C', CAST(user_id AS {STR})) AS nameOrig,
    concat(CASE WHEN event_id % 3 = 0 THEN 'M' ELSE 'C' END, CAST(event_id % 97 AS {STR})) AS nameDest,
    CASE WHEN event_id % 5 = 0 THEN 0.0e0 ELSE (event_id % 1000) * 500.0e0 END AS oldbalanceOrg,
    CASE WHEN event_id % 4 = 0 THEN 0.0e0 ELSE (event_id % 700) * 300.0e0 END AS oldbalanceDest
  FROM {EVENTS}
) b
"""

_TXN_GAPS = """
SELECT event_id, step,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE type END AS type,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 53 = 0 THEN -amount ELSE amount END AS amount,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE nameOrig END AS nameOrig,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 83 = 0 THEN {INF} ELSE oldbalanceOrg END AS oldbalanceOrg,
  newbalanceOrig,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE nameDest END AS nameDest,
  oldbalanceDest,
  CASE WHEN event_id % 71 = 0 THEN -newbalanceDest ELSE newbalanceDest END AS newbalanceDest,
  isFraud, isFlaggedFraud
FROM ({TXN}) t
"""

_TXN_TEXT = """
SELECT event_id,
  CASE WHEN event_id % 67 = 0 THEN 'soon' ELSE CAST(step AS {STR}) END AS step,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE type END AS type,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 47 = 0 THEN 'n/a' WHEN event_id % 53 = 0 THEN '-12.5'
       ELSE CAST(amount AS {STR}) END AS amount,
  nameOrig,
  CAST(oldbalanceOrg AS {STR}) AS oldbalanceOrg,
  CASE WHEN event_id % 73 = 0 THEN '' ELSE CAST(newbalanceOrig AS {STR}) END AS newbalanceOrig,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE nameDest END AS nameDest,
  CAST(oldbalanceDest AS {STR}) AS oldbalanceDest,
  CAST(newbalanceDest AS {STR}) AS newbalanceDest,
  CASE WHEN event_id % 79 = 0 THEN '0.5' ELSE CAST(isFraud AS {STR}) END AS isFraud,
  CAST(isFlaggedFraud AS {STR}) AS isFlaggedFraud
FROM ({TXN}) t
"""


def _render(template: str, words: dict[str, str], events: str) -> str:
    inner = _TXN.format(**words, EVENTS=events)
    return template.format(**words, EVENTS=events, TXN=inner)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, events: DataFrame, template: str) -> DataFrame:
    return spark.sql(_render(template, _SPARK_WORDS, "{events}"), events=events)


def derive_transactions(spark: SparkSession, events: DataFrame) -> DataFrame:
    """``txn`` over any batch or streaming frame shaped like ``events``."""
    return _view(spark, events, _TXN)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_transactions(spark, read_table(spark, sf_dir, "events"))


def transactions_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, read_table(spark, sf_dir, "events"), _TXN_GAPS)


def transactions_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_text(spark, read_table(spark, sf_dir, "events"))


def derive_text(spark: SparkSession, events: DataFrame) -> DataFrame:
    """``txn_text`` over any batch or streaming frame shaped like ``events``."""
    return _view(spark, events, _TXN_TEXT)


def duckdb_views() -> dict[str, str]:
    """The views as DuckDB text, for WITH clauses."""
    return {
        "txn": _render(_TXN, _DUCK_WORDS, "events"),
        "txn_gaps": _render(_TXN_GAPS, _DUCK_WORDS, "events"),
        "txn_text": _render(_TXN_TEXT, _DUCK_WORDS, "events"),
    }
