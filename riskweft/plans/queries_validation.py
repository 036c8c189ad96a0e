"""Checked queries: casts, filters, validation and role projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.features import large_transfer_rule
from riskweft.operators import projection, validation
from riskweft.plans.queries_sources import DUCK_CASTS
from riskweft.plans.registry import query
from riskweft.schema import COLUMN_TYPES, MONEY_COLUMNS, REQUEST_FIELDS, REQUIRED_COLUMNS
from riskweft.sources.transactions import read_table, transactions, transactions_as_text, transactions_with_gaps

TXN_COLS = ", ".join(REQUIRED_COLUMNS)


@query("b1_cast_schema", f"SELECT event_id, {DUCK_CASTS} FROM txn_text")
def _(spark, sf):
    return validation.cast_schema(transactions_as_text(spark, sf))


@query(
    "b1_cast_failures",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS data_type, count(*) FILTER (t.{c} IS NOT NULL AND k.{c} IS NULL) AS failed FROM txn_text t JOIN k USING (event_id)"""
        for c, t in COLUMN_TYPES.items()
    ),
    ctes=f"k AS (SELECT event_id, {DUCK_CASTS} FROM txn_text)",
)
def _(spark, sf):
    return validation.cast_failures(transactions_as_text(spark, sf))


@query(
    "b3_validate_extract",
    """SELECT 'rows' AS "check", CAST(count(*) AS DOUBLE) AS value FROM g UNION ALL """
    + " UNION ALL ".join(f"SELECT 'null_{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM g" for c in REQUIRED_COLUMNS)
    + """ UNION ALL SELECT 'class_0', CAST(count(*) FILTER (isFraud = 0) AS DOUBLE) FROM g
          UNION ALL SELECT 'class_1', CAST(count(*) FILTER (isFraud = 1) AS DOUBLE) FROM g
          UNION ALL SELECT 'negative_amount', CAST(count(*) FILTER (amount < 0) AS DOUBLE) FROM g
          UNION ALL SELECT 'duplicates', CAST((SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT * FROM g) d) AS DOUBLE)
          UNION ALL SELECT 'fraud_rate_pct', round(avg(isFraud) * 100.0, 6) FROM g""",
    ctes=f"g AS (SELECT {TXN_COLS} FROM txn_gaps UNION ALL SELECT {TXN_COLS} FROM txn_gaps WHERE type = 'DEBIT')",
)
def _(spark, sf):
    base = transactions_with_gaps(spark, sf).select(*REQUIRED_COLUMNS)
    doubled = base.unionByName(base.filter("type = 'DEBIT'"))
    return validation.validate_extract(doubled).withColumn("value", F.round("value", 6))


@query("b4_clean_rows", f"SELECT event_id, {TXN_COLS} FROM txn_gaps WHERE amount >= 0 AND " + " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_COLUMNS))
def _(spark, sf):
    return validation.clean_rows(transactions_with_gaps(spark, sf).select("event_id", *REQUIRED_COLUMNS), REQUIRED_COLUMNS)


@query("b5_features_and_label", f"SELECT event_id, {', '.join(REQUEST_FIELDS)}, isFraud FROM txn")
def _(spark, sf):
    names, kept = projection.features_and_label(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS))
    return kept.select(*names, "isFraud")


@query(
    "b6_exclude_columns",
    "SELECT event_id, step, type, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, isFlaggedFraud FROM txn",
)
def _(spark, sf):
    return projection.exclude_columns(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS))


@query(
    "b7_column_roles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{'categorical' if t == 'string' else 'numeric'}' AS role, count({c}) AS filled FROM txn_gaps"""
        for c, t in COLUMN_TYPES.items()
    ),
)
def _(spark, sf):
    return projection.role_table(transactions_with_gaps(spark, sf).select(*REQUIRED_COLUMNS))


_BAD = " OR ".join([f"TRY_CAST({c} AS DOUBLE) IS NULL" for c in MONEY_COLUMNS] + ["TRY_CAST(step AS BIGINT) IS NULL"])
REQUEST_ERROR_SQL = (
    "CASE "
    + " ".join(f"WHEN {f} IS NULL THEN 'Field {f} cannot be None'" for f in REQUEST_FIELDS)
    + f" WHEN {_BAD} THEN '{validation.BAD_TYPES}' END"
)


@query(
    "b8_validate_requests",
    f"SELECT event_id, e AS error, CASE WHEN e IS NULL THEN 1 ELSE 0 END AS is_valid FROM (SELECT event_id, {REQUEST_ERROR_SQL} AS e FROM txn_text) v",
)
def _(spark, sf):
    return validation.validate_requests(transactions_as_text(spark, sf)).select("event_id", "error", "is_valid")


@query(
    "b8_validate_payloads",
    "SELECT event_id, CASE WHEN type IS NULL THEN 'Missing required field: type' WHEN amount IS NULL THEN 'Missing required field: amount' "
    "WHEN nameDest IS NULL THEN 'Missing required field: nameDest' "
    f"WHEN {_BAD} THEN '{validation.BAD_TYPES}' END AS error FROM txn_text",
)
def _(spark, sf):
    # to_json leaves NULL fields out of the object, so they arrive as absent fields.
    payloads = transactions_as_text(spark, sf).select("event_id", F.to_json(F.struct(*REQUEST_FIELDS)).alias("payload"))
    return validation.validate_payloads(payloads, "payload").select("event_id", "error")


@query(
    "b9_class_amounts",
    "SELECT isFraud, count(amount) AS n, round(avg(amount), 6) AS mean_amount, max(amount) AS max_amount FROM txn_gaps GROUP BY isFraud",
)
def _(spark, sf):
    grouped = transactions_with_gaps(spark, sf).groupBy("isFraud")
    return grouped.agg(F.count("amount").alias("n"), F.round(F.avg("amount"), 6).alias("mean_amount"), F.max("amount").alias("max_amount"))


@query(
    "b11_drop_non_finite",
    "SELECT event_id, amount, oldbalanceOrg FROM txn_gaps WHERE amount IS NOT NULL AND oldbalanceOrg IS NOT NULL AND NOT isinf(oldbalanceOrg)",
)
def _(spark, sf):
    kept = validation.drop_non_finite(transactions_with_gaps(spark, sf), ["amount", "oldbalanceOrg"])
    return kept.select("event_id", "amount", "oldbalanceOrg")


@query("b12_ordered_projection", "SELECT event_id, amount, step, type FROM txn")
def _(spark, sf):
    return projection.select_known(transactions(spark, sf), ["event_id", "amount", "not_there", "step", "type"])


@query(
    "b14_negative_counts",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < 0) AS negative_values FROM txn_gaps""" for c in MONEY_COLUMNS),
)
def _(spark, sf):
    return validation.negative_counts(transactions_with_gaps(spark, sf))


@query(
    "b14_negative_balances",
    """SELECT 'c_acctbal' AS "column", count(*) FILTER (c_acctbal < 0) AS negative_values FROM customer""",
)
def _(spark, sf):
    return validation.negative_counts(read_table(spark, sf, "customer"), ["c_acctbal"])


@query("b15_large_transfer_rule", "SELECT event_id, CASE WHEN type = 'TRANSFER' AND amount > 200000 THEN 1 ELSE 0 END AS rule_flag, isFlaggedFraud FROM txn")
def _(spark, sf):
    return transactions(spark, sf).select("event_id", large_transfer_rule().alias("rule_flag"), "isFlaggedFraud")
