"""Checked queries: transaction features, account lookups and the flagship rate table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions import features
from riskweft.functions.exprs import finite
from riskweft.operators import lookup, order_stats, profile
from riskweft.plans.registry import query
from riskweft.sources.transactions import transactions, transactions_with_gaps

HOUR = "(((step % 24) + 24) % 24)"
DAY = "CAST(((CAST(floor(step / 24.0) AS BIGINT) % 7) + 7) % 7 AS BIGINT)"


def gaps(spark, sf):
    """The defective view with all its rows; an infinite balance counts as missing."""
    return transactions_with_gaps(spark, sf).withColumn("oldbalanceOrg", finite(F.col("oldbalanceOrg")))


GAPS = "gaps AS (SELECT * REPLACE (CASE WHEN NOT isinf(oldbalanceOrg) THEN oldbalanceOrg END AS oldbalanceOrg) FROM txn_gaps)"


def _flag(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {name}"


BALANCE_SQL = ", ".join(
    [
        "oldbalanceOrg - newbalanceOrig AS balance_diff_orig",
        "newbalanceDest - oldbalanceDest AS balance_diff_dest",
        _flag("oldbalanceOrg = 0", "balance_orig_zero"),
        _flag("oldbalanceDest = 0", "balance_dest_zero"),
        _flag("newbalanceOrig = 0", "zero_balance_after_transaction"),
        "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0.0e0 END AS balance_orig_ratio",
        "CASE WHEN oldbalanceDest > 0 THEN amount / (oldbalanceDest + 1) ELSE 0.0e0 END AS balance_dest_ratio",
    ]
)
CATEGORY_SQL = (
    "CASE WHEN amount < 0 THEN NULL WHEN amount <= 100 THEN 'very_small' WHEN amount <= 1000 THEN 'small' WHEN amount <= 10000 THEN 'medium' "
    "WHEN amount <= 100000 THEN 'large' WHEN amount IS NOT NULL THEN 'very_large' END AS amount_category"
)
LOG_SQL = "ln(1.0e0 + CASE WHEN amount < 0 THEN 0.0e0 ELSE amount END)"
TRANSACTION_SQL = ", ".join(
    [
        "amount / (oldbalanceOrg + 1) AS amount_per_balance_orig",
        _flag("oldbalanceOrg > 0 AND newbalanceOrig = 0", "empties_origin"),
        _flag("oldbalanceDest = 0 AND newbalanceDest > 0", "creates_dest_balance"),
        CATEGORY_SQL,
    ]
)


def time_sql(close: str, night: str = "is_night", weekend: bool = True) -> str:
    parts = [f"{HOUR} AS hour_of_day", f"{DAY} AS day_of_week"]
    if weekend:
        parts.append(_flag(f"{DAY} IN (5, 6)", "is_weekend"))
    parts.append(_flag(f"{HOUR} >= 9 AND {HOUR} {close}", "is_business_hours"))
    parts.append(_flag(f"{HOUR} >= 22 OR {HOUR} < 6", night))
    return ", ".join(parts)


TIME_SQL = time_sql("< 17")
ACCOUNT_SQL = ", ".join(
    [
        _flag("nameOrig = nameDest", "same_account_transfer"),
        _flag("nameOrig LIKE 'C%'", "orig_is_customer"),
        _flag("nameDest LIKE 'C%'", "dest_is_customer"),
    ]
)
INTERACTION_SQL = ", ".join(
    [
        "newbalanceOrig - oldbalanceOrg AS orig_balance_change",
        "newbalanceDest - oldbalanceDest AS dest_balance_change",
        "CASE WHEN oldbalanceOrg > 0 THEN newbalanceOrig / oldbalanceOrg ELSE 0.0e0 END AS orig_balance_ratio",
        "CASE WHEN oldbalanceDest > 0 THEN newbalanceDest / oldbalanceDest ELSE 0.0e0 END AS dest_balance_ratio",
        "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE amount END AS amount_to_orig_balance",
        _flag("newbalanceOrig = 0", "orig_zero_after"),
        _flag("oldbalanceDest = 0", "dest_zero_before"),
    ]
)
# Names of the derived features.
BALANCE_NAMES = [
    "balance_diff_orig",
    "balance_diff_dest",
    "balance_orig_zero",
    "balance_dest_zero",
    "zero_balance_after_transaction",
    "balance_orig_ratio",
    "balance_dest_ratio",
]
INTERACTION_NAMES = [
    "orig_balance_change",
    "dest_balance_change",
    "orig_balance_ratio",
    "dest_balance_ratio",
    "amount_to_orig_balance",
    "orig_zero_after",
    "dest_zero_before",
]


@query("d1_d6_balance_features", f"SELECT event_id, {BALANCE_SQL} FROM gaps", ctes=GAPS)
def _(spark, sf):
    return features.balance_features(gaps(spark, sf)).select("event_id", *BALANCE_NAMES)


@query("d7_amount_log", f"SELECT event_id, round({LOG_SQL}, 9) AS amount_log FROM txn_gaps")
def _(spark, sf):
    df = features.transaction_features(transactions_with_gaps(spark, sf))
    return df.select("event_id", F.round("amount_log", 9).alias("amount_log"))


@query("d8_d11_transaction_features", f"SELECT event_id, {TRANSACTION_SQL} FROM txn_gaps")
def _(spark, sf):
    df = features.transaction_features(transactions_with_gaps(spark, sf))
    return df.select("event_id", "amount_per_balance_orig", "empties_origin", "creates_dest_balance", "amount_category")


@query("d12_d16_time_features", f"SELECT event_id, {TIME_SQL} FROM txn")
def _(spark, sf):
    df = features.time_features(transactions(spark, sf))
    return df.select("event_id", "hour_of_day", "day_of_week", "is_weekend", "is_business_hours", "is_night")


@query("d15_business_hours_inclusive", f"SELECT event_id, {_flag(f'{HOUR} >= 9 AND {HOUR} <= 17', 'is_business_hours')} FROM txn")
def _(spark, sf):
    return features.time_features(transactions(spark, sf), True).select("event_id", "is_business_hours")


@query("d17_d18_account_features", f"SELECT event_id, {ACCOUNT_SQL} FROM txn_gaps")
def _(spark, sf):
    df = features.account_features(transactions_with_gaps(spark, sf))
    return df.select("event_id", "same_account_transfer", "orig_is_customer", "dest_is_customer")


MERCHANT_SQL = _flag("nameDest LIKE 'M%'", "dest_is_merchant")


@query("d19_dest_is_merchant", f"SELECT event_id, {MERCHANT_SQL} FROM txn_gaps")
def _(spark, sf):
    return transactions_with_gaps(spark, sf).select("event_id", features.starts_with(F.col("nameDest"), "M").alias("dest_is_merchant"))


@query("d20_account_prefix", "SELECT event_id, substr(nameOrig, 1, 1) AS orig_type, substr(nameDest, 1, 1) AS dest_type FROM txn_gaps")
def _(spark, sf):
    return transactions_with_gaps(spark, sf).select(
        "event_id", features.account_prefix(F.col("nameOrig")).alias("orig_type"), features.account_prefix(F.col("nameDest")).alias("dest_type")
    )


FREQUENCY_SQL = """
SELECT t.event_id, o.n AS orig_account_frequency, d.n AS dest_account_frequency FROM txn_gaps t
LEFT JOIN (SELECT nameOrig, count(*) AS n FROM txn_gaps GROUP BY nameOrig) o ON t.nameOrig = o.nameOrig
LEFT JOIN (SELECT nameDest, count(*) AS n FROM txn_gaps GROUP BY nameDest) d ON t.nameDest = d.nameDest
"""


@query("c1_account_frequency", FREQUENCY_SQL)
def _(spark, sf):
    df = transactions_with_gaps(spark, sf).select("event_id", "nameOrig", "nameDest")
    return lookup.account_frequencies(df).select("event_id", "orig_account_frequency", "dest_account_frequency")


@query("d21_account_features_with_frequency", FREQUENCY_SQL.replace("o.n AS", f"{ACCOUNT_SQL.replace('nameOrig', 't.nameOrig').replace('nameDest', 't.nameDest')}, o.n AS"))
def _(spark, sf):
    df = features.account_features(transactions_with_gaps(spark, sf), use_frequency=True)
    return df.select(
        "event_id", "same_account_transfer", "orig_is_customer", "dest_is_customer", "orig_account_frequency", "dest_account_frequency"
    )


@query("c1_customer_order_counts", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS customer_orders FROM orders")
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey")
    return lookup.join_key_counts(orders, "o_custkey", "customer_orders").select("o_orderkey", "customer_orders")


@query("d22_d25_interaction_features", f"SELECT event_id, {INTERACTION_SQL} FROM txn")
def _(spark, sf):
    return features.interaction_features(transactions(spark, sf)).select("event_id", *INTERACTION_NAMES)


@query(
    "d26_large_amount_flag",
    "SELECT event_id, CASE WHEN amount > (SELECT quantile_cont(amount, 0.95) FROM txn) THEN 1 ELSE 0 END AS is_large_amount FROM txn",
)
def _(spark, sf):
    df = transactions(spark, sf)
    cutoff = order_stats.exact_quantiles(df, ["amount"], [0.95])[None]["amount"][0]
    return features.large_amount_flag(df, cutoff).select("event_id", "is_large_amount")


@query(
    "d27_log_features",
    "SELECT event_id, " + ", ".join(f"round(ln(1.0e0 + {c}), 9) AS log_{c}" for c in ("amount", "oldbalanceOrg", "newbalanceOrig")) + " FROM txn",
)
def _(spark, sf):
    df = features.log_features(transactions(spark, sf))
    return df.select("event_id", *[F.round(f"log_{c}", 9).alias(f"log_{c}") for c in ("amount", "oldbalanceOrg", "newbalanceOrig")])


@query(
    "d28_all_features",
    f"SELECT event_id, {BALANCE_SQL}, round({LOG_SQL}, 9) AS amount_log, {TRANSACTION_SQL}, {TIME_SQL}, {ACCOUNT_SQL} FROM txn",
)
def _(spark, sf):
    df = transactions(spark, sf)
    made = features.create_features(df)
    return made.select("event_id", *features.new_columns(df, made)).withColumn("amount_log", F.round("amount_log", 9))


NOTEBOOK_SQL = f"""SELECT event_id, {INTERACTION_SQL}, {time_sql('<= 17', 'is_night_time', weekend=False)},
  {_flag("nameOrig LIKE 'C%'", 'orig_is_customer')}, {_flag("nameDest LIKE 'C%'", 'dest_is_customer')}, {_flag("nameDest LIKE 'M%'", 'dest_is_merchant')},
  CASE WHEN amount > (SELECT quantile_cont(amount, 0.95) FROM txn) THEN 1 ELSE 0 END AS is_large_amount,
  round(ln(1.0e0 + amount), 9) AS log_amount, round(ln(1.0e0 + oldbalanceOrg), 9) AS log_oldbalanceOrg,
  round(ln(1.0e0 + newbalanceOrig), 9) AS log_newbalanceOrig FROM txn"""


@query("d29_notebook_features", NOTEBOOK_SQL)
def _(spark, sf):
    df = transactions(spark, sf)
    cutoff = order_stats.exact_quantiles(df, ["amount"], [0.95])[None]["amount"][0]
    made = features.create_notebook_features(df, cutoff)
    logs = [c for c in made.columns if c.startswith("log_")]
    return made.select("event_id", *features.new_columns(df, made)).withColumns({c: F.round(c, 9) for c in logs})


@query(
    "c6_scalar_lookup",
    "SELECT event_id, round(amount / (SELECT avg(amount) FROM txn), 9) AS amount_to_mean FROM txn",
)
def _(spark, sf):
    df = transactions(spark, sf)
    mean = df.agg(F.avg("amount")).scalar()
    return df.select("event_id", F.round(F.col("amount") / mean, 9).alias("amount_to_mean"))


@query(
    "e13_fraud_by_type",
    "SELECT type, count(*) AS total, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud) * 100.0, 6) AS fraud_rate FROM txn GROUP BY type",
)
def _(spark, sf):
    return profile.rate_by(transactions(spark, sf), F.col("type"), "type").withColumn("fraud_rate", F.round("fraud_rate", 6))
