"""Columns, types and roles of the transaction table."""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = "isFraud"
RULE_FLAG = "isFlaggedFraud"

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)
COLUMN_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTION_SCHEMA.fields}
REQUIRED_COLUMNS = list(COLUMN_TYPES)
REQUEST_FIELDS = [c for c in REQUIRED_COLUMNS if c not in (LABEL, RULE_FLAG)]
MONEY_COLUMNS = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
NUMERIC_COLUMNS = ["step"] + MONEY_COLUMNS
ACCOUNT_COLUMNS = ["nameOrig", "nameDest"]
# Never model inputs: the clock, the identities, the label and the business-rule flag.
NON_FEATURE_COLUMNS = ["step", "nameOrig", "nameDest", LABEL, RULE_FLAG]
TRANSACTION_TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]
AMOUNT_CATEGORIES = ["very_small", "small", "medium", "large", "very_large"]


def missing_columns(columns: list[str], required: list[str] = REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in columns]
