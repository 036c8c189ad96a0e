"""Golden rows of the feature functions, computed by hand."""

import math

import pytest

from riskweft.functions import features

COLUMNS = "row string, step bigint, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double"
ROWS = [
    ("r1", 1, "TRANSFER", 100.0, "C1", 1000.0, 900.0, "M1", 0.0, 100.0),
    ("r2", 2, "PAYMENT", 200.0, "C2", 2000.0, 1800.0, "M2", 0.0, 200.0),
    ("r3", 3, "CASH_OUT", 300.0, "C3", 3000.0, 2700.0, "C1", 100.0, 400.0),
    ("r4", 142, "TRANSFER", 1000.5, "C9", 1000.5, 0.0, "C9", 0.0, 0.0),
    ("r5", -7, "DEBIT", -5.0, "M4", 0.0, 0.0, "C5", 50.0, 50.0),
    ("r6", 17, "PAYMENT", None, None, None, None, None, None, None),
]
GOLDEN = {
    "balance_diff_orig": [100, 200, 300, 1000.5, 0, None],
    "balance_diff_dest": [100, 200, 300, 0, 0, None],
    "balance_orig_zero": [0, 0, 0, 0, 1, 0],
    "balance_dest_zero": [1, 1, 0, 1, 0, 0],
    "zero_balance_after_transaction": [0, 0, 0, 1, 1, 0],
    "balance_orig_ratio": [0.1, 0.1, 0.1, 1.0, 0, 0],
    "balance_dest_ratio": [0, 0, 300 / 101, 0, -5 / 51, 0],
    "amount_log": [math.log(101), math.log(201), math.log(301), math.log(1001.5), 0, None],
    "amount_per_balance_orig": [100 / 1001, 200 / 2001, 300 / 3001, 1000.5 / 1001.5, -5, None],
    "empties_origin": [0, 0, 0, 1, 0, 0],
    "creates_dest_balance": [1, 1, 0, 0, 0, 0],
    "amount_category": ["very_small", "small", "small", "medium", None, None],
    "hour_of_day": [1, 2, 3, 22, 17, 17],
    "day_of_week": [0, 0, 0, 5, 6, 0],
    "is_weekend": [0, 0, 0, 1, 1, 0],
    "is_business_hours": [0, 0, 0, 0, 0, 0],
    "is_night": [1, 1, 1, 1, 0, 0],
    "same_account_transfer": [0, 0, 0, 1, 0, 0],
    "orig_is_customer": [1, 1, 1, 1, 0, 0],
    "dest_is_customer": [0, 0, 1, 1, 1, 0],
}


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_golden_rows(golden):
    made = {r["row"]: r for r in features.create_features(golden).collect()}
    for name, values in GOLDEN.items():
        for (row, *_), expected in zip(ROWS, values):
            actual = made[row][name]
            if isinstance(expected, (int, float)):
                assert actual == pytest.approx(expected, rel=1e-12), (name, row)
            else:
                assert actual == expected, (name, row)


def test_inclusive_closing_hour(golden):
    hours = {r["row"]: r["is_business_hours"] for r in features.time_features(golden, True).collect()}
    assert hours == {"r1": 0, "r2": 0, "r3": 0, "r4": 0, "r5": 1, "r6": 1}


def test_merchant_flag_and_notebook_preset(golden):
    made = {r["row"]: r for r in features.create_notebook_features(golden, 250.0).collect()}
    assert [made[r[0]]["dest_is_merchant"] for r in ROWS] == [1, 1, 0, 0, 0, 0]
    assert [made[r[0]]["is_large_amount"] for r in ROWS] == [0, 0, 1, 1, 0, 0]
    assert made["r5"]["amount_to_orig_balance"] == -5.0


def test_groups_can_be_switched_off(golden):
    only_accounts = features.create_features(golden, {"use_balance_features": False, "use_transaction_features": False, "use_time_features": False})
    assert features.new_columns(golden, only_accounts) == ["same_account_transfer", "orig_is_customer", "dest_is_customer"]
    assert features.time_features(golden.drop("step")).columns == golden.drop("step").columns


def test_account_frequency_on_nulls_and_hot_keys(spark, golden):
    from pyspark.sql import functions as F

    from riskweft.operators import lookup

    many = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("a"), F.col("id"))).alias("k"), "id")
    counted = {(r["k"], r["n"]) for r in lookup.join_key_counts(many, "k", "n").collect()}
    assert ("hot", 2000) in counted and (None, None) in counted
    assert all(n == 1 for k, n in counted if k not in ("hot", None))
    assert lookup.join_key_counts(many, "k", "n").count() == 6000
    both = lookup.account_frequencies(golden).collect()
    assert {r["row"]: r["orig_account_frequency"] for r in both}["r6"] is None
