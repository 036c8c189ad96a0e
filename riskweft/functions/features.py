"""Transaction features. Each group is one projection; nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import flag, ratio

C = F.col

# Upper bounds (inclusive) of the amount buckets and their names.
AMOUNT_BOUNDS = [(100, "very_small"), (1000, "small"), (10000, "medium"), (100000, "large")]
TOP_AMOUNT_BUCKET = "very_large"

DEFAULT_GROUPS = {
    "use_balance_features": True,
    "use_transaction_features": True,
    "use_time_features": True,
    "use_account_frequency": False,
}


def amount_category(amount: Column) -> Column:
    """Right-closed buckets over [0, inf); NULL for negative or unknown amounts."""
    bucket = F.when(amount < 0, None)
    for upper, name in AMOUNT_BOUNDS:
        bucket = bucket.when(amount <= upper, name)
    return bucket.when(amount.isNotNull(), TOP_AMOUNT_BUCKET)


def hour_of_day(step: Column) -> Column:
    return F.pmod(step, F.lit(24)).cast("bigint")


def day_of_week(step: Column) -> Column:
    return F.pmod(F.floor(step / F.lit(24.0)), F.lit(7)).cast("bigint")


def starts_with(account: Column, prefix: str) -> Column:
    return flag(account.startswith(prefix))


def account_prefix(account: Column) -> Column:
    return F.substring(account, 1, 1)


def large_transfer_rule(limit: float = 200000) -> Column:
    """The business rule behind the flag column: a TRANSFER above the limit."""
    return flag((C("type") == "TRANSFER") & (C("amount") > limit))


def _add(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns(columns)


def balance_features(df: DataFrame) -> DataFrame:
    old_o, new_o = C("oldbalanceOrg"), C("newbalanceOrig")
    old_d, new_d = C("oldbalanceDest"), C("newbalanceDest")
    return _add(
        df,
        {
            "balance_diff_orig": old_o - new_o,
            "balance_diff_dest": new_d - old_d,
            "balance_orig_zero": flag(old_o == 0),
            "balance_dest_zero": flag(old_d == 0),
            "zero_balance_after_transaction": flag(new_o == 0),
            "balance_orig_ratio": F.when(old_o > 0, C("amount") / old_o).otherwise(0.0),
            "balance_dest_ratio": F.when(old_d > 0, C("amount") / (old_d + 1)).otherwise(0.0),
        },
    )


def transaction_features(df: DataFrame) -> DataFrame:
    amount, old_o, old_d = C("amount"), C("oldbalanceOrg"), C("oldbalanceDest")
    return _add(
        df,
        {
            "amount_log": F.log1p(F.when(amount < 0, 0.0).otherwise(amount)),
            "amount_per_balance_orig": F.try_divide(amount, old_o + 1),
            "empties_origin": flag((old_o > 0) & (C("newbalanceOrig") == 0)),
            "creates_dest_balance": flag((old_d == 0) & (C("newbalanceDest") > 0)),
            "amount_category": amount_category(amount),
        },
    )


def time_features(df: DataFrame, business_end_inclusive: bool = False) -> DataFrame:
    """Clock features of the hour index; a frame without ``step`` is returned unchanged."""
    if "step" not in df.columns:
        return df
    hour, day = hour_of_day(C("step")), day_of_week(C("step"))
    before_close = hour <= 17 if business_end_inclusive else hour < 17
    return _add(
        df,
        {
            "hour_of_day": hour,
            "day_of_week": day,
            "is_weekend": flag(day.isin(5, 6)),
            "is_business_hours": flag((hour >= 9) & before_close),
            "is_night": flag((hour >= 22) | (hour < 6)),
        },
    )


def account_features(df: DataFrame, use_frequency: bool = False) -> DataFrame:
    added = _add(
        df,
        {
            "same_account_transfer": flag(C("nameOrig") == C("nameDest")),
            "orig_is_customer": starts_with(C("nameOrig"), "C"),
            "dest_is_customer": starts_with(C("nameDest"), "C"),
        },
    )
    if use_frequency:
        from riskweft.operators.lookup import account_frequencies

        added = account_frequencies(added)
    return added


def create_features(df: DataFrame, groups: dict | None = None) -> DataFrame:
    """All feature groups switched on in ``groups``; the account group is always on."""
    on = {**DEFAULT_GROUPS, **(groups or {})}
    if on["use_balance_features"]:
        df = balance_features(df)
    if on["use_transaction_features"]:
        df = transaction_features(df)
    if on["use_time_features"]:
        df = time_features(df)
    return account_features(df, on["use_account_frequency"])


def interaction_features(df: DataFrame) -> DataFrame:
    """Balance-change and ratio features of the exploratory preset."""
    amount = C("amount")
    old_o, new_o = C("oldbalanceOrg"), C("newbalanceOrig")
    old_d, new_d = C("oldbalanceDest"), C("newbalanceDest")
    return _add(
        df,
        {
            "orig_balance_change": new_o - old_o,
            "dest_balance_change": new_d - old_d,
            "orig_balance_ratio": F.when(old_o > 0, new_o / old_o).otherwise(0.0),
            "dest_balance_ratio": F.when(old_d > 0, new_d / old_d).otherwise(0.0),
            "amount_to_orig_balance": F.when(old_o > 0, amount / old_o).otherwise(amount),
            "orig_zero_after": flag(new_o == 0),
            "dest_zero_before": flag(old_d == 0),
        },
    )


def log_features(df: DataFrame, columns: tuple[str, ...] = ("amount", "oldbalanceOrg", "newbalanceOrig")) -> DataFrame:
    return _add(df, {f"log_{c}": F.log1p(C(c)) for c in columns})


def large_amount_flag(df: DataFrame, cutoff: float) -> DataFrame:
    """``is_large_amount`` against a cutoff fitted elsewhere (the 95 % point of the training rows)."""
    return _add(df, {"is_large_amount": flag(C("amount") > F.lit(float(cutoff)))})


def create_notebook_features(df: DataFrame, large_amount_cutoff: float) -> DataFrame:
    """Second preset: interactions, clock with an inclusive closing hour, account kinds, logs, large-amount flag."""
    df = interaction_features(df)
    df = time_features(df, business_end_inclusive=True).drop("is_weekend")
    df = df.withColumnRenamed("is_night", "is_night_time")
    df = _add(
        df,
        {
            "orig_is_customer": starts_with(C("nameOrig"), "C"),
            "dest_is_customer": starts_with(C("nameDest"), "C"),
            "dest_is_merchant": starts_with(C("nameDest"), "M"),
        },
    )
    return log_features(large_amount_flag(df, large_amount_cutoff))


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns the second frame has beyond the first, in order."""
    known = set(before.columns)
    return [c for c in after.columns if c not in known]
