"""Column selection by role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweft.schema import LABEL, RULE_FLAG


def features_and_label(df: DataFrame, label: str = LABEL) -> tuple[list[str], DataFrame]:
    """Feature names, and the frame without the rule flag. The label stays a column of the same frame."""
    if label not in df.columns:
        raise ValueError(f"no target column {label!r}")
    kept = df.drop(RULE_FLAG)
    return [c for c in kept.columns if c != label], kept


def exclude_columns(df: DataFrame, excluded: tuple[str, ...] = ("isFraud", "nameOrig", "nameDest")) -> DataFrame:
    """Feature list by exclusion; unlike ``features_and_label`` this keeps the rule flag."""
    return df.select(*[c for c in df.columns if c not in excluded])


def select_known(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in the given order; names the frame lacks are skipped."""
    return df.select(*[c for c in names if c in df.columns])


def column_roles(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Numeric and categorical columns by data type."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    return {
        "numeric": [f.name for f in fields if isinstance(f.dataType, T.NumericType)],
        "categorical": [f.name for f in fields if isinstance(f.dataType, T.StringType)],
    }


def role_table(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(column, role, filled): role of each column and how many values it holds."""
    roles = column_roles(df, exclude)
    counted = df.agg(*[F.count(c).alias(c) for names in roles.values() for c in names])
    structs = [
        F.struct(F.lit(c).alias("column"), F.lit(role).alias("role"), F.col(c).alias("filled")) for role, names in roles.items() for c in names
    ]
    return counted.select(F.inline(F.array(*structs)))
