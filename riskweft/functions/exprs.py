"""Small building blocks shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column) -> Column:
    """1/0 indicator; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """numerator / denominator, or ``default`` where the denominator is zero or unknown."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def finite(column: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(F.isnan(column) | (F.abs(column) == F.lit(float("inf"))), None).otherwise(column)


def order_key(seed: int, *columns: str) -> Column:
    """Pseudo-random 60-bit key of a row.

    It depends on the row and the seed only, never on partitioning, and any engine with md5 can recompute it.
    """
    parts = [F.col(c).cast("string") for c in columns] + [F.lit(str(seed))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def unit_interval(key: Column) -> Column:
    """Map a 60-bit key to [0, 1)."""
    return key.cast("double") / F.lit(float(2**60))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def numeric_names(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_names(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = [], name: str = "feature", value: str = "value") -> DataFrame:
    """(feature, value) rows of the numeric ``columns``, next to the kept columns; a narrow operation."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(keep, columns, name, value)


def rows_from_wide(one_row: DataFrame, entries: list[tuple], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into rows: each entry is a tuple of Columns over that row."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(entry, names)]) for entry in entries]
    return one_row.select(F.inline(F.array(*structs)))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so results do not carry summation-order noise."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def digest(*columns: str) -> list[Column]:
    """Two numbers of 64 bits that stand for the values (and the NULLs) of the columns: equal rows have equal ones.

    Different rows share both with a probability of 2**-128 for each pair of rows.
    """
    # A hash passes over NULLs, so their places are hashed as well.
    absent = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(k), absent, *columns).alias(f"d{k}") for k in range(2)]
