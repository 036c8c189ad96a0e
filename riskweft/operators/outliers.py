"""Outlier counts by three rules. The fences are literals, so counting is one scan for all columns and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import percent, rows_from_wide
from riskweft.operators.order_stats import exact_quantiles
from riskweft.schema import MONEY_COLUMNS

IQR_FACTOR = 1.5
Z_LIMIT = 3.0
MODIFIED_Z_LIMIT = 3.5
MAD_SCALE = 0.6745


def iqr_condition(column: str, q1: float, q3: float) -> Column:
    spread = q3 - q1
    return (F.col(column) < q1 - IQR_FACTOR * spread) | (F.col(column) > q3 + IQR_FACTOR * spread)


def iqr_outliers(df: DataFrame, columns: list[str] = MONEY_COLUMNS) -> DataFrame:
    """(feature, outliers, outlier_pct of all rows) strictly outside the fences."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])[None]
    counts = [F.count_if(iqr_condition(c, *quartiles[c])).alias(c) if quartiles[c][0] is not None else F.lit(0).alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    entries = [(F.lit(c), F.col(c), percent(F.col(c), F.col("_rows"))) for c in columns]
    return rows_from_wide(wide, entries, ["feature", "outliers", "outlier_pct"])


def outlier_summary(df: DataFrame, columns: list[str] = MONEY_COLUMNS) -> DataFrame:
    """(feature, then count and percentage by IQR, z-score and modified z-score)."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])[None]
    columns = [c for c in columns if quartiles[c][0] is not None]
    distances = df.select(*[F.abs(F.col(c) - F.lit(quartiles[c][1])).alias(c) for c in columns])
    mads = {c: q[0] for c, q in exact_quantiles(distances, columns, [0.5])[None].items()}
    centre = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        q1, median, q3 = quartiles[c]
        mean, std, mad = centre[c]["m"], centre[c]["s"], mads[c]
        z = F.abs(F.try_divide(F.col(c) - F.lit(mean), F.lit(std))) > Z_LIMIT
        if mad:
            modified = F.abs(F.lit(MAD_SCALE) * (F.col(c) - F.lit(median)) / F.lit(mad)) > MODIFIED_Z_LIMIT
        else:
            modified = F.col(c) != F.lit(median)
        aggregates += [
            F.count(c).alias(f"n_{c}"),
            F.count_if(iqr_condition(c, q1, q3)).alias(f"i_{c}"),
            F.count_if(z).alias(f"z_{c}"),
            F.count_if(modified).alias(f"m_{c}"),
        ]
    wide = df.agg(*aggregates)
    rows, names = F.col("_rows"), ["feature", "iqr_outliers", "iqr_pct", "z_outliers", "z_pct", "modified_z_outliers", "modified_z_pct"]
    entries = [
        (
            F.lit(c),
            F.col(f"i_{c}"),
            percent(F.col(f"i_{c}"), rows),
            F.col(f"z_{c}"),
            percent(F.col(f"z_{c}"), F.col(f"n_{c}")),
            F.col(f"m_{c}"),
            percent(F.col(f"m_{c}"), rows),
        )
        for c in columns
    ]
    return rows_from_wide(wide, entries, names)


def mean_outlier_share(summary: DataFrame) -> DataFrame:
    return summary.agg(F.avg("iqr_pct").alias("mean_iqr_pct"))
