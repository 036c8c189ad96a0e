"""Hypothesis tests. The sums over the data are Spark aggregations; a p-value is computed on one row per feature."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweft.operators.order_stats import MAX_GROUPS, group_values
from riskweft.operators.prefix import ROWS_PER_BUCKET, cumulative_by_value
from riskweft.schema import LABEL

ALPHA = 0.05


@F.pandas_udf(T.DoubleType())
def two_sided_normal(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0)))


@F.pandas_udf(T.DoubleType())
def chi_square_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else gamma_tail(d / 2.0, v / 2.0) for v, d in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def kolmogorov_tail(d: pd.Series, effective: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else kolmogorov(v, e) for v, e in zip(d, effective)], dtype="float64")


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: power series below a + 1, continued fraction above."""
    if x <= 0 or a <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a)) if x < 700 + a else 0.0
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def kolmogorov(d: float, effective: float) -> float:
    """Tail of the Kolmogorov distribution with the usual small-sample correction of the argument."""
    root = math.sqrt(effective)
    x = (root + 0.12 + 0.11 / root) * d
    if x < 0.2:
        return 1.0
    total = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(max(total, 0.0), 1.0)


def mann_whitney(df: DataFrame, columns: list[str], label: str = LABEL, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(feature, n_legit, n_fraud, u, z, p_value, significant): two-sided, tie- and continuity-corrected.

    ``u`` belongs to the legitimate rows. Features where a class is empty are left out.
    """
    legit, fraud = (F.col(label) == 0).cast("bigint"), (F.col(label) == 1).cast("bigint")
    runs = cumulative_by_value(df, columns, {"legit": legit, "fraud": fraud}, rows_per_bucket)
    ties = (F.col("legit") + F.col("fraud")).cast("double")
    before = (F.col("cum_legit") + F.col("cum_fraud")).cast("double") - ties
    summed = runs.groupBy("feature").agg(
        F.max("total_legit").cast("double").alias("n1"),
        F.max("total_fraud").cast("double").alias("n2"),
        F.sum(F.col("legit") * (before + (ties + 1) / 2)).alias("rank_sum"),
        F.sum(ties * ties * ties - ties).alias("tie_term"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    variance = n1 * n2 / 12 * ((n + 1) - F.col("tie_term") / (n * (n - 1)))
    scored = (
        summed.filter("n1 > 0 AND n2 > 0")
        .withColumn("u", F.col("rank_sum") - n1 * (n1 + 1) / 2)
        .withColumn("z", F.try_divide(F.greatest(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, F.lit(0.0)), F.sqrt(variance)))
        .withColumn("p_value", two_sided_normal("z"))
    )
    return scored.select(
        "feature",
        n1.cast("bigint").alias("n_legit"),
        n2.cast("bigint").alias("n_fraud"),
        "u",
        "z",
        "p_value",
        F.coalesce(F.col("p_value") < ALPHA, F.lit(False)).cast("int").alias("significant"),
    )


def contingency(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, observed, expected) over the complete grid of two class-like columns."""
    group_values(df.filter(F.col(row).isNotNull()), row)
    values = [v for v, _ in group_values(df.filter(F.col(column).isNotNull()), column)]
    present = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    wide = present.groupBy(row).agg(*[F.count_if(F.col(column) == F.lit(v)).alias(f"v{i}") for i, v in enumerate(values)])
    cells = F.array(*[F.struct(F.lit(v).alias(column), F.col(f"v{i}").alias("observed")) for i, v in enumerate(values)])
    grid = wide.select(row, F.inline(cells))
    # At most MAX_GROUPS x MAX_GROUPS cells from here on.
    by_row, by_column = Window.partitionBy(row), Window.partitionBy(column)
    whole = Window.partitionBy(F.lit(0))
    expected = F.sum("observed").over(by_row) * F.sum("observed").over(by_column).cast("double") / F.sum("observed").over(whole)
    return grid.withColumn("expected", expected)


def chi_square(df: DataFrame, row: str, column: str) -> DataFrame:
    """One row: statistic, dof, p_value, significant. Yates' correction applies when dof is 1."""
    grid = contingency(df, row, column)
    gap = F.abs(F.col("observed") - F.col("expected"))
    corrected = F.greatest(gap - 0.5, F.lit(0.0))
    summed = grid.agg(
        F.sum(gap * gap / F.col("expected")).alias("plain"),
        F.sum(corrected * corrected / F.col("expected")).alias("yates"),
        (F.count_distinct(row) - 1).alias("r"),
        (F.count_distinct(column) - 1).alias("c"),
    )
    dof = F.col("r") * F.col("c")
    scored = summed.select(F.when(dof == 1, F.col("yates")).otherwise(F.col("plain")).alias("statistic"), dof.alias("dof"))
    scored = scored.withColumn("p_value", F.when(F.col("dof") > 0, chi_square_tail("statistic", "dof")))
    return scored.withColumn("significant", F.coalesce(F.col("p_value") < ALPHA, F.lit(False)).cast("int"))


def anova_f(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """(feature, f_score): between-class over within-class mean square. One row per class leaves the scan."""
    stats = df.groupBy(label).agg(
        *[F.struct(F.count(c).cast("double").alias("n"), F.avg(c).alias("m"), F.var_pop(c).alias("v")).alias(c) for c in columns]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["n"].alias("n"), F.col(c)["m"].alias("m"), F.col(c)["v"].alias("v")) for c in columns])
    long = stats.select(F.inline(cells)).filter("n > 0")
    by_feature = Window.partitionBy("feature")
    mean = F.sum(F.col("n") * F.col("m")).over(by_feature) / F.sum("n").over(by_feature)
    centred = long.withColumn("gap", F.col("m") - mean)
    sums = centred.groupBy("feature").agg(
        F.sum(F.col("n") * F.col("gap") * F.col("gap")).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).cast("double").alias("k"),
    )
    f = F.try_divide(F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k")))
    return sums.select("feature", f.alias("f_score"))


def ks_two_sample(reference: DataFrame, current: DataFrame, columns: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(feature, n_reference, n_current, statistic, p_value) of the two-sample Kolmogorov-Smirnov test, all features at once."""
    sides = reference.select(*columns, F.lit(1).alias("_ref"), F.lit(0).alias("_cur")).unionByName(
        current.select(*columns, F.lit(0).alias("_ref"), F.lit(1).alias("_cur"))
    )
    runs = cumulative_by_value(sides, columns, {"ref": F.col("_ref").cast("bigint"), "cur": F.col("_cur").cast("bigint")}, rows_per_bucket)
    gap = F.abs(F.try_divide("cum_ref", "total_ref") - F.try_divide("cum_cur", "total_cur"))
    best = runs.groupBy("feature").agg(
        F.max("total_ref").alias("n_reference"), F.max("total_cur").alias("n_current"), F.max(gap).alias("statistic")
    )
    product = F.col("n_reference").cast("double") * F.col("n_current")
    effective = F.try_divide(product, F.col("n_reference") + F.col("n_current"))
    return best.withColumn("p_value", kolmogorov_tail("statistic", effective))


__all__ = ["ALPHA", "MAX_GROUPS", "anova_f", "chi_square", "contingency", "gamma_tail", "kolmogorov", "ks_two_sample", "mann_whitney"]
