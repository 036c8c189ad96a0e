"""Correlations and principal components."""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import rows_from_wide
from riskweft.operators.prefix import running_total
from riskweft.operators.validation import drop_non_finite
from riskweft.schema import LABEL


NAMES = ["feature_a", "feature_b", "correlation"]


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def _wide_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row holding every pair: pairwise complete, one scan."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return typed.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(_pairs(columns))])


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, correlation) for a < b in column order."""
    entries = [(F.lit(a), F.lit(b), F.col(f"r{i}")) for i, (a, b) in enumerate(_pairs(columns))]
    return rows_from_wide(_wide_correlations(df, columns), entries, NAMES)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The full matrix in long form."""
    entries = [(F.lit(c), F.lit(c), F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(_pairs(columns)):
        entries += [(F.lit(a), F.lit(b), F.col(f"r{i}")), (F.lit(b), F.lit(a), F.col(f"r{i}"))]
    return rows_from_wide(_wide_correlations(df, columns), entries, NAMES)


def high_correlations(df: DataFrame, columns: list[str], limit: float = 0.7) -> DataFrame:
    return correlation_pairs(df, columns).filter(F.abs("correlation") > limit)


def target_correlations(df: DataFrame, columns: list[str], label: str = LABEL, top: int | None = None) -> DataFrame:
    """(feature, correlation) with the label, strongest first; ``top`` keeps the strongest few."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    ranked = rows_from_wide(wide, [(F.lit(c), F.col(c)) for c in columns], ["feature", "correlation"])
    ranked = ranked.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature")
    return ranked.limit(top) if top else ranked


def principal_components(df: DataFrame, columns: list[str], components: int = 10) -> tuple[DataFrame, DataFrame]:
    """(component, explained, cumulative) and (component, feature, loading).

    The covariance is summed on the executors; only the columns x columns matrix reaches the driver. The sign of a
    component is fixed by making its largest loading positive.
    """
    spark = df.sparkSession
    clean = drop_non_finite(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="raw").transform(clean).select("raw")
    scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True).fit(vectors).transform(vectors)
    model = PCA(k=min(components, len(columns)), inputCol="scaled", outputCol="pc").fit(scaled)
    shares = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    loadings = []
    matrix = model.pc.toArray()
    for k in range(matrix.shape[1]):
        column = matrix[:, k]
        sign = 1.0 if column[abs(column).argmax()] >= 0 else -1.0
        loadings += [(k + 1, c, float(sign * v)) for c, v in zip(columns, column)]
    explained = running_total(spark.createDataFrame(shares, "component int, explained double"), [F.col("component")], "explained", "cumulative")
    return explained, spark.createDataFrame(loadings, "component int, feature string, loading double")
