"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweft.functions.exprs import numeric_names
from riskweft.operators.reference import StoredReference, store_reference
from riskweft.operators.tests_of_difference import ALPHA, ks_two_sample


def shared_numeric(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric columns of both tables, and reference columns the current table lacks."""
    ours, theirs = numeric_names(reference), set(numeric_names(current))
    return [c for c in ours if c in theirs], [c for c in ours if c not in theirs]


def drift_report(reference: DataFrame, current: DataFrame, columns: list[str] | None = None, alpha: float = ALPHA) -> DataFrame:
    """(feature, statistic, p_value, drifted): two-sample test of every shared numeric column in one job."""
    names, _ = shared_numeric(reference, current)
    names = [c for c in names if columns is None or c in columns]
    if not names:
        raise ValueError("the two tables share no numeric column")
    tested = ks_two_sample(reference, current, names)
    drifted = F.coalesce(F.col("p_value") < alpha, F.lit(False)).cast("int")
    return tested.select("feature", "n_reference", "n_current", "statistic", "p_value", drifted.alias("drifted"))


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: features tested, features drifted, whether any drifted, and their names."""
    names = F.array_sort(F.collect_list(F.when(F.col("drifted") == 1, F.col("feature"))))
    return report.agg(
        F.count(F.lit(1)).alias("features_tested"),
        F.sum("drifted").alias("features_drifted"),
        F.max("drifted").alias("drift_detected"),
        F.concat_ws(",", names).alias("drifted_features"),
    )


class DriftDetector:
    """Compares any current table with a reference, held as a table or stored as its distribution."""

    def __init__(self, p_value_threshold: float = ALPHA):
        self.p_value_threshold = p_value_threshold
        self.reference: DataFrame | None = None
        self.stored: StoredReference | None = None

    def fit(self, reference: DataFrame) -> DriftDetector:
        self.reference, self.stored = reference, None
        return self

    def save(self, path: str) -> DriftDetector:
        """Store the reference's distribution; from now on the detector reads that, not the reference's rows."""
        if self.reference is None:
            raise ValueError("fit the detector on a reference table first")
        store_reference(self.reference, numeric_names(self.reference), path)
        self.stored = StoredReference(self.reference.sparkSession, path)
        return self

    @classmethod
    def load(cls, spark: SparkSession, path: str, p_value_threshold: float = ALPHA) -> DriftDetector:
        detector = cls(p_value_threshold)
        detector.stored = StoredReference(spark, path)
        return detector

    def detect(self, current: DataFrame) -> DataFrame:
        if self.stored is not None:
            return self.stored.report(current, self.p_value_threshold)
        if self.reference is None:
            raise ValueError("fit the detector on a reference table first")
        return drift_report(self.reference, current, alpha=self.p_value_threshold)
