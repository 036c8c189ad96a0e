"""A stored reference distribution, and the two-sample test of a table against it.

The reference is read once. What is stored is one row for each feature and bucket of values: the bucket's distinct values with their
counts, the rows in the buckets before, and the feature's rows. A later table is collapsed to its distinct values, which meet the
reference only in their own buckets; there, the places of its values among the reference's are found by binary search.

Between two values of the table its distribution is constant and the reference's rises, so the largest gap is at a value of
the table or just before one. NULL and NaN don't count, -0.0 is 0.0, infinities are values. A feature that the table lacks or has no value
for keeps a row without statistic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweft.operators.prefix import bucketed_counts, value_boundaries
from riskweft.operators.tests_of_difference import ALPHA, kolmogorov_tail

#: Rows of the reference in a bucket, about.
ROWS_PER_BUCKET = 100_000


def _packed(counted: DataFrame) -> DataFrame:
    """Sorted values and their counts of every feature and bucket; at most one entry for each distinct value of the bucket."""
    rows = counted.groupBy("feature", "bucket").agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("rows"), F.sum("n").alias("size"))
    return rows.select("feature", "bucket", F.col("rows.value").alias("values"), F.col("rows.n").alias("counts"), "size")


def _with_places(packed: DataFrame) -> DataFrame:
    """Rows in the buckets before, and of the whole feature: a window over one row for each bucket."""
    by_bucket = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return packed.select(
        "*", F.coalesce(F.sum("size").over(by_bucket), F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy("feature")).alias("total")
    )


def store_reference(reference: DataFrame, columns: list[str], path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Write the distribution of the columns to ``path``: ``buckets``, and ``boundaries`` (at most 4096 numbers for each feature)."""
    spark = reference.sparkSession
    boundaries = value_boundaries(reference.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, rows_per_bucket)
    # A bucket without values still has a place.
    every = spark.createDataFrame([(c, b) for c in columns for b in range(len(boundaries[c]) + 1)], "feature string, bucket int")
    packed = _packed(bucketed_counts(reference, columns, boundaries))
    empty = {"values": F.coalesce("values", F.array().cast("array<double>")), "counts": F.coalesce("counts", F.array().cast("array<bigint>"))}
    whole = every.join(packed, ["feature", "bucket"], "left").withColumns(empty).na.fill(0, ["size"])
    _with_places(whole).drop("size").write.mode("overwrite").parquet(f"{path}/buckets")
    rows = [(i, c, boundaries[c]) for i, c in enumerate(columns)]
    spark.createDataFrame(rows, "position int, feature string, boundaries array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/boundaries")


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Largest distance of the two distributions in every bucket."""
    for batch in batches:
        gaps = []
        for row in batch.to_pylist():
            ours, theirs = np.array(row["ref_values"], float), np.array(row["values"], float)
            sums = np.concatenate(([0], np.cumsum(np.array(row["ref_counts"], np.int64)))) + row["ref_before"]
            own = np.cumsum(np.array(row["counts"], np.int64)) + row["before"]
            at = sums[np.searchsorted(ours, theirs, side="right")] / row["ref_total"]
            under = sums[np.searchsorted(ours, theirs, side="left")] / row["ref_total"]
            own_under = np.concatenate(([row["before"]], own[:-1]))
            gaps.append(float(max(np.abs(at - own / row["total"]).max(), np.abs(under - own_under / row["total"]).max())))
        yield pa.RecordBatch.from_arrays([batch.column("feature"), batch.column("total"), pa.array(gaps, pa.float64())], ["feature", "total", "gap"])


class StoredReference:
    """Reads what ``store_reference`` wrote."""

    def __init__(self, spark: SparkSession, path: str):
        rows = spark.read.parquet(f"{path}/boundaries").orderBy("position").collect()  # one row for each feature
        self.boundaries = {r["feature"]: list(r["boundaries"]) for r in rows}
        names = {"values": "ref_values", "counts": "ref_counts", "before": "ref_before", "total": "ref_total"}
        self.buckets = spark.read.parquet(f"{path}/buckets").withColumnsRenamed(names)

    def test(self, current: DataFrame) -> DataFrame:
        """(feature, n_reference, n_current, statistic, p_value) of the two-sample Kolmogorov-Smirnov test."""
        names = [c for c in self.boundaries if c in current.columns]
        sizes = self.buckets.groupBy("feature").agg(F.max("ref_total").alias("n_reference"))
        if not names:
            return sizes.select("feature", "n_reference", F.lit(0).cast("bigint").alias("n_current"), *[F.lit(None).cast("double").alias(c) for c in ("statistic", "p_value")])
        own = _with_places(_packed(bucketed_counts(current, names, self.boundaries)))
        met = own.join(self.buckets, ["feature", "bucket"]).filter("ref_total > 0")
        gaps = met.mapInArrow(_gaps, "feature string, total bigint, gap double")
        best = gaps.groupBy("feature").agg(F.max("total").alias("n_current"), F.max("gap").alias("statistic"))
        out = sizes.join(best, "feature", "left").na.fill(0, ["n_current"])
        effective = F.try_divide(F.col("n_reference").cast("double") * F.col("n_current"), F.col("n_reference") + F.col("n_current"))
        return out.select("feature", "n_reference", "n_current", "statistic", kolmogorov_tail("statistic", effective).alias("p_value"))

    def report(self, current: DataFrame, alpha: float = ALPHA) -> DataFrame:
        """As ``test``, with ``drifted`` (1 where the p-value is below alpha)."""
        drifted = F.coalesce(F.col("p_value") < alpha, F.lit(False)).cast("int").alias("drifted")
        return self.test(current).select("*", drifted)
