"""Running totals over the ordered distinct values of a column, without a single-task window.

Rows are first collapsed to one row per distinct value with map-side aggregation, so a hot value is one row. The value
axis is cut at approximate quantiles; the bucket of a value is a pure function of the value (the boundaries are
literals), so a recomputed task always lands in the same bucket. Totals per bucket are few enough for one small window
and a broadcast, and the running total inside a bucket is an ordinary partitioned window.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
SKETCH_ACCURACY = 20_000


def value_boundaries(df: DataFrame, columns: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, list[float]]:
    """Interior bucket boundaries per column (none when one bucket is enough): one scan, no data shuffle."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    need = {c: min(MAX_BUCKETS, math.ceil(counts[c] / rows_per_bucket)) for c in columns}
    large = [c for c in columns if need[c] > 1]
    if not large:
        return {c: [] for c in columns}
    sketched = df.agg(
        *[F.percentile_approx(c, [i / need[c] for i in range(1, need[c])], SKETCH_ACCURACY).alias(c) for c in large]
    ).first()
    # Infinities are the outer ends already.
    return {c: sorted({b for b in sketched[c] if math.isfinite(b)}) if c in large else [] for c in columns}


def _with_buckets(df: DataFrame, columns: list[str], boundaries: dict[str, list[float]]) -> DataFrame:
    for c in columns:
        if boundaries[c]:
            splits = [-float("inf"), *boundaries[c], float("inf")]
            df = Bucketizer(splits=splits, inputCol=c, outputCol=f"_b_{c}", handleInvalid="keep").transform(df)
            df = df.withColumn(f"_b_{c}", F.col(f"_b_{c}").cast("int"))
        else:
            df = df.withColumn(f"_b_{c}", F.lit(0))
    return df


def _collapsed(base: DataFrame, columns: list[str], measures: list[str], boundaries: dict[str, list[float]]) -> DataFrame:
    """Sums of the measures by feature, bucket and distinct value. -0.0 and 0.0 are one value for grouping and ordering alike."""
    tagged = _with_buckets(base, columns, boundaries)
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"_b_{c}").alias("bucket"), F.col(c).alias("value")) for c in columns]
    )
    long = tagged.select(F.inline(cells), *measures).filter("value IS NOT NULL AND NOT isnan(value)")
    return long.groupBy("feature", "bucket", "value").agg(*[F.sum(m).alias(m) for m in measures])


def bucketed_counts(df: DataFrame, columns: list[str], boundaries: dict[str, list[float]]) -> DataFrame:
    """(feature, bucket, value, n) of every distinct value, in buckets of given boundaries."""
    base = df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.lit(1).cast("bigint").alias("n"))
    return _collapsed(base, columns, ["n"], boundaries)


def cumulative_by_value(
    df: DataFrame,
    columns: list[str],
    measures: dict[str, Column],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(feature, value, m, cum_m, total_m) per distinct non-null value of every column.

    ``m`` is the sum of the measure at the value, ``cum_m`` the sum up to and including it, ``total_m`` over all.
    """
    base = df.select(*[F.col(c).cast("double").alias(c) for c in columns], *[m.alias(n) for n, m in measures.items()])
    collapsed = _collapsed(base, columns, list(measures), value_boundaries(base, columns, rows_per_bucket))

    by_bucket = Window.partitionBy("feature").orderBy("bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    totals = collapsed.groupBy("feature", "bucket").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = totals.select(
        F.col("feature").alias("_feature"),
        F.col("bucket").alias("_bucket"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"total_{m}") for m in measures],
    )
    inside = Window.partitionBy("feature", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local = collapsed.select("*", *[F.sum(m).over(inside).alias(f"_cum_{m}") for m in measures])
    # At most MAX_BUCKETS rows per column.
    joined = local.join(
        F.broadcast(offsets), (F.col("feature") == F.col("_feature")) & (F.col("bucket") == F.col("_bucket"))
    )
    return joined.select(
        "feature",
        "value",
        *measures,
        *[(F.col(f"_cum_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def running_total(df: DataFrame, order: list[Column], column: str, output: str) -> DataFrame:
    """Running total over a table known to be small (one row per component, hour or candidate)."""
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(output, F.sum(column).over(window))
