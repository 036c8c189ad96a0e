"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys,
# whatever the data size: the only table broadcast below is bounded by this number of rows.
HOT_SHARE = 2000
# Rows that take no part in the shuffled join (hot or NULL key) are spread over this many salt values.
SPREAD = 997


def join_key_counts(df: DataFrame, key: str, output: str) -> DataFrame:
    """Left join of the per-key row counts back to every row; a NULL key gets a NULL count.

    Hot keys are answered by a broadcast of at most HOT_SHARE rows. The others go through a shuffled join
    whose key carries a salt: 0 for rows that join, a hash of the row for rows that cannot match.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg(F.sum("_n") / F.lit(float(HOT_SHARE))).scalar()
    hot = counts.filter(F.col("_n") > limit).select(F.col(key).alias("_hot_key"), F.col("_n").alias("_hot_n"))
    cold = counts.filter(F.col("_n") <= limit).select(
        F.col(key).alias("_key"), F.col("_n").alias("_cold_n"), F.lit(0).alias("_slot")
    )

    others = [c for c in df.columns if c != key]
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    idle = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    spread = 1 + F.pmod(F.xxhash64(*(others or [key])), F.lit(SPREAD)).cast("int")
    marked = marked.withColumn("_salt", F.when(idle, spread).otherwise(0))
    joined = marked.join(cold, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_slot")), "left")
    return joined.select(*df.columns, F.coalesce("_hot_n", "_cold_n").alias(output))


def account_frequencies(df: DataFrame) -> DataFrame:
    """How often each row's origin and destination account occurs in its own column."""
    df = join_key_counts(df, "nameOrig", "orig_account_frequency")
    return join_key_counts(df, "nameDest", "dest_account_frequency")
