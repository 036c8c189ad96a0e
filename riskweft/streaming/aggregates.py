"""Streaming aggregations: windowed fraud rates and running account counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.schema import LABEL
from riskweft.streaming.runner import BatchHandler, write_batch

WINDOW_SCHEMA = "window_start timestamp, total bigint, fraud bigint"
ACCOUNT_SCHEMA = "account string, n bigint"


def windowed_counts(df: DataFrame, time: str = "ts", length: str = "24 hours", slide: str = "1 hour", lateness: str = "48 hours", label: str = LABEL) -> DataFrame:
    """(window_start, total, fraud) per sliding event-time window; rows later than the watermark are dropped."""
    timed = df.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", lateness)
    counted = timed.groupBy(F.window("_t", length, slide)).agg(F.count(F.lit(1)).alias("total"), F.sum(label).alias("fraud"))
    return counted.select(F.col("window.start").alias("window_start"), "total", "fraud")


def account_counts(df: DataFrame, account: str = "nameOrig") -> DataFrame:
    """(account, n): running number of rows per account. The state holds one counter per account."""
    present = df.filter(F.col(account).isNotNull())
    return present.groupBy(F.col(account).alias("account")).agg(F.count(F.lit(1)).alias("n"))


def update_handler(out: str) -> BatchHandler:
    """For update mode: each batch stores the groups it changed."""
    return lambda batch, batch_id: write_batch(batch, out, batch_id)


def latest_windows(batches: DataFrame) -> DataFrame:
    """Last state of every window, with the rate in percent."""
    last = batches.groupBy("window_start").agg(F.max_by(F.struct("total", "fraud"), "batch_id").alias("s"))
    return last.select("window_start", "s.total", "s.fraud", (F.col("s.fraud") * F.lit(100.0) / F.col("s.total")).alias("fraud_rate"))


def latest_accounts(batches: DataFrame) -> DataFrame:
    """Counts only grow, so the largest is the last."""
    return batches.groupBy("account").agg(F.max("n").alias("n"))
