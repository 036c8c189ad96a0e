"""Sinks. Each writes in parallel, one file set per partition."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

FORMATS = ("csv", "parquet", "json", "orc")


def export_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Whole-table export; snappy for parquet, a header line for csv; an unknown format is an error."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, choose one of {FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def write_predictions(df: DataFrame, folder: str, name: str | None = None, fmt: str = "csv") -> str:
    """Prediction sink; the default name carries the time of writing."""
    name = name or f"predictions_{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}"
    return export_table(df, f"{folder.rstrip('/')}/{name}", fmt)
