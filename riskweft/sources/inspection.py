"""Inspection of a table: size, schema, head and distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import digest, rows_from_wide
from riskweft.schema import COLUMN_TYPES


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability, and the row count of the table."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    entries = [
        (F.lit(i), F.lit(f.name), F.lit(f.dataType.simpleString()), F.lit(f.nullable), F.col("n"))
        for i, f in enumerate(df.schema.fields)
    ]
    return rows_from_wide(counted, entries, ["position", "column", "data_type", "nullable", "row_count"])


def head_rows(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First rows in a stated order, taken per partition before they are merged."""
    return df.orderBy(*order_by).limit(n)


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values of every column in one scan, next to the expected type."""
    names = columns or [c for c in COLUMN_TYPES if c in df.columns]
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in names])
    else:
        wide = distinct_wide(df, names)
    entries = [(F.lit(c), F.lit(COLUMN_TYPES.get(c, "string")), F.col(c)) for c in names]
    return rows_from_wide(wide, entries, ["column", "expected_type", "unique_values"])


def distinct_wide(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of distinct non-null values of each column.

    A value is a number of its column and a digest of 128 bits; the first grouping drops repeats before anything is shuffled, so
    the shuffle follows the distinct values of the partitions, not rows times columns.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("of"), *digest(c), F.col(c).isNotNull().alias("held")) for i, c in enumerate(columns)])
    values = df.select(F.inline(cells)).filter("held").groupBy("of", "d0", "d1").agg(F.lit(1).alias("one"))
    return values.agg(*[F.count_if(F.col("of") == i).alias(c) for i, c in enumerate(columns)])


def inspection_report(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """(section, item, value) rows holding schema, distinct counts and the head of the table as JSON."""
    info = table_info(df).select(
        F.lit("schema").alias("section"), F.col("column").alias("item"), F.col("data_type").alias("value")
    )
    size = df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit("table").alias("section"), F.lit("row_count").alias("item"), "value"
    )
    distinct = distinct_counts(df).select(
        F.lit("distinct").alias("section"), F.col("column").alias("item"), F.col("unique_values").cast("string").alias("value")
    )
    head = head_rows(df, order_by, n).select(
        F.lit("head").alias("section"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in order_by]).alias("item"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
    return info.unionByName(size).unionByName(distinct).unionByName(head)
