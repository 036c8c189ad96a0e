"""Readers. All are lazy and partitioned by Spark; none of them pulls rows to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweft.operators.validation import cast_schema, require_columns
from riskweft.schema import REQUEST_FIELDS, TRANSACTION_SCHEMA

REQUEST_SCHEMA = T.StructType([f for f in TRANSACTION_SCHEMA.fields if f.name in REQUEST_FIELDS])


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", max_rows: int | None = None, **options) -> DataFrame:
    """Scan of a table; a missing path is an error; ``max_rows`` of None or 0 means all rows."""
    return cap_rows(spark.read.format(fmt).options(**options).load(path), max_rows)


def cap_rows(df: DataFrame, max_rows: int | None) -> DataFrame:
    return df.limit(max_rows) if max_rows else df


def load_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, low: int, high: int, partitions: int) -> DataFrame:
    """Parallel range reads of a database table; filters and column lists are pushed into the database."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column)
        .options(lowerBound=low, upperBound=high, numPartitions=partitions, fetchsize=10000)
        .load()
    )


def load_and_prepare(df: DataFrame, convert_types: bool = True, validate: bool = True, max_rows: int | None = None) -> DataFrame:
    """Cap, cast and check a raw table."""
    df = cap_rows(df, max_rows)
    if convert_types:
        df = cast_schema(df)
    if validate:
        require_columns(df)
    return df


def read_requests_csv(spark: SparkSession, path: str, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def query_source(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Rows of any SQL text; the frames are referenced as {name} inside it."""
    return spark.sql(sql, **views)


def parse_records(payload: Column | str, schema: T.StructType = REQUEST_SCHEMA) -> Column:
    """Array of records in a JSON text holding one object or a list of objects."""
    text = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(text, T.ArrayType(schema))


def read_json_records(df: DataFrame, payload: str, keep: list[str] | None = None, schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """One row per record of the JSON column, with its position in the payload."""
    kept = keep or []
    exploded = df.select(*kept, F.posexplode(parse_records(payload, schema)).alias("record_index", "record"))
    return exploded.select(*kept, "record_index", "record.*")
