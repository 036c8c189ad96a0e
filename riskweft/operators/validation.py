"""Type coercion, table checks and row validation. Every check is one aggregation over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import all_of, any_of, digest, finite, flag, rows_from_wide
from riskweft.schema import COLUMN_TYPES, LABEL, MONEY_COLUMNS, REQUEST_FIELDS, REQUIRED_COLUMNS, missing_columns


def coerce(column: str, data_type: str) -> Column:
    """Value as the target type; text that does not parse, NaN and non-integral integers become NULL."""
    c = F.col(column)
    if data_type in ("double", "float"):
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number).cast(data_type)
    if data_type in ("int", "bigint"):
        number = c.try_cast("double")
        exact = c.cast("string").try_cast(data_type)
        return F.coalesce(exact, F.when(number == F.floor(number), number).try_cast(data_type))
    return c.cast(data_type)


def cast_schema(df: DataFrame, types: dict[str, str] = COLUMN_TYPES) -> DataFrame:
    """Coerce the known columns that are present, leave the others as they are."""
    return df.select(*[coerce(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def cast_failures(df: DataFrame, types: dict[str, str] = COLUMN_TYPES) -> DataFrame:
    """Per column: values that were present and could not be coerced."""
    names = [c for c in df.columns if c in types]
    wide = df.agg(*[F.count_if(F.col(c).isNotNull() & coerce(c, types[c]).isNull()).alias(c) for c in names])
    return rows_from_wide(wide, [(F.lit(c), F.lit(types[c]), F.col(c)) for c in names], ["column", "data_type", "failed"])


def require_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    absent = missing_columns(df.columns, required)
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def _check_columns(df: DataFrame) -> dict[str, Column]:
    checks = {"rows": F.count(F.lit(1))}
    checks |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in REQUIRED_COLUMNS if c in df.columns}
    if LABEL in df.columns:
        checks["class_0"] = F.count_if(F.col(LABEL) == 0)
        checks["class_1"] = F.count_if(F.col(LABEL) == 1)
    if "amount" in df.columns:
        checks["negative_amount"] = F.count_if(F.col("amount") < 0)
    return checks


def _long(wide: DataFrame) -> DataFrame:
    return rows_from_wide(wide, [(F.lit(c), F.col(c)) for c in wide.columns], ["check", "count"])


def validate_table(df: DataFrame) -> DataFrame:
    """(check, count): row, null, class and negative-amount counts. Missing columns or no rows raise."""
    require_rows(require_columns(df))
    return _long(df.agg(*[v.alias(k) for k, v in _check_columns(df).items()]))


def duplicate_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, second-and-later copies of identical rows, and their share; NULLs compare equal.

    Rows are grouped by a digest of 128 bits, so the shuffle holds digests instead of rows.
    """
    copies = df.select(*digest(*(columns or df.columns))).groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("_n"))
    summed = copies.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    return summed.select("rows", "duplicates", F.try_divide(F.col("duplicates") * F.lit(100.0), F.col("rows")).alias("duplicate_pct"))


def validate_extract(df: DataFrame) -> DataFrame:
    """As ``validate_table``, with duplicates and the fraud rate in percent: one scan and one shuffle of the rows."""
    require_rows(require_columns(df))
    checks = {k: v.cast("double") for k, v in _check_columns(df).items()}
    checks["fraud_rate_pct"] = F.avg(LABEL) * F.lit(100.0)
    wide = df.agg(*[v.alias(k) for k, v in checks.items()])
    base = rows_from_wide(wide, [(F.lit(c), F.col(c)) for c in checks], ["check", "value"])
    copies = duplicate_summary(df).select(F.lit("duplicates").alias("check"), F.col("duplicates").cast("double").alias("value"))
    return base.unionByName(copies)


def clean_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a NULL in the columns (by default all) and with a non-negative amount. NaN is a value, larger than any other."""
    return df.filter(all_of([F.col(c).isNotNull() for c in columns or df.columns])).filter("amount >= 0")


def drop_non_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinities and NaN count as missing; rows missing any of the columns are dropped."""
    return df.withColumns({c: finite(F.col(c)) for c in columns}).dropna("any", subset=columns)


def negative_counts(df: DataFrame, columns: list[str] = MONEY_COLUMNS) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])
    return rows_from_wide(wide, [(F.lit(c), F.col(c)) for c in columns], ["column", "negative_values"])


BAD_TYPES = "Invalid data types in transaction"


def request_error(absent: Column | None = None) -> Column:
    """First problem of a scoring request, NULL when it is fine.

    ``absent`` is an optional array of the field names the request does not carry at all.
    """
    numbers = [F.col(c).cast("string").try_cast("double").isNull() for c in MONEY_COLUMNS]
    numbers.append(F.col("step").cast("string").try_cast("bigint").isNull())
    error = F.when(any_of(numbers), BAD_TYPES)
    for field in reversed(REQUEST_FIELDS):
        error = F.when(F.col(field).isNull(), f"Field {field} cannot be None").otherwise(error)
        if absent is not None:
            error = F.when(F.array_contains(absent, field), f"Missing required field: {field}").otherwise(error)
    return error


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``is_valid`` (1/0) and ``error`` to every request row."""
    checked = df.withColumn("error", request_error())
    return checked.withColumn("is_valid", flag(F.col("error").isNull()))


def validate_payloads(df: DataFrame, payload: str) -> DataFrame:
    """Validate one JSON object per row, telling an absent field from a null one."""
    text = {f: F.get_json_object(F.col(payload), f"$.{f}") for f in REQUEST_FIELDS}
    keys = F.json_object_keys(F.col(payload))
    absent = F.array_except(F.array(*[F.lit(f) for f in REQUEST_FIELDS]), F.coalesce(keys, F.array().cast("array<string>")))
    parsed = df.withColumns({**text, "_absent": absent})
    checked = parsed.withColumn("error", request_error(F.col("_absent"))).drop("_absent")
    return checked.withColumn("is_valid", flag(F.col("error").isNull()))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the quarantine with the reason of each rejected row."""
    checked = validate_requests(df)
    return checked.filter("is_valid = 1").drop("is_valid", "error"), checked.filter("is_valid = 0").drop("is_valid")
