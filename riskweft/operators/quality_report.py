"""Data-quality report: every section is a lazy table; text is rendered from the small results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import rows_from_wide
from riskweft.operators.order_stats import exact_quantiles
from riskweft.operators.outliers import iqr_condition
from riskweft.operators.profile import corrected_skewness
from riskweft.operators.validation import duplicate_summary
from riskweft.schema import LABEL, MONEY_COLUMNS, NUMERIC_COLUMNS

SEVERE_IMBALANCE_PCT = 1.0
SKEW_LIMIT = 1.0
OUTLIER_PCT_LIMIT = 5.0


def _facts(df: DataFrame) -> DataFrame:
    """One wide row with everything except the duplicates, from one scan (the quartiles are literals by then)."""
    quartiles = exact_quantiles(df, MONEY_COLUMNS, [0.25, 0.75])[None]
    outliers = [
        (F.count_if(iqr_condition(c, *quartiles[c])) if quartiles[c][0] is not None else F.lit(0)).alias(f"out_{c}") for c in MONEY_COLUMNS
    ]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(LABEL) == 1).alias("fraud"),
        F.count_if(F.col(LABEL) == 0).alias("legit"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
        *outliers,
        *[corrected_skewness(c).alias(f"skew_{c}") for c in NUMERIC_COLUMNS],
    )


def _rate() -> Column:
    return F.try_divide(F.col("fraud") * F.lit(100.0), F.col("fraud") + F.col("legit"))


def _outlier_pct(column: str) -> Column:
    return F.try_divide(F.col(f"out_{column}") * F.lit(100.0), F.col("rows"))


def quality_report(df: DataFrame) -> DataFrame:
    """(section, item, value) over overview, missing values, outliers and skewness."""

    def entry(section: str, item: str, value: Column) -> tuple:
        return F.lit(section), F.lit(item), value.cast("double")

    entries = [
        entry("overview", "rows", F.col("rows")),
        entry("overview", "fraud_cases", F.col("fraud")),
        entry("overview", "legitimate_cases", F.col("legit")),
        entry("overview", "fraud_rate_pct", _rate()),
        entry("overview", "imbalance_ratio", F.try_divide("legit", "fraud")),
        *[entry("missing", c, F.col(f"null_{c}")) for c in df.columns],
        *[entry("outlier_pct", c, _outlier_pct(c)) for c in MONEY_COLUMNS],
        *[entry("skewness", c, F.col(f"skew_{c}")) for c in NUMERIC_COLUMNS],
    ]
    report = rows_from_wide(_facts(df), entries, ["section", "item", "value"])
    copies = duplicate_summary(df).select(
        F.lit("overview").alias("section"), F.lit("duplicates").alias("item"), F.col("duplicates").cast("double").alias("value")
    )
    return report.unionByName(copies)


def recommendations(df: DataFrame) -> DataFrame:
    """(rule, detail) rows for the rules that hold."""
    heavy = F.greatest(*[_outlier_pct(c) for c in MONEY_COLUMNS]) > OUTLIER_PCT_LIMIT
    entries = [
        (F.lit("severe_class_imbalance"), F.lit("resample or weight the classes"), _rate() < SEVERE_IMBALANCE_PCT),
        *[(F.lit("log_transform"), F.lit(c), F.abs(F.col(f"skew_{c}")) > SKEW_LIMIT) for c in NUMERIC_COLUMNS],
        (F.lit("robust_scaling"), F.lit("prefer the robust scaler"), heavy),
    ]
    return rows_from_wide(_facts(df), entries, ["rule", "detail", "holds"]).filter("holds").drop("holds")


def render_markdown(report: DataFrame, advice: DataFrame) -> str:
    """Markdown text of a report; both tables have a bounded number of rows (columns x sections)."""
    lines = ["# Data quality report", ""]
    section = None
    for row in report.orderBy("section", "item").collect():
        if row["section"] != section:
            section = row["section"]
            lines += ["", f"## {section}", "", "| item | value |", "|---|---|"]
        value = "" if row["value"] is None else f"{row['value']:,.4f}"
        lines.append(f"| {row['item']} | {value} |")
    lines += ["", "## recommendations", ""]
    lines += [f"- {r['rule']}: {r['detail']}" for r in advice.orderBy("rule", "detail").collect()]
    return "\n".join(lines) + "\n"
