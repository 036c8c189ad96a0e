"""Profiling: counts, moments, exact quantiles, crosstabs, histograms. One scan per statistic family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.functions.exprs import numeric_names, percent, rows_from_wide, unpivot
from riskweft.functions.features import hour_of_day
from riskweft.operators.order_stats import exact_quantiles
from riskweft.operators.validation import duplicate_summary
from riskweft.schema import LABEL, NUMERIC_COLUMNS

ALL = "All"


# ---- counts and rates ------------------------------------------------------------------------------------------------


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    """(value, count, percentage) of the non-null values."""
    counts = df.select(value.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", percent(F.col("count"), total))


def null_profile(df: DataFrame, columns: list[str] | None = None, only_missing: bool = False) -> DataFrame:
    """(column, missing, missing_pct) in one scan."""
    names = columns or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    entries = [(F.lit(c), F.col(c), percent(F.col(c), F.col("_rows"))) for c in names]
    long = rows_from_wide(wide, entries, ["column", "missing", "missing_pct"])
    return long.filter("missing > 0") if only_missing else long


def rate_by(df: DataFrame, key: Column, name: str, label: str = LABEL) -> DataFrame:
    """(key, total, fraud, fraud_rate in percent)."""
    return df.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("total"), F.sum(label).alias("fraud"), (F.avg(label) * F.lit(100.0)).alias("fraud_rate")
    )


def rate_by_hour(df: DataFrame, label: str = LABEL) -> DataFrame:
    return rate_by(df, hour_of_day(F.col("step")), "hour_of_day", label)


def rolling_rate(df: DataFrame, window_rows: int = 24, label: str = LABEL) -> DataFrame:
    """Mean of the per-hour fraud rate over the last ``window_rows`` hours that have rows.

    The window runs over one row per hour, so its single task holds the number of hours, not of transactions.
    """
    hourly = df.groupBy("step").agg(F.avg(label).alias("fraud_rate"))
    frame = Window.orderBy("step").rowsBetween(-(window_rows - 1), 0)
    full = F.count("fraud_rate").over(frame) == window_rows
    return hourly.select("step", "fraud_rate", F.when(full, F.avg("fraud_rate").over(frame)).alias("rolling_rate"))


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: totals, number of classes, minority/majority ratio (1 for one class) and majority:minority (NULL then)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    summed = counts.agg(
        F.sum("n").alias("total_samples"), F.count(F.lit(1)).alias("n_classes"), F.min("n").alias("minority"), F.max("n").alias("majority")
    )
    several = F.col("n_classes") > 1
    return summed.select(
        "total_samples",
        "n_classes",
        "minority",
        "majority",
        F.when(several, F.col("minority") / F.col("majority")).otherwise(1.0).alias("imbalance_ratio"),
        F.when(several, F.col("majority") / F.col("minority")).alias("majority_to_minority"),
    )


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long crosstab (row, column, n) with "All" margins."""
    cells = df.cube(row, column).agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("_gr"), F.grouping(column).alias("_gc"))
    return cells.select(
        F.when(F.col("_gr") == 1, ALL).otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("_gc") == 1, ALL).otherwise(F.col(column).cast("string")).alias(column),
        "n",
    )


def crosstab_wide(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Wide crosstab: one column per value of ``column`` and the row total."""
    pivot = [F.count_if(F.col(column) == F.lit(v)).alias(f"n_{v}") for v in values]
    return df.groupBy(row).agg(*pivot, F.count(F.lit(1)).alias("total"))


def crosstab_row_percent(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Wide crosstab as a percentage of each row."""
    wide = crosstab_wide(df, row, column, values)
    return wide.select(row, *[percent(F.col(f"n_{v}"), F.col("total")).alias(f"pct_{v}") for v in values])


def positive_share(df: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """(key, count, percentage): how the positive rows spread over the key."""
    return value_counts(df.filter(F.col(label) == 1), F.col(key), key)


def most_common(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value; the smallest on ties."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(1)


# ---- moments and describe --------------------------------------------------------------------------------------------


def corrected_skewness(column: str) -> Column:
    """Bias-corrected skewness (n >= 3); 0 for a constant column."""
    n = F.count(column).cast("double")
    raw = F.coalesce(F.skewness(column), F.lit(0.0))
    return F.when(n >= 3, raw * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(column: str) -> Column:
    """Bias-corrected excess kurtosis (n >= 4)."""
    n = F.count(column).cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(column) + 6))


def skew_label(skew: Column) -> Column:
    size = F.abs(skew)
    return F.when(size > 1, "Highly skewed").when(size > 0.5, "Moderately skewed").otherwise("Approximately symmetric")


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, skewness, kurtosis, interpretation)."""
    wide = df.agg(*[corrected_skewness(c).alias(f"s_{c}") for c in columns], *[corrected_kurtosis(c).alias(f"k_{c}") for c in columns])
    entries = [(F.lit(c), F.col(f"s_{c}"), F.col(f"k_{c}"), skew_label(F.col(f"s_{c}"))) for c in columns]
    return rows_from_wide(wide, entries, ["feature", "skewness", "kurtosis", "interpretation"])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max) with exact linear quantiles."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])[None]
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    entries = []
    for c in columns:
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        entries.append((F.lit(c), F.col(c)["count"], F.col(c)["mean"], F.col(c)["std"], F.col(c)["min"], *q, F.col(c)["max"]))
    return rows_from_wide(wide, entries, ["feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def quantile_table(df: DataFrame, columns: list[str], probabilities: list[float], by: str | None = None) -> DataFrame:
    """(group, feature, probability, value) of the exact quantiles."""
    spark = df.sparkSession
    found = exact_quantiles(df, columns, probabilities, by)
    rows = [(None if g is None else str(g), c, p, v) for g, cols in found.items() for c, vs in cols.items() for p, v in zip(probabilities, vs)]
    return spark.createDataFrame(rows, "group string, feature string, probability double, value double")


def amount_by_class(df: DataFrame, column: str = "amount", label: str = LABEL) -> DataFrame:
    """(label, mean, median, std, max) of one column."""
    median = _per_group(exact_quantiles(df, [column], [0.5], by=label), column, 0, label)
    stats = df.groupBy(label).agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.max(column).alias("max"))
    return stats.select(label, "mean", median.alias("median"), "std", "max")


def _per_group(found: dict[object, dict[str, list]], column: str, position: int, by: str) -> Column:
    """The group's own number out of ``exact_quantiles``, as a CASE over the few group values."""
    value = F.lit(None).cast("double")
    for group, columns in found.items():
        value = F.when(F.col(by).eqNullSafe(F.lit(group)), F.lit(columns[column][position])).otherwise(value)
    return value


def class_feature_means(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS, label: str = LABEL) -> DataFrame:
    """(feature, label, mean, median) for every numeric column and class; one row per class leaves the scan."""
    medians = exact_quantiles(df, columns, [0.5], by=label)
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean"), _per_group(medians, c, 0, label).alias("median")) for c in columns
    ]
    return means.select(label, F.inline(F.array(*cells)))


def centre_markers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, median)."""
    medians = exact_quantiles(df, columns, [0.5])[None]
    wide = df.agg(*[F.avg(c).alias(c) for c in columns])
    return rows_from_wide(wide, [(F.lit(c), F.col(c), F.lit(medians[c][0])) for c in columns], ["feature", "mean", "median"])


# ---- plot data -------------------------------------------------------------------------------------------------------


def histogram(df: DataFrame, columns: list[str], bins: int = 50, by: str | None = None) -> DataFrame:
    """(feature[, by], bin, bin_start, count, density): equal-width bins, the last one closed on the right.

    Bins span the whole column; a constant column gets a unit-wide range around its value.
    """
    ranges = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]).first()
    low, width = F.lit(None).cast("double"), F.lit(None).cast("double")
    for c in columns:
        lo, hi = ranges[c]["lo"], ranges[c]["hi"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        low = F.when(F.col("feature") == c, F.lit(lo)).otherwise(low)
        width = F.when(F.col("feature") == c, F.lit((hi - lo) / bins)).otherwise(width)
    keep = [by] if by else []
    place = F.least(F.floor((F.col("value") - low) / width).cast("int"), F.lit(bins - 1))
    long = unpivot(df, columns, keep=keep).filter("value IS NOT NULL")
    counted = long.groupBy("feature", *keep, place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # One row per feature, class and bin from here on.
    total = F.sum("count").over(Window.partitionBy("feature", *keep))
    return counted.select(
        "feature",
        *keep,
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        "count",
        (F.col("count") / (total * width)).alias("density"),
    )


def box_stats(df: DataFrame, columns: list[str], by: str = LABEL) -> DataFrame:
    """(feature, by, n, q1, median, q3, whisker_low, whisker_high, outliers) with 1.5 IQR fences; one row per class leaves the scan."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=by)
    measures, cells = [], []
    for c in columns:
        q1, median, q3 = (_per_group(quartiles, c, i, by) for i in range(3))
        value, spread = F.col(c).cast("double"), q3 - q1
        inside = (value >= q1 - 1.5 * spread) & (value <= q3 + 1.5 * spread)
        measures.append(
            F.struct(
                F.count(c).alias("n"),
                F.min(F.when(inside, value)).alias("whisker_low"),
                F.max(F.when(inside, value)).alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            ).alias(c)
        )
        names = ["n", "whisker_low", "whisker_high", "outliers"]
        cells.append(
            F.struct(
                F.lit(c).alias("feature"), q1.alias("q1"), median.alias("median"), q3.alias("q3"), *[F.col(c)[n].alias(n) for n in names]
            )
        )
    return df.groupBy(by).agg(*measures).select(by, F.inline(F.array(*cells))).filter("n > 0")


# ---- composites ------------------------------------------------------------------------------------------------------


def explore(df: DataFrame) -> dict[str, DataFrame]:
    """The standard exploration as a set of lazy tables."""
    return {
        "missing": null_profile(df),
        "classes": value_counts(df, F.col(LABEL), LABEL),
        "balance": class_balance(df),
        "types": value_counts(df, F.col("type"), "type"),
        "fraud_by_type": rate_by(df, F.col("type"), "type"),
        "amount": describe(df, ["amount"]),
        "amount_by_class": amount_by_class(df),
    }


def explore_long(df: DataFrame) -> DataFrame:
    """The exploration as one (section, item, measure, value) table."""
    parts = []
    keys = {"missing": "column", "classes": LABEL, "types": "type", "fraud_by_type": "type", "amount": "feature", "amount_by_class": LABEL}
    for section, table in explore(df).items():
        item = F.col(keys[section]).cast("string") if section in keys else F.lit("all")
        measures = numeric_names(table, exclude=(keys.get(section, ""),))
        wide = table.select(F.lit(section).alias("section"), item.alias("item"), *[F.col(m).cast("double").alias(m) for m in measures])
        parts.append(wide.unpivot(["section", "item"], measures, "measure", "value"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def eda_summary(df: DataFrame, amount: str = "amount", label: str = LABEL) -> DataFrame:
    """One row of headline figures."""
    median = exact_quantiles(df, [amount], [0.5])[None][amount][0]
    copies = duplicate_summary(df)
    missing = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total_missing = missing[0]
    for m in missing[1:]:
        total_missing = total_missing + m
    mode = most_common(df, "type").select("type").scalar()
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.lit(len(df.columns)).alias("features"),
        (F.avg(label) * F.lit(100.0)).alias("fraud_rate"),
        F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("imbalance_ratio"),
        total_missing.alias("missing_values"),
        F.avg(amount).alias("mean_amount"),
        corrected_skewness(amount).alias("amount_skewness"),
    ).withColumns(
        {
            "duplicates": copies.select("duplicates").scalar(),
            "median_amount": F.lit(median),
            "common_type": mode,
        }
    )
