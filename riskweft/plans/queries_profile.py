"""Checked queries: profiling, outliers, correlations and quality reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.functions.features import account_prefix, interaction_features
from riskweft.operators import correlation, outliers, profile, quality_report, validation
from riskweft.plans.queries_features import GAPS, INTERACTION_NAMES, INTERACTION_SQL, gaps
from riskweft.plans.registry import query
from riskweft.sources.inspection import distinct_wide
from riskweft.schema import MONEY_COLUMNS, NUMERIC_COLUMNS, REQUIRED_COLUMNS
from riskweft.sources.transactions import read_table, transactions, transactions_with_gaps

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# ---- counts and rates ------------------------------------------------------------------------------------------------


def _value_counts_sql(expr: str, name: str, table: str) -> str:
    return (
        f"""SELECT {expr} AS {name}, count(*) AS "count", round(count(*) * 100.0e0 / (SELECT count({expr}) FROM {table}), 6) AS percentage """
        f"FROM {table} WHERE {expr} IS NOT NULL GROUP BY 1"
    )


@query("e1_type_counts", _value_counts_sql("type", "type", "txn_gaps"))
def _(spark, sf):
    return round_doubles(profile.value_counts(transactions_with_gaps(spark, sf), F.col("type"), "type"))


@query("e1_class_counts", _value_counts_sql("isFraud", "isFraud", "txn"))
def _(spark, sf):
    return round_doubles(profile.value_counts(transactions(spark, sf), F.col("isFraud"), "isFraud"))


@query("e1_account_prefix_counts", _value_counts_sql("substr(nameDest, 1, 1)", "dest_type", "txn_gaps"))
def _(spark, sf):
    return round_doubles(profile.value_counts(transactions_with_gaps(spark, sf), account_prefix(F.col("nameDest")), "dest_type"))


@query(
    "e2_null_profile",
    union(
        [
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0e0 / count(*), 6) AS missing_pct FROM txn_gaps HAVING count(*) > count({c})"""
            for c in REQUIRED_COLUMNS
        ]
    ),
)
def _(spark, sf):
    return round_doubles(profile.null_profile(transactions_with_gaps(spark, sf), REQUIRED_COLUMNS, only_missing=True))


@query("e3_distinct_counts", "SELECT count(DISTINCT type) AS types, count(DISTINCT nameOrig) AS origins, count(DISTINCT nameDest) AS destinations FROM txn_gaps")
def _(spark, sf):
    wide = distinct_wide(transactions_with_gaps(spark, sf), ["type", "nameOrig", "nameDest"])
    return wide.withColumnsRenamed({"type": "types", "nameOrig": "origins", "nameDest": "destinations"})


DUP_SQL = """SELECT n AS "rows", n - d AS duplicates, round((n - d) * 100.0e0 / n, 6) AS duplicate_pct FROM
  (SELECT (SELECT count(*) FROM s) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM s) u) AS d) c"""


@query("e5_duplicates", DUP_SQL, ctes="s AS (SELECT step, type, nameDest FROM txn_gaps)")
def _(spark, sf):
    return round_doubles(validation.duplicate_summary(transactions_with_gaps(spark, sf).select("step", "type", "nameDest")))


@query("e5_lineitem_duplicates", DUP_SQL, ctes="s AS (SELECT l_partkey, l_quantity, l_returnflag FROM lineitem)")
def _(spark, sf):
    return round_doubles(validation.duplicate_summary(read_table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_returnflag")))


@query("f12_distinct_rows", "SELECT DISTINCT step, type, nameDest FROM txn_gaps")
def _(spark, sf):
    return transactions_with_gaps(spark, sf).select("step", "type", "nameDest").distinct()


@query(
    "e15_rate_by_hour",
    "SELECT step % 24 AS hour_of_day, count(*) AS total, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud) * 100.0, 6) AS fraud_rate FROM txn GROUP BY 1",
)
def _(spark, sf):
    return round_doubles(profile.rate_by_hour(transactions(spark, sf)))


@query(
    "e15_rate_by_type_ranked",
    "SELECT type, round(avg(isFraud) * 100.0, 6) AS fraud_rate, rank() OVER (ORDER BY avg(isFraud) DESC) AS place FROM txn GROUP BY type",
)
def _(spark, sf):
    from pyspark.sql import Window

    rates = profile.rate_by(transactions(spark, sf), F.col("type"), "type")
    ranked = rates.select("type", "fraud_rate", F.rank().over(Window.orderBy(F.desc("fraud_rate"))).cast("bigint").alias("place"))
    return round_doubles(ranked)


@query(
    "f1_rolling_fraud_rate",
    """SELECT step, round(fraud_rate, 9) AS fraud_rate, round(CASE WHEN count(*) OVER w = 24 THEN avg(fraud_rate) OVER w END, 9) AS rolling_rate
       FROM (SELECT step, avg(isFraud) AS fraud_rate FROM txn GROUP BY step) h WINDOW w AS (ORDER BY step ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    return round_doubles(profile.rolling_rate(transactions(spark, sf)), 9)


@query(
    "e17_crosstab",
    """SELECT CASE WHEN grouping(type) = 1 THEN 'All' ELSE type END AS type, CASE WHEN grouping(isFraud) = 1 THEN 'All' ELSE CAST(isFraud AS VARCHAR) END AS isFraud,
       count(*) AS n FROM txn GROUP BY CUBE (type, isFraud)""",
)
def _(spark, sf):
    return profile.crosstab(transactions(spark, sf), "type", "isFraud")


@query(
    "e17_order_crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "n_F", count(*) FILTER (o_orderstatus = 'O') AS "n_O",
       count(*) FILTER (o_orderstatus = 'P') AS "n_P", count(*) AS total FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return profile.crosstab_wide(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "e18_crosstab_row_percent",
    """SELECT type, round(count(*) FILTER (isFraud = 0) * 100.0e0 / count(*), 6) AS pct_0, round(count(*) FILTER (isFraud = 1) * 100.0e0 / count(*), 6) AS pct_1
       FROM txn GROUP BY type""",
)
def _(spark, sf):
    return round_doubles(profile.crosstab_row_percent(transactions(spark, sf), "type", "isFraud", [0, 1]))


@query("e19_fraud_share_by_type", _value_counts_sql("type", "type", "f"), ctes="f AS (SELECT * FROM txn_gaps WHERE isFraud = 1)")
def _(spark, sf):
    return round_doubles(profile.positive_share(transactions_with_gaps(spark, sf), "type"))


@query("e20_most_common_type", "SELECT type, count(*) AS n FROM txn_gaps WHERE type IS NOT NULL GROUP BY type ORDER BY n DESC, type LIMIT 1")
def _(spark, sf):
    return profile.most_common(transactions_with_gaps(spark, sf), "type")


BALANCE_SQL = """SELECT CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS n_classes, min(n) AS minority, max(n) AS majority,
  round(min(n) / CAST(max(n) AS DOUBLE), 9) AS imbalance_ratio, round(max(n) / CAST(min(n) AS DOUBLE), 9) AS majority_to_minority
  FROM (SELECT {label}, count(*) AS n FROM {table} GROUP BY 1) c"""


@query("e21_e22_class_balance", BALANCE_SQL.format(label="isFraud", table="txn"))
def _(spark, sf):
    return round_doubles(profile.class_balance(transactions(spark, sf)), 9)


@query("e21_label_balance", BALANCE_SQL.format(label="toxic", table="labels"))
def _(spark, sf):
    return round_doubles(profile.class_balance(read_table(spark, sf, "labels"), "toxic"), 9)


# ---- moments, quantiles, describe ------------------------------------------------------------------------------------


def describe_sql(columns: list[str], table: str) -> str:
    return union(
        [
            f"""SELECT '{c}' AS feature, count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS q25, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS q50,
            round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {table}"""
            for c in columns
        ]
    )


@query("e4_describe", describe_sql(NUMERIC_COLUMNS, "gaps"), ctes=GAPS)
def _(spark, sf):
    return round_doubles(profile.describe(gaps(spark, sf), NUMERIC_COLUMNS))


@query("e4_describe_lineitem", describe_sql(LINE_COLUMNS, "lineitem"))
def _(spark, sf):
    return round_doubles(profile.describe(read_table(spark, sf, "lineitem"), LINE_COLUMNS))


def moments_sql(columns: list[str], table: str, with_label: bool = True) -> str:
    def one(c: str) -> str:
        s = f"skewness(CAST({c} AS DOUBLE))"
        label = f", CASE WHEN abs({s}) > 1 THEN 'Highly skewed' WHEN abs({s}) > 0.5 THEN 'Moderately skewed' ELSE 'Approximately symmetric' END AS interpretation"
        return f"SELECT '{c}' AS feature, round({s}, 6) AS skewness, round(kurtosis(CAST({c} AS DOUBLE)), 6) AS kurtosis{label if with_label else ''} FROM {table}"

    return union([one(c) for c in columns])


@query("e6_e7_moments", moments_sql(NUMERIC_COLUMNS, "gaps"), ctes=GAPS)
def _(spark, sf):
    return round_doubles(profile.moments(gaps(spark, sf), NUMERIC_COLUMNS))


@query("e6_e7_moments_lineitem", moments_sql(LINE_COLUMNS, "lineitem"))
def _(spark, sf):
    return round_doubles(profile.moments(read_table(spark, sf, "lineitem"), LINE_COLUMNS))


@query(
    "e8_quantiles",
    union(
        [
            f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS probability, round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 6) AS value FROM gaps"
            for c in MONEY_COLUMNS
            for p in (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
        ]
    ),
    ctes=GAPS,
)
def _(spark, sf):
    return round_doubles(profile.quantile_table(gaps(spark, sf), MONEY_COLUMNS, [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]).drop("group"))


@query(
    "e14_amount_by_class",
    """SELECT isFraud, round(avg(amount), 6) AS mean, round(quantile_cont(amount, 0.5), 6) AS median, round(stddev_samp(amount), 6) AS std, round(max(amount), 6) AS max
       FROM txn_gaps GROUP BY isFraud""",
)
def _(spark, sf):
    return round_doubles(profile.amount_by_class(transactions_with_gaps(spark, sf)))


@query(
    "e16_class_feature_means",
    union(
        [
            f"SELECT '{c}' AS feature, isFraud, round(avg({c}), 6) AS mean, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS median FROM gaps GROUP BY isFraud"
            for c in NUMERIC_COLUMNS
        ]
    ),
    ctes=GAPS,
)
def _(spark, sf):
    return round_doubles(profile.class_feature_means(gaps(spark, sf)))


@query(
    "e28_centre_markers",
    union([f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS median FROM txn" for c in NUMERIC_COLUMNS]),
)
def _(spark, sf):
    return round_doubles(profile.centre_markers(transactions(spark, sf), NUMERIC_COLUMNS))


def histogram_sql(columns: list[str], table: str, bins: int, by: str | None = None, digits: int = 6) -> str:
    group = f"{by}, " if by else ""
    partition = f"PARTITION BY {by}" if by else ""
    return union(
        [
            f"""SELECT '{c}' AS feature, {group}CAST(bin AS INTEGER) AS bin, round(lo + bin * w, {digits}) AS bin_start, n AS "count",
            round(n / (sum(n) OVER ({partition}) * w), 9) AS density FROM (
              SELECT {group}least(floor(({c} - lo) / w), {bins - 1}) AS bin, lo, w, count(*) AS n
              FROM {table}, (SELECT min({c}) AS lo, (max({c}) - min({c})) / {bins} AS w FROM {table}) r WHERE {c} IS NOT NULL GROUP BY ALL) h"""
            for c in columns
        ]
    )


@query("e26_histogram", histogram_sql(["amount", "oldbalanceOrg", "newbalanceDest"], "txn", 50))
def _(spark, sf):
    df = profile.histogram(transactions(spark, sf), ["amount", "oldbalanceOrg", "newbalanceDest"])
    return df.withColumns({"bin_start": F.round("bin_start", 6), "density": F.round("density", 9)})


@query("e26_histogram_by_class", histogram_sql(["amount"], "txn", 50, "isFraud"))
def _(spark, sf):
    df = profile.histogram(transactions(spark, sf), ["amount"], by="isFraud")
    return df.withColumns({"bin_start": F.round("bin_start", 6), "density": F.round("density", 9)})


@query(
    "e27_box_stats",
    union(
        [
            f"""SELECT '{c}' AS feature, isFraud, round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3, count(*) AS n,
            round(min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
            round(max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
            count(*) FILTER ({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
            FROM txn JOIN (SELECT isFraud, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM txn GROUP BY 1) q USING (isFraud)
            GROUP BY isFraud, q1, m, q3"""
            for c in MONEY_COLUMNS
        ]
    ),
)
def _(spark, sf):
    return round_doubles(profile.box_stats(transactions(spark, sf), MONEY_COLUMNS))


# ---- outliers --------------------------------------------------------------------------------------------------------


def outlier_sql(columns: list[str], table: str) -> str:
    return union(
        [
            f"""SELECT '{c}' AS feature, iqr_outliers, round(iqr_outliers * 100.0e0 / n_rows, 6) AS iqr_pct, z_outliers, round(z_outliers * 100.0e0 / n, 6) AS z_pct,
            modified_z_outliers, round(modified_z_outliers * 100.0e0 / n_rows, 6) AS modified_z_pct FROM (
              SELECT count(*) AS n_rows, count({c}) AS n,
                count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
                count(*) FILTER (s > 0 AND abs(({c} - m) / s) > 3) AS z_outliers,
                count(*) FILTER (CASE WHEN mad = 0 THEN {c} <> med ELSE abs(0.6745e0 * ({c} - med) / mad) > 3.5 END) AS modified_z_outliers
              FROM {table}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.5) AS med, avg({c}) AS m, stddev_pop({c}) AS s FROM {table}) a,
                (SELECT quantile_cont(abs({c} - (SELECT quantile_cont({c}, 0.5) FROM {table})), 0.5) AS mad FROM {table}) b) o"""
            for c in columns
        ]
    )


@query("e9_e12_outlier_summary", outlier_sql(MONEY_COLUMNS, "gaps"), ctes=GAPS)
def _(spark, sf):
    return round_doubles(outliers.outlier_summary(gaps(spark, sf)))


@query("e12_outlier_summary_lineitem", outlier_sql(LINE_COLUMNS, "lineitem"))
def _(spark, sf):
    return round_doubles(outliers.outlier_summary(read_table(spark, sf, "lineitem"), LINE_COLUMNS))


@query("e12_mean_outlier_share", f"SELECT round(avg(iqr_pct), 6) AS mean_iqr_pct FROM ({outlier_sql(MONEY_COLUMNS, 'txn')}) s")
def _(spark, sf):
    return round_doubles(outliers.mean_outlier_share(outliers.outlier_summary(transactions(spark, sf))))


IQR_SQL = union(
    [
        f"""SELECT '{c}' AS feature, n AS outliers, round(n * 100.0e0 / n_rows, 6) AS outlier_pct FROM (
        SELECT count(*) AS n_rows, count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n
        FROM gaps, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM gaps) q) o"""
        for c in MONEY_COLUMNS
    ]
)


@query("e9_iqr_outliers", IQR_SQL, ctes=GAPS)
def _(spark, sf):
    return round_doubles(outliers.iqr_outliers(gaps(spark, sf)))


# ---- correlation -----------------------------------------------------------------------------------------------------

CORR_COLUMNS = NUMERIC_COLUMNS + ["isFraud"]


def pairs_sql(columns: list[str], table: str) -> str:
    return union([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM {table}" for a, b in combinations(columns, 2)])


@query(
    "e23_correlation_matrix",
    f"""SELECT feature_a, feature_b, round(r, 6) AS correlation FROM p UNION ALL SELECT feature_b, feature_a, round(r, 6) FROM p UNION ALL
        {union([f"SELECT '{c}', '{c}', 1.0e0" for c in CORR_COLUMNS])}""",
    ctes=f"{GAPS}, p AS ({pairs_sql(CORR_COLUMNS, 'gaps')})",
)
def _(spark, sf):
    return round_doubles(correlation.correlation_matrix(gaps(spark, sf), CORR_COLUMNS))


@query(
    "e23_correlation_lineitem",
    f"SELECT feature_a, feature_b, round(r, 6) AS correlation FROM ({pairs_sql(LINE_COLUMNS, 'lineitem')}) p",
)
def _(spark, sf):
    return round_doubles(correlation.correlation_pairs(read_table(spark, sf, "lineitem"), LINE_COLUMNS))


@query(
    "e24_high_correlations",
    f"SELECT feature_a, feature_b, round(r, 6) AS correlation FROM ({pairs_sql(CORR_COLUMNS, 'txn')}) p WHERE abs(r) > 0.7",
)
def _(spark, sf):
    return round_doubles(correlation.high_correlations(transactions(spark, sf), CORR_COLUMNS))


def target_sql(columns: list[str], table: str, top: int | None = None) -> str:
    body = union([f"SELECT '{c}' AS feature, corr({c}, isFraud) AS r FROM {table}" for c in columns])
    limit = f" ORDER BY abs(r) DESC NULLS LAST, feature LIMIT {top}" if top else ""
    return f"SELECT feature, round(r, 6) AS correlation FROM ({body}) t{limit}"


@query("e25_target_correlation", target_sql(NUMERIC_COLUMNS, "txn"))
def _(spark, sf):
    return round_doubles(correlation.target_correlations(transactions(spark, sf), NUMERIC_COLUMNS))


@query("e25_top5_target_correlation", target_sql(NUMERIC_COLUMNS, "txn", 5))
def _(spark, sf):
    return round_doubles(correlation.target_correlations(transactions(spark, sf), NUMERIC_COLUMNS, top=5))


ENGINEERED = f"eng AS (SELECT isFraud, {INTERACTION_SQL} FROM txn)"


@query("k4_engineered_ranking", target_sql(INTERACTION_NAMES, "eng"), ctes=ENGINEERED)
def _(spark, sf):
    return round_doubles(correlation.target_correlations(interaction_features(transactions(spark, sf)), INTERACTION_NAMES))


@query("e34_engineered_top4", target_sql(INTERACTION_NAMES, "eng", 4), ctes=ENGINEERED)
def _(spark, sf):
    return round_doubles(correlation.target_correlations(interaction_features(transactions(spark, sf)), INTERACTION_NAMES, top=4))


@query("e34_engineered_describe", describe_sql(INTERACTION_NAMES, "eng"), ctes=ENGINEERED)
def _(spark, sf):
    return round_doubles(profile.describe(interaction_features(transactions(spark, sf)), INTERACTION_NAMES))


@query("e34_engineered_moments", moments_sql(INTERACTION_NAMES, "eng"), ctes=ENGINEERED)
def _(spark, sf):
    return round_doubles(profile.moments(interaction_features(transactions(spark, sf)), INTERACTION_NAMES))


PCA_COLUMNS = NUMERIC_COLUMNS + ["orig_balance_change", "dest_balance_change", "orig_balance_ratio", "amount_to_orig_balance"]


@query("e29_pca_explained")
def _(spark, sf):
    return correlation.principal_components(interaction_features(transactions(spark, sf)), PCA_COLUMNS)[0]


@query("e29_pca_loadings")
def _(spark, sf):
    from pyspark.sql import Window

    loadings = correlation.principal_components(interaction_features(transactions(spark, sf)), PCA_COLUMNS)[1]
    best = F.row_number().over(Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature"))
    return loadings.filter("component <= 3").withColumn("place", best).filter("place <= 5")


# ---- composites ------------------------------------------------------------------------------------------------------

_SKEW = union([f"SELECT '{c}' AS feature, skewness(CAST({c} AS DOUBLE)) AS s FROM gaps" for c in NUMERIC_COLUMNS])
G_COLS = ", ".join(REQUIRED_COLUMNS)


@query(
    "e30_quality_report",
    f"""SELECT 'overview' AS section, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM g
        UNION ALL SELECT 'overview', 'duplicates', CAST((SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT * FROM g) d) AS DOUBLE)
        UNION ALL SELECT 'overview', 'fraud_cases', CAST(sum(isFraud) AS DOUBLE) FROM g
        UNION ALL SELECT 'overview', 'legitimate_cases', CAST(sum(1 - isFraud) AS DOUBLE) FROM g
        UNION ALL SELECT 'overview', 'fraud_rate_pct', round(avg(isFraud) * 100.0, 6) FROM g
        UNION ALL SELECT 'overview', 'imbalance_ratio', round(CAST(sum(1 - isFraud) AS DOUBLE) / CAST(sum(isFraud) AS DOUBLE), 6) FROM g
        UNION ALL SELECT 'missing', c, CAST(n AS DOUBLE) FROM ({union([f"SELECT '{c}' AS c, count(*) - count({c}) AS n FROM g" for c in REQUIRED_COLUMNS])}) m
        UNION ALL SELECT 'outlier_pct', feature, outlier_pct FROM ({IQR_SQL}) o
        UNION ALL SELECT 'skewness', feature, round(s, 6) FROM ({_SKEW}) k""",
    ctes=f"{GAPS}, g AS (SELECT {G_COLS} FROM gaps)",
)
def _(spark, sf):
    return round_doubles(quality_report.quality_report(gaps(spark, sf).select(*REQUIRED_COLUMNS)))


@query(
    "e31_recommendations",
    f"""SELECT 'severe_class_imbalance' AS rule, 'resample or weight the classes' AS detail FROM gaps HAVING avg(isFraud) * 100 < 1
        UNION ALL SELECT 'log_transform', feature FROM ({_SKEW}) k WHERE abs(s) > 1
        UNION ALL SELECT 'robust_scaling', 'prefer the robust scaler' FROM ({IQR_SQL}) o HAVING max(outlier_pct) > 5""",
    ctes=GAPS,
)
def _(spark, sf):
    return quality_report.recommendations(gaps(spark, sf))


@query(
    "e32_eda_summary",
    f"""SELECT count(*) AS records, 11 AS features, round(avg(isFraud) * 100.0, 6) AS fraud_rate,
        round(CAST(count(*) FILTER (isFraud = 0) AS DOUBLE) / count(*) FILTER (isFraud = 1), 6) AS imbalance_ratio,
        {' + '.join(f'(count(*) - count({c}))' for c in REQUIRED_COLUMNS)} AS missing_values, round(avg(amount), 6) AS mean_amount,
        round(skewness(amount), 6) AS amount_skewness, (SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT * FROM g) d) AS duplicates,
        round(quantile_cont(amount, 0.5), 6) AS median_amount,
        (SELECT type FROM g WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1) AS common_type FROM g""",
    ctes=f"g AS (SELECT {G_COLS} FROM txn_gaps)",
)
def _(spark, sf):
    return round_doubles(profile.eda_summary(transactions_with_gaps(spark, sf).select(*REQUIRED_COLUMNS)))


@query(
    "e33_explore",
    f"""SELECT 'missing' AS section, c AS item, 'missing' AS measure, CAST(n AS DOUBLE) AS value FROM m
        UNION ALL SELECT 'missing', c, 'missing_pct', round(n * 100.0e0 / r, 6) FROM m
        UNION ALL SELECT 'classes', CAST(isFraud AS VARCHAR), 'count', CAST(count(*) AS DOUBLE) FROM g GROUP BY isFraud
        UNION ALL SELECT 'classes', CAST(isFraud AS VARCHAR), 'percentage', round(count(*) * 100.0e0 / (SELECT count(*) FROM g), 6) FROM g GROUP BY isFraud
        UNION ALL SELECT 'balance', 'all', measure, value FROM (SELECT CAST(sum(n) AS DOUBLE) AS total_samples, CAST(count(*) AS DOUBLE) AS n_classes,
            CAST(min(n) AS DOUBLE) AS minority, CAST(max(n) AS DOUBLE) AS majority, round(min(n) / CAST(max(n) AS DOUBLE), 6) AS imbalance_ratio,
            round(max(n) / CAST(min(n) AS DOUBLE), 6) AS majority_to_minority FROM (SELECT count(*) AS n FROM g GROUP BY isFraud) c) b
            UNPIVOT (value FOR measure IN (total_samples, n_classes, minority, majority, imbalance_ratio, majority_to_minority))
        UNION ALL SELECT 'types', type, 'count', CAST(count(*) AS DOUBLE) FROM g WHERE type IS NOT NULL GROUP BY type
        UNION ALL SELECT 'types', type, 'percentage', round(count(*) * 100.0e0 / (SELECT count(type) FROM g), 6) FROM g WHERE type IS NOT NULL GROUP BY type
        UNION ALL SELECT 'fraud_by_type', type, measure, value FROM (SELECT type, CAST(count(*) AS DOUBLE) AS total, CAST(sum(isFraud) AS DOUBLE) AS fraud,
            round(avg(isFraud) * 100.0, 6) AS fraud_rate FROM g GROUP BY type) f UNPIVOT (value FOR measure IN (total, fraud, fraud_rate))
        UNION ALL SELECT 'amount', feature, measure, value FROM (SELECT feature, CAST("count" AS DOUBLE) AS "count", mean, std, min, q25, q50, q75, max FROM
            ({describe_sql(['amount'], 'g')}) d) e UNPIVOT (value FOR measure IN ("count", mean, std, min, q25, q50, q75, max))
        UNION ALL SELECT 'amount_by_class', k, measure, value FROM (SELECT CAST(isFraud AS VARCHAR) AS k, round(avg(amount), 6) AS mean, round(stddev_samp(amount), 6) AS std,
            round(max(amount), 6) AS max, round(quantile_cont(amount, 0.5), 6) AS median FROM g GROUP BY isFraud) a UNPIVOT (value FOR measure IN (mean, median, std, max))""",
    ctes=f"g AS (SELECT {G_COLS} FROM txn_gaps), m AS ({union([f'''SELECT '{c}' AS c, count(*) - count({c}) AS n, count(*) AS r FROM g''' for c in REQUIRED_COLUMNS])})",
)
def _(spark, sf):
    return round_doubles(profile.explore_long(transactions_with_gaps(spark, sf).select(*REQUIRED_COLUMNS)))
