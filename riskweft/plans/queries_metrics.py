"""Checked queries: classification metrics over the scored transaction view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.operators import metrics
from riskweft.plans.queries_profile import histogram_sql, union
from riskweft.plans.registry import query
from riskweft.sources.transactions import transactions

LOW = 0.41  # a second threshold, for the comparison queries


def counts_sql(threshold: float) -> str:
    return f"""SELECT CAST({threshold} AS DOUBLE) AS threshold, count(*) FILTER (isFraud = 1 AND score >= {threshold}e0) AS tp, count(*) FILTER (isFraud = 0 AND score >= {threshold}e0) AS fp,
      count(*) FILTER (isFraud = 1 AND score < {threshold}e0) AS fn, count(*) FILTER (isFraud = 0 AND score < {threshold}e0) AS tn FROM txn"""


# Metric formulas over double columns tp, fp, fn, tn; nested so that each level may use the one below.
BASE_SQL = """SELECT *, tp + fp + fn + tn AS n, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END AS recall,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0e0 END AS specificity, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0e0 END AS npv
  FROM (SELECT threshold, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tn AS DOUBLE) AS tn FROM ({counts}) c) d"""


def f_sql(beta: float) -> str:
    w = beta * beta
    return f"CASE WHEN {w} * precision + recall > 0 THEN {1 + w} * precision * recall / ({w} * precision + recall) ELSE 0.0e0 END"


FORMULAS = {
    "accuracy": "(tp + tn) / n",
    "precision": "precision",
    "recall": "recall",
    "f1": f_sql(1.0),
    "f2": f_sql(2.0),
    "f05": f_sql(0.5),
    "specificity": "specificity",
    "sensitivity": "recall",
    "true_positive_rate": "recall",
    "true_negative_rate": "specificity",
    "false_positive_rate": "CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0e0 END",
    "false_negative_rate": "CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0.0e0 END",
    "ppv": "precision",
    "npv": "npv",
    "prevalence": "(tp + fn) / n",
    "mcc": "CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0 THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0e0 END",
    "cohen_kappa": "((tp + tn) / n - ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)) / (1 - ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n))",
}
RUNS = """runs AS (SELECT score AS threshold, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (SELECT score, count(*) FILTER (isFraud = 1) AS pos, count(*) FILTER (isFraud = 0) AS neg FROM txn GROUP BY score) g)"""
AREAS = f"""{RUNS}, areas AS (SELECT CAST(sum(pos * (n - fp + neg / 2.0e0)) AS DOUBLE) / CAST(max(p) AS DOUBLE) / CAST(max(n) AS DOUBLE) AS roc_auc,
  sum(pos * CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) / CAST(max(p) AS DOUBLE) AS pr_auc FROM runs)"""


def metrics_sql(names: list[str], threshold: float = 0.5, prefix: str = "") -> str:
    return f"SELECT {prefix}{', '.join(f'round({FORMULAS[m]}, 9) AS {m}' for m in names)} FROM ({BASE_SQL.format(counts=counts_sql(threshold))}) b"


def _scored(spark, sf):
    return transactions(spark, sf).select("event_id", "isFraud", "score", "amount")


def _metrics(names: list[str]):
    def run(spark, sf):
        return round_doubles(metrics.with_metrics(metrics.confusion_at(_scored(spark, sf), [0.5])).select(*names), 9)

    return run


@query("m1_confusion_counts", counts_sql(0.5))
def _(spark, sf):
    return metrics.confusion_at(_scored(spark, sf), [0.5])


query("m2_accuracy_precision_recall", metrics_sql(["accuracy", "precision", "recall"]))(_metrics(["accuracy", "precision", "recall"]))
query("m3_f_scores", metrics_sql(["f1", "f2", "f05"]))(_metrics(["f1", "f2", "f05"]))
RATES = ["specificity", "sensitivity", "true_positive_rate", "true_negative_rate", "false_positive_rate", "false_negative_rate"]
query("m4_rates", metrics_sql(RATES))(_metrics(RATES))
query("m5_predictive_values", metrics_sql(["ppv", "npv", "prevalence"]))(_metrics(["ppv", "npv", "prevalence"]))
query("m6_mcc_kappa", metrics_sql(["mcc", "cohen_kappa"]))(_metrics(["mcc", "cohen_kappa"]))


@query("m7_roc_auc", "SELECT round(roc_auc, 9) AS roc_auc FROM areas", ctes=AREAS)
def _(spark, sf):
    return round_doubles(metrics.ranking_areas(metrics.score_runs(_scored(spark, sf))).select("roc_auc"), 9)


@query("m8_average_precision", "SELECT round(pr_auc, 9) AS pr_auc FROM areas", ctes=AREAS)
def _(spark, sf):
    return round_doubles(metrics.ranking_areas(metrics.score_runs(_scored(spark, sf))).select("pr_auc"), 9)


@query(
    "m9_class_report",
    f"""SELECT "class", round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, s AS support FROM (
      SELECT '1' AS "class", precision AS p, recall AS r, {f_sql(1.0)} AS f, tp + fn AS s FROM b
      UNION ALL SELECT '0', npv, specificity, f0, tn + fp FROM b0
      UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM b
      UNION ALL SELECT 'macro avg', (precision + npv) / 2, (recall + specificity) / 2, ({f_sql(1.0)} + f0) / 2, n FROM b0
      UNION ALL SELECT 'weighted avg', (precision * (tp + fn) + npv * (tn + fp)) / n, (recall * (tp + fn) + specificity * (tn + fp)) / n,
        ({f_sql(1.0)} * (tp + fn) + f0 * (tn + fp)) / n, n FROM b0) u""",
    ctes=f"b AS ({BASE_SQL.format(counts=counts_sql(0.5))}), b0 AS (SELECT *, 2 * npv * specificity / (npv + specificity) AS f0 FROM b)",
)
def _(spark, sf):
    return round_doubles(metrics.class_report(metrics.confusion_at(_scored(spark, sf), [0.5])), 9)


@query(
    "m10_roc_points",
    """SELECT threshold, round(CAST(fp AS DOUBLE) / CAST(n AS DOUBLE), 9) AS fpr, round(CAST(tp AS DOUBLE) / CAST(p AS DOUBLE), 9) AS tpr FROM runs
       UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0e0, 0.0e0""",
    ctes=RUNS,
)
def _(spark, sf):
    return metrics.roc_points(metrics.score_runs(_scored(spark, sf))).withColumns({"fpr": F.round("fpr", 9), "tpr": F.round("tpr", 9)})


@query(
    "m11_pr_points",
    """SELECT threshold, round(CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE), 9) AS precision, round(CAST(tp AS DOUBLE) / CAST(p AS DOUBLE), 9) AS recall FROM runs
       UNION ALL SELECT NULL, 1.0e0, 0.0e0""",
    ctes=RUNS,
)
def _(spark, sf):
    return round_doubles(metrics.pr_points(metrics.score_runs(_scored(spark, sf))), 9)


@query("f8_cumulative_counts", "SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM runs", ctes=RUNS)
def _(spark, sf):
    return metrics.score_runs(_scored(spark, sf)).select("threshold", "tp", "fp")


@query(
    "f9_average_ranks",
    """SELECT score AS value, n, round(CAST(sum(n) OVER (ORDER BY score) AS DOUBLE) - n + (n + 1) / 2.0e0, 6) AS average_rank
       FROM (SELECT score, count(*) AS n FROM txn GROUP BY score) g""",
)
def _(spark, sf):
    from riskweft.operators.prefix import cumulative_by_value

    runs = cumulative_by_value(_scored(spark, sf), ["score"], {"n": F.lit(1).cast("bigint")})
    return runs.select("value", "n", F.round(F.col("cum_n") - F.col("n") + (F.col("n") + 1) / F.lit(2.0), 6).alias("average_rank"))


@query(
    "m12_normalised_confusion",
    """SELECT isFraud AS label, CAST(score >= 0.5 AS INTEGER) AS prediction, count(*) AS "count", round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY isFraud) AS DOUBLE), 9) AS row_share
       FROM txn GROUP BY 1, 2""",
)
def _(spark, sf):
    return round_doubles(metrics.confusion_matrix(_scored(spark, sf), (F.col("score") >= 0.5).cast("int")), 9)


@query("m13_threshold_for_recall", "SELECT coalesce(max(threshold) FILTER (CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) >= 0.9), 0.5) AS threshold FROM runs", ctes=RUNS)
def _(spark, sf):
    return metrics.threshold_for_recall(metrics.score_runs(_scored(spark, sf)))


_TEN = [m for m in metrics.KEY_METRICS if m not in ("roc_auc", "pr_auc")]


def _compare_sql() -> str:
    parts = []
    for m in metrics.KEY_METRICS:
        a, b = (f"(SELECT {FORMULAS[m]} FROM {t})" if m in FORMULAS else f"(SELECT {m} FROM areas)" for t in ("b1", "b2"))
        parts.append(f"SELECT '{m}' AS metric, round({a}, 9) AS at_default, round({b}, 9) AS at_tuned, round({b} - {a}, 9) AS delta")
    return union(parts)


COMPARE_CTES = f"{AREAS}, b1 AS ({BASE_SQL.format(counts=counts_sql(0.5))}), b2 AS ({BASE_SQL.format(counts=counts_sql(LOW))})"


@query("m14_metrics_at_thresholds", _compare_sql(), ctes=COMPARE_CTES)
def _(spark, sf):
    return round_doubles(metrics.compare_thresholds(_scored(spark, sf), LOW), 9)


@query(
    "m15_threshold_sweep",
    f"SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM ({BASE_SQL.format(counts=union([counts_sql(t) for t in metrics.SWEEP]))}) b",
)
def _(spark, sf):
    return round_doubles(metrics.threshold_sweep(_scored(spark, sf)), 9)


def _long_sql(names: list[str]) -> str:
    return union([f"SELECT '{m}' AS metric, round((SELECT {FORMULAS[m] if m in FORMULAS else m} FROM {'b1' if m in FORMULAS else 'areas'}), 9) AS value" for m in names])


B1 = f"{AREAS}, b1 AS ({BASE_SQL.format(counts=counts_sql(0.5))})"


@query("m16_basic_metrics", _long_sql(metrics.BASIC_METRICS), ctes=B1)
def _(spark, sf):
    return round_doubles(metrics.to_long(metrics.evaluate(_scored(spark, sf)), metrics.BASIC_METRICS), 9)


@query("m18_key_metrics", _long_sql(metrics.KEY_METRICS), ctes=B1)
def _(spark, sf):
    return round_doubles(metrics.to_long(metrics.evaluate(_scored(spark, sf)), metrics.KEY_METRICS), 9)


@query(
    "m17_business_impact",
    """SELECT CAST(n AS BIGINT) AS transactions, CAST(tp + fn AS BIGINT) AS fraud_cases, CAST(tp AS BIGINT) AS caught, round(tp / (tp + fn) * 100, 6) AS caught_pct, CAST(fn AS BIGINT) AS missed,
       round(fn / (tp + fn) * 100, 6) AS missed_pct, CAST(fp AS BIGINT) AS false_alarms, round(fp / n * 100, 6) AS false_alarm_pct, CAST(tn AS BIGINT) AS cleared, round(tn / (tn + fp) * 100, 6) AS cleared_pct,
       round(tp * f, 3) AS prevented, round(fp * 10.0e0, 3) AS investigation_cost, round(tp * f - fp * 10.0e0, 3) AS net_value
       FROM b1, (SELECT avg(amount) AS f FROM txn WHERE isFraud = 1) a""",
    ctes=f"b1 AS ({BASE_SQL.format(counts=counts_sql(0.5))})",
)
def _(spark, sf):
    impact = metrics.business_impact(_scored(spark, sf))
    money = ["prevented", "investigation_cost", "net_value"]
    return round_doubles(impact.withColumns({c: F.round(c, 3) for c in money}))


@query("m19_score_histogram", histogram_sql(["score"], "txn", 50, "isFraud", 9))
def _(spark, sf):
    df = metrics.score_histogram(_scored(spark, sf))
    return df.withColumns({"bin_start": F.round("bin_start", 9), "density": F.round("density", 9)})


@query(
    "m20_advice",
    """SELECT 'low_recall' AS rule FROM b1 WHERE recall < 0.8 UNION ALL SELECT 'low_precision' FROM b1 WHERE precision < 0.5
       UNION ALL SELECT 'excellent_roc_auc' FROM areas WHERE roc_auc > 0.9 UNION ALL SELECT 'excellent_pr_auc' FROM areas WHERE pr_auc > 0.8
       UNION ALL SELECT 'good_mcc' FROM b1 WHERE """
    + FORMULAS["mcc"]
    + """ > 0.5 UNION ALL SELECT 'strong_performance' FROM b1 WHERE recall > 0.85 AND precision > 0.6""",
    ctes=B1,
)
def _(spark, sf):
    return metrics.advice(metrics.evaluate(_scored(spark, sf))).select("rule")
