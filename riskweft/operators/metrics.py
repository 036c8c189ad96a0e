"""Classification metrics of a scored table.

Counts at any number of thresholds come from one aggregation. Ranking metrics work on one row per distinct score, so
ties are exact and a flood of equal scores is a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.functions.exprs import rows_from_wide
from riskweft.operators.prefix import ROWS_PER_BUCKET, cumulative_by_value
from riskweft.operators.profile import histogram
from riskweft.schema import LABEL

DEFAULT_THRESHOLD = 0.5
TARGET_RECALL = 0.90
FALSE_ALARM_COST = 10.0
SWEEP = [i / 10 for i in range(1, 10)]
COUNTS = ["tp", "fp", "fn", "tn"]

# The ten headline metrics, and the advice rules with their limits.
KEY_METRICS = ["accuracy", "precision", "recall", "f1", "f2", "specificity", "roc_auc", "pr_auc", "mcc", "cohen_kappa"]
BASIC_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _ratio(a: Column, b: Column) -> Column:
    return _zero(F.try_divide(a, b))


def confusion_at(df: DataFrame, thresholds: list[float], score: str = "score", label: str = LABEL) -> DataFrame:
    """(threshold, tp, fp, fn, tn) with ``score >= threshold`` as the positive decision: one scan for all thresholds."""
    positive, negative = F.col(label) == 1, F.col(label) == 0
    aggregates = [F.count_if(positive).alias("p"), F.count_if(negative).alias("n")]
    for i, t in enumerate(thresholds):
        flagged = F.col(score) >= F.lit(float(t))
        aggregates += [F.count_if(positive & flagged).alias(f"tp{i}"), F.count_if(negative & flagged).alias(f"fp{i}")]
    wide = df.agg(*aggregates)
    entries = [
        (F.lit(float(t)), F.col(f"tp{i}"), F.col(f"fp{i}"), F.col("p") - F.col(f"tp{i}"), F.col("n") - F.col(f"fp{i}"))
        for i, t in enumerate(thresholds)
    ]
    return rows_from_wide(wide, entries, ["threshold", *COUNTS])


def confusion_matrix(df: DataFrame, prediction: Column, label: str = LABEL) -> DataFrame:
    """(label, prediction, count, share of the label's rows)."""
    counts = df.groupBy(F.col(label).alias("label"), prediction.alias("prediction")).agg(F.count(F.lit(1)).alias("count"))
    # One row per (label, prediction) pair.
    return counts.withColumn("row_share", F.col("count") / F.sum("count").over(Window.partitionBy("label")))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    weight = beta * beta
    return _ratio((1 + weight) * precision * recall, weight * precision + recall)


def metric_columns() -> dict[str, Column]:
    """Metrics as expressions over columns tp, fp, fn, tn; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in COUNTS)
    n = tp + fp + fn + tn
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    specificity = _ratio(tn, tn + fp)
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    agreement = (tp + tn) / n
    return {
        "accuracy": _ratio(tp + tn, n),
        "precision": precision,
        "recall": recall,
        "f1": f_beta(precision, recall, 1.0),
        "f2": f_beta(precision, recall, 2.0),
        "f05": f_beta(precision, recall, 0.5),
        "specificity": specificity,
        "sensitivity": recall,
        "true_positive_rate": recall,
        "true_negative_rate": specificity,
        "false_positive_rate": _ratio(fp, fp + tn),
        "false_negative_rate": _ratio(fn, fn + tp),
        "ppv": precision,
        "npv": _ratio(tn, tn + fn),
        "prevalence": _ratio(tp + fn, n),
        "mcc": _ratio(tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)),
        "cohen_kappa": _zero(F.try_divide(agreement - chance, 1 - chance)),
    }


def with_metrics(counts: DataFrame) -> DataFrame:
    return counts.select("*", *[v.alias(k) for k, v in metric_columns().items()])


# ---- ranking metrics -------------------------------------------------------------------------------------------------


def score_runs(df: DataFrame, score: str = "score", label: str = LABEL, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, pos, neg, tp, fp, p, n): one row per distinct score, with the counts at ``score >= threshold``."""
    pos, neg = (F.col(label) == 1).cast("bigint"), (F.col(label) == 0).cast("bigint")
    runs = cumulative_by_value(df, [score], {"pos": pos, "neg": neg}, rows_per_bucket)
    return runs.select(
        F.col("value").alias("threshold"),
        "pos",
        "neg",
        (F.col("total_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("total_neg") - F.col("cum_neg") + F.col("neg")).alias("fp"),
        F.col("total_pos").alias("p"),
        F.col("total_neg").alias("n"),
    )


def _area_columns() -> tuple[list[Column], dict[str, Column]]:
    """Aggregates over score runs, and the areas as expressions over those aggregates."""
    beaten = (F.col("n") - F.col("fp")).cast("double") + F.col("neg") / F.lit(2.0)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    sums = [
        F.sum(F.col("pos") * beaten).alias("_wins"),
        F.sum(F.col("pos") * precision).alias("_steps"),
        F.max("p").alias("_p"),
        F.max("n").alias("_n"),
    ]
    pairs = F.col("_p").cast("double") * F.col("_n")
    return sums, {"roc_auc": _ratio(F.col("_wins"), pairs), "pr_auc": _ratio(F.col("_steps"), F.col("_p").cast("double"))}


def ranking_areas(runs: DataFrame) -> DataFrame:
    """One row: tie-aware ROC area, and average precision by the step rule; 0 when a class is missing."""
    sums, areas = _area_columns()
    return runs.agg(*sums).select(*[v.alias(k) for k, v in areas.items()])


def bundle_at(runs: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, counts, every metric, both areas) per threshold: one aggregation over the distinct scores."""
    sums, areas = _area_columns()
    for i, t in enumerate(thresholds):
        flagged = F.col("threshold") >= F.lit(float(t))
        sums += [F.coalesce(F.sum(F.when(flagged, F.col(m))), F.lit(0)).alias(f"_{m}{i}") for m in ("pos", "neg")]
    wide = runs.agg(*sums)
    entries = [
        (
            F.lit(float(t)),
            F.col(f"_pos{i}"),
            F.col(f"_neg{i}"),
            F.col("_p") - F.col(f"_pos{i}"),
            F.col("_n") - F.col(f"_neg{i}"),
            areas["roc_auc"],
            areas["pr_auc"],
        )
        for i, t in enumerate(thresholds)
    ]
    return with_metrics(rows_from_wide(wide, entries, ["threshold", *COUNTS, "roc_auc", "pr_auc"]))


def roc_points(runs: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the origin at an infinite threshold."""
    points = runs.select("threshold", _ratio(F.col("fp"), F.col("n")).alias("fpr"), _ratio(F.col("tp"), F.col("p")).alias("tpr"))
    origin = points.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_points(runs: DataFrame) -> DataFrame:
    """(threshold, precision, recall) for every distinct score, and the end point (1, 0) without a threshold."""
    points = runs.select("threshold", _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _ratio(F.col("tp"), F.col("p")).alias("recall"))
    end = points.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def threshold_for_recall(runs: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """One row: the largest threshold whose recall reaches the target, else the default."""
    reached = F.when(_ratio(F.col("tp"), F.col("p")) >= target, F.col("threshold"))
    return runs.agg(F.coalesce(F.max(reached), F.lit(DEFAULT_THRESHOLD)).alias("threshold"))


# ---- reports ---------------------------------------------------------------------------------------------------------


def evaluate(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, score: str = "score", label: str = LABEL) -> DataFrame:
    """One wide row: counts, every metric and both areas, all from the distinct scores of the scored rows."""
    return bundle_at(score_runs(df, score, label), [threshold])


def to_long(wide: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, value) rows of a one-row bundle."""
    return wide.select(*[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([], metrics, "metric", "value")


def compare_thresholds(df: DataFrame, tuned: float, score: str = "score", label: str = LABEL) -> DataFrame:
    """(metric, at_default, at_tuned, delta) over the ten headline metrics."""
    complete = bundle_at(score_runs(df, score, label), [DEFAULT_THRESHOLD, tuned])
    # Two rows, unless the tuned threshold equals the default.
    position = F.when(F.col("threshold") == DEFAULT_THRESHOLD, "default").otherwise("tuned")
    long = complete.select(position.alias("which"), *KEY_METRICS).unpivot(["which"], KEY_METRICS, "metric", "value")
    default = F.max(F.when(F.col("which") == "default", F.col("value")))
    other = F.coalesce(F.max(F.when(F.col("which") == "tuned", F.col("value"))), default)
    return long.groupBy("metric").agg(default.alias("at_default"), other.alias("at_tuned"), (other - default).alias("delta"))


def threshold_sweep(df: DataFrame, thresholds: list[float] = SWEEP, score: str = "score", label: str = LABEL) -> DataFrame:
    return with_metrics(confusion_at(df, thresholds, score, label)).select("threshold", "precision", "recall")


def class_report(counts: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) per class and for accuracy, macro and weighted averages; one count row in."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in COUNTS)
    p1, r1, p0, r0 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1, f0 = f_beta(p1, r1, 1.0), f_beta(p0, r0, 1.0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    accuracy = _ratio(tp + tn, n)

    def weighted(a: Column, b: Column) -> Column:
        return _ratio(a * s0 + b * s1, n)

    entries = [
        (F.lit("0"), p0, r0, f0, s0),
        (F.lit("1"), p1, r1, f1, s1),
        (F.lit("accuracy"), accuracy, accuracy, accuracy, n),
        (F.lit("macro avg"), (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        (F.lit("weighted avg"), weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n),
    ]
    return rows_from_wide(counts, entries, ["class", "precision", "recall", "f1", "support"])


def business_impact(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, score: str = "score", label: str = LABEL, amount: str = "amount") -> DataFrame:
    """One row: what was caught, missed and wrongly flagged, and its money value."""
    positive, flagged = F.col(label) == 1, F.col(score) >= F.lit(float(threshold))
    counts = df.agg(
        F.count_if(positive & flagged).alias("tp"),
        F.count_if((F.col(label) == 0) & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
        F.count_if((F.col(label) == 0) & ~flagged).alias("tn"),
        F.avg(F.when(positive, F.col(amount))).alias("mean_fraud"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in COUNTS)
    n = tp + fp + fn + tn
    priced = counts.select(
        n.cast("bigint").alias("transactions"),
        (F.col("tp") + F.col("fn")).alias("fraud_cases"),
        F.col("tp").alias("caught"),
        (_ratio(tp, tp + fn) * 100).alias("caught_pct"),
        F.col("fn").alias("missed"),
        (_ratio(fn, tp + fn) * 100).alias("missed_pct"),
        F.col("fp").alias("false_alarms"),
        (_ratio(fp, n) * 100).alias("false_alarm_pct"),
        F.col("tn").alias("cleared"),
        (_ratio(tn, tn + fp) * 100).alias("cleared_pct"),
        (tp * F.coalesce("mean_fraud", F.lit(0.0))).alias("prevented"),
        (fp * FALSE_ALARM_COST).alias("investigation_cost"),
    )
    return priced.withColumn("net_value", F.col("prevented") - F.col("investigation_cost"))


def score_histogram(df: DataFrame, score: str = "score", label: str = LABEL, bins: int = 50) -> DataFrame:
    return histogram(df, [score], bins, by=label)


def advice(bundle: DataFrame) -> DataFrame:
    """(rule, message) rows for the rules the one-row metric bundle meets."""
    c = F.col
    rules = [
        ("low_recall", c("recall") < 0.80, "lower the threshold or resample to find more fraud"),
        ("low_precision", c("precision") < 0.50, "many false alarms, tune the threshold"),
        ("excellent_roc_auc", c("roc_auc") > 0.90, "strong ranking quality"),
        ("excellent_pr_auc", c("pr_auc") > 0.80, "works well on imbalanced data"),
        ("good_mcc", c("mcc") > 0.50, "decisions agree well with the truth"),
        ("strong_performance", (c("recall") > 0.85) & (c("precision") > 0.60), "recall and precision are balanced"),
    ]
    listed = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(m).alias("message"), F.coalesce(cond, F.lit(False)).alias("holds")) for n, cond, m in rules])
    return bundle.select(F.inline(listed)).filter("holds").drop("holds")
