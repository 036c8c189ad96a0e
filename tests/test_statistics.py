import math
import random

import pytest
from pyspark.sql import functions as F

from riskweft.operators import drift, metrics, profile, tests_of_difference as tests


def test_metric_golden_case(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "isFraud int, score double")
    areas = metrics.ranking_areas(metrics.score_runs(df)).first()
    assert areas["roc_auc"] == pytest.approx(0.75)
    assert areas["pr_auc"] == pytest.approx(5 / 6)
    assert metrics.threshold_for_recall(metrics.score_runs(df)).first()[0] == 0.35
    bundle = metrics.evaluate(df).first()
    assert (bundle["tp"], bundle["fp"], bundle["fn"], bundle["tn"]) == (1, 0, 1, 2)
    assert bundle["mcc"] == pytest.approx((1 * 2 - 0) / math.sqrt(1 * 2 * 2 * 3))


def test_one_class_and_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "isFraud int, score double")
    bundle = metrics.evaluate(df).first()
    assert bundle["roc_auc"] == 0.0 and bundle["pr_auc"] == 0.0 and bundle["recall"] == 0.0 and bundle["mcc"] == 0.0
    assert (bundle["fp"], bundle["tn"]) == (1, 1)
    assert metrics.threshold_for_recall(metrics.score_runs(df)).first()[0] == 0.5


def test_areas_on_many_buckets(spark):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.1), round(rng.random(), 3)) for _ in range(4000)] + [(rng.randint(0, 1), 0.5) for _ in range(2000)]
    df = spark.createDataFrame(rows, "isFraud int, score double")
    areas = metrics.ranking_areas(metrics.score_runs(df, rows_per_bucket=200)).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    by_score = {}
    for s in neg:
        by_score[s] = by_score.get(s, 0) + 1
    wins = sum(sum(c * (1.0 if s > v else 0.5 if s == v else 0.0) for v, c in by_score.items()) for s in pos)
    assert areas["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_moment_golden_case(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double")
    m = profile.moments(df, ["x"]).first()
    assert m["skewness"] == pytest.approx(1.6970562748) and m["kurtosis"] == pytest.approx(3.152)
    d = profile.describe(df, ["x"]).first()
    assert (d["q25"], d["q50"], d["std"]) == (2.0, 3.0, pytest.approx(3.5355339059))


def test_tail_probabilities():
    assert tests.gamma_tail(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)
    assert tests.gamma_tail(2.0, 9.487729036781154 / 2) == pytest.approx(0.05, abs=1e-9)
    assert tests.gamma_tail(2.0, 800.0) < 1e-300 or tests.gamma_tail(2.0, 800.0) == 0.0
    assert tests.kolmogorov(1.3581 / math.sqrt(1e6), 1e6) == pytest.approx(0.05, abs=1e-3)


def test_mann_whitney_small_case(spark):
    df = spark.createDataFrame([(0, float(v)) for v in (1, 2, 3, 4)] + [(1, float(v)) for v in (3, 5, 6)], "isFraud int, x double")
    row = tests.mann_whitney(df, ["x"]).first()
    # pairs won by the first sample: 4 over 3, and one tie
    assert row["u"] == 1.5
    assert tests.mann_whitney(df.filter("isFraud = 0"), ["x"]).count() == 0


def test_chi_square_yates(spark):
    df = spark.createDataFrame([("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 5, "r string, c int")
    row = tests.chi_square(df, "r", "c").first()
    expected = sum((abs(o - e) - 0.5) ** 2 / e for o, e in [(10, 30 * 40 / 65), (20, 30 * 25 / 65), (30, 35 * 40 / 65), (5, 35 * 25 / 65)])
    assert row["dof"] == 1 and row["statistic"] == pytest.approx(expected) and row["significant"] == 1


def test_drift_detection(spark):
    rng = random.Random(7)
    reference = spark.createDataFrame([(rng.gauss(0, 1), rng.random()) for _ in range(100)], "f1 double, f2 double")
    current = spark.createDataFrame([(rng.gauss(5, 1), rng.random()) for _ in range(100)], "f1 double, f2 double")
    report = drift.DriftDetector().fit(reference).detect(current)
    assert [r["feature"] for r in report.filter("drifted = 1").collect()] == ["f1"]
    summary = drift.drift_summary(report).first()
    assert (summary["features_tested"], summary["features_drifted"], summary["drifted_features"]) == (2, 1, "f1")
    assert drift.shared_numeric(reference, current.drop("f2")) == (["f1"], ["f2"])
    with pytest.raises(ValueError):
        drift.DriftDetector().detect(current)


def test_ks_with_one_hot_value(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.rand(1)).alias("x"))
    right = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.rand(2)).alias("x"))
    found = tests.ks_two_sample(left, right, ["x"], rows_per_bucket=50).first()["statistic"]
    a, b = sorted(r[0] for r in left.collect()), sorted(r[0] for r in right.collect())
    values = sorted(set(a) | set(b))
    import bisect

    expected = max(abs(bisect.bisect_right(a, v) / len(a) - bisect.bisect_right(b, v) / len(b)) for v in values)
    assert found == pytest.approx(expected)
