"""The stored reference distribution against the test over both tables, and what the digests shuffle."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskweft.operators import drift, reference, validation
from riskweft.operators.tests_of_difference import ks_two_sample
from riskweft.sources.inspection import distinct_counts, distinct_wide
from riskweft.streaming.drift import DRIFT_SCHEMA, drift_handler

SCHEMA = "a double, b double, c int"


def table(spark, n, seed, shift=0.0):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    pick = lambda: rng.choice(odd) if rng.random() < 0.1 else round(rng.gauss(shift, 1), 2)
    return spark.createDataFrame([(pick(), rng.random() + shift, rng.randrange(5)) for _ in range(n)], SCHEMA)


def rows(df):
    return {r["feature"]: (r["n_reference"], r["n_current"], r["statistic"], r["p_value"]) for r in df.collect()}


@pytest.mark.parametrize("per_bucket", [10, 100_000])
def test_stored_reference_equals_the_two_sample_test(spark, tmp_path, per_bucket):
    ours, names = table(spark, 600, 1), ["a", "b", "c"]
    reference.store_reference(ours, names, str(tmp_path), per_bucket)
    stored = reference.StoredReference(spark, str(tmp_path))
    for theirs in (table(spark, 400, 2), table(spark, 300, 3, 0.7), ours, ours.limit(1), ours.filter("a > 100 AND a < 1e9")):
        want, got = rows(ks_two_sample(ours, theirs, names)), rows(stored.test(theirs))
        assert set(got) == set(want)
        for name, (n, m, d, p) in want.items():
            assert got[name][:2] == (n, m)
            assert (d is None and got[name][2] is None) or math.isclose(got[name][2], d, abs_tol=1e-12)
            assert (p is None and got[name][3] is None) or math.isclose(got[name][3], p, abs_tol=1e-9)


def test_missing_and_extra_columns(spark, tmp_path):
    ours = table(spark, 200, 4)
    detector = drift.DriftDetector().fit(ours)
    detector.save(str(tmp_path))
    loaded = drift.DriftDetector.load(spark, str(tmp_path))
    got = {r["feature"]: r for r in loaded.detect(ours.select("c", F.lit(1).alias("bucket"))).collect()}
    assert got["c"]["statistic"] == 0 and got["c"]["drifted"] == 0 and got["a"]["n_current"] == 0 and got["a"]["statistic"] is None
    assert {r["n_current"] for r in loaded.detect(spark.range(3).select("id")).collect()} == {0}
    with pytest.raises(ValueError):
        drift.DriftDetector().save(str(tmp_path))


def test_batches_read_the_distribution_alone(spark, tmp_path):
    ours, path, out = table(spark, 200, 5), str(tmp_path / "ref"), str(tmp_path / "out")
    reference.store_reference(ours, ["a", "c"], path)
    handle = drift_handler(path, out)
    for k in range(3):
        handle(table(spark, 100, k + 6, float(k)), k)
    got = lambda: spark.read.schema(f"{DRIFT_SCHEMA}, batch_id bigint").parquet(out)
    assert got().groupBy("batch_id").count().filter("count = 2").count() == 3
    handle(table(spark, 100, 8, 2.0), 2)  # a repeated batch replaces itself
    assert got().count() == 6


def test_digests_replace_rows(spark):
    data = [(1, None, "x"), (None, 1, "x"), (1, None, "x"), (None, None, None), (None, None, None), (0, 1, "")]
    df = spark.createDataFrame(data, "a int, b int, c string")
    assert tuple(validation.duplicate_summary(df).first())[:2] == (6, 2)
    assert tuple(distinct_wide(df, ["a", "b", "c"]).first()) == (2, 1, 2)
    empty = df.limit(0)
    assert tuple(validation.duplicate_summary(empty).first())[:2] == (0, 0) and tuple(distinct_wide(empty, ["a", "c"]).first()) == (0, 0)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "a double")
    assert distinct_wide(zeros, ["a"]).first()[0] == zeros.agg(F.count_distinct("a")).first()[0]
    plan = distinct_counts(df, ["a", "b", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    shuffled = validation.duplicate_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "c#" in line for line in shuffled.splitlines())
