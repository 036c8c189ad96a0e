"""The distributed order statistics must equal a plain global sort, also when forced through many narrowing rounds."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweft.operators import order_stats, prefix, splits

VALUES = {
    "smooth": lambda rng, i: rng.lognormvariate(5, 2),
    "heavy": lambda rng, i: 7.0 if i % 3 else rng.uniform(0, 14),
    "constant": lambda rng, i: 1.5,
    "signed": lambda rng, i: rng.choice([-1e300, -1.0, 0.0, 1e-300, 5.0]),
}


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, *[float(f(rng, i)) for f in VALUES.values()], i % 5) for i in range(3000)]
    return spark.createDataFrame(rows, ["id", *VALUES, "grp"]).repartition(7).cache()


def linear(values, p):
    values = sorted(values)
    place = p * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@pytest.mark.parametrize("limit", [20, 10_000])
def test_quantiles_match_sort(table, limit):
    points = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    found = order_stats.exact_quantiles(table, list(VALUES), points, sort_limit=limit)[None]
    rows = table.collect()
    for name in VALUES:
        for p, q in zip(points, found[name]):
            assert q == pytest.approx(linear([r[name] for r in rows], p), rel=1e-12), (name, p)


def test_grouped_quantiles_and_nulls(spark, table):
    holed = table.withColumn("smooth", F.when(F.col("id") % 2 == 0, F.col("smooth")))
    for limit in (15, 10_000):
        found = order_stats.exact_quantiles(holed, ["smooth"], [0.5], by="grp", sort_limit=limit)
        for g in range(5):
            expected = linear([r["smooth"] for r in holed.collect() if r["grp"] == g and r["smooth"] is not None], 0.5)
            assert found[g]["smooth"][0] == pytest.approx(expected)
    empty = order_stats.exact_quantiles(table.filter("id < 0"), ["smooth"], [0.5])
    assert empty[None]["smooth"] == [None]


@pytest.mark.parametrize("column", ["heavy", "grp", "constant"])
def test_prefix_cutoffs_pick_exact_rows(table, column):
    order = sorted((r[column], r["id"]) for r in table.select(column, "id").collect())
    lengths = [0, 1, 999, 1000, 2999, 3000]
    cutoffs = order_stats.prefix_cutoffs(table, column, "id", [(F.lit(True), 3000, n) for n in lengths], sort_limit=25)
    for n, cutoff in zip(lengths, cutoffs):
        kept = set() if cutoff is None else {r["id"] for r in table.filter(cutoff.covers(column, "id")).collect()}
        assert kept == {i for _, i in order[:n]}


def test_running_totals_match_global_window(table):
    names = list(VALUES)
    one = F.lit(1).cast("bigint")
    chunked = prefix.cumulative_by_value(table, names, {"n": one, "s": F.col("grp").cast("bigint")}, rows_per_bucket=100)
    long = table.unpivot(["grp"], names, "feature", "value")
    window = Window.partitionBy("feature").orderBy("value")
    plain = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("grp").alias("s"))
    plain = plain.select("feature", "value", "n", F.sum("n").over(window).alias("cum_n"), F.sum("s").over(window).alias("cum_s"))
    left = {(r["feature"], r["value"]): (r["n"], r["cum_n"], r["cum_s"], r["total_n"]) for r in chunked.collect()}
    right = {(r["feature"], r["value"]): (r["n"], r["cum_n"], r["cum_s"], 3000) for r in plain.collect()}
    assert left == right


def test_splits_do_not_depend_on_partitioning(spark, txn):
    from riskweft.schema import LABEL

    base = txn.select("event_id", "step", LABEL)
    for make in (splits.stratified_split, splits.fractional_split, lambda d: splits.shuffled_split(d, 500, 200), splits.stratified_folds):
        column = "fold" if make is splits.stratified_folds else "split"
        one = {r["event_id"]: r[column] for r in make(base).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = {r["event_id"]: r[column] for r in make(base.repartition(5)).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert one == other


def test_split_sizes_and_order(txn):
    base = txn.select("event_id", "step", "isFraud")
    sizes = {r["split"]: r["count"] for r in splits.temporal_split(base, 700, 200).groupBy("split").count().collect()}
    assert sizes == {"train": 700, "eval": 200, "test": 100}
    parted = splits.temporal_split(base, 700, 200)
    last_train = parted.filter("split = 'train'").agg(F.max("step")).first()[0]
    assert parted.filter("split = 'test'").agg(F.min("step")).first()[0] >= last_train
    assert splits.temporal_split(base, 5000, 10).filter("split = 'train'").count() == 1000
    assert splits.random_sample(base, 37).count() == 37
    assert splits.stratified_sample(base, 300).filter("isFraud = 1").count() == 300 * 17 // 1000
    folds = splits.stratified_folds(base).groupBy("isFraud", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in folds if r["isFraud"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_sorts(txn):
    rows = splits.sort_rows(txn.select("event_id", "step")).collect()
    assert rows == sorted(rows, key=lambda r: (r["step"], r["event_id"]))
    shuffled = [r["event_id"] for r in splits.shuffle_rows(txn.select("event_id")).collect()]
    assert shuffled != sorted(shuffled) and sorted(shuffled) == list(range(1000))
    assert shuffled == [r["event_id"] for r in splits.shuffle_rows(txn.select("event_id").repartition(5)).collect()]


def test_quantiles_of_infinite_values_do_not_depend_on_the_number_of_rows(spark):
    from riskweft.operators.order_stats import exact_quantiles

    values = [float(k) for k in range(20)] + [float("inf")] * 10 + [float("-inf")] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    points = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    built_in = df.selectExpr(f"percentile(x, array({', '.join(map(str, points))}))").first()[0]
    wide = exact_quantiles(df, ["x"], points)[None]["x"]
    assert wide == built_in
    assert exact_quantiles(df, ["x"], points, sort_limit=3)[None]["x"] == wide


def test_rows_without_clock_come_last(spark):
    from riskweft.operators.splits import slice_rows, temporal_split

    df = spark.createDataFrame([(k, None if k in (2, 5, 9) else k % 4) for k in range(12)], "event_id bigint, step int")
    order = [r[0] for r in sorted(df.collect(), key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    for train, evaluate in ((4, 4), (8, 2), (9, 1), (10, 1), (12, 3), (0, 9)):
        found = {r["event_id"]: r["split"] for r in temporal_split(df, train, evaluate).collect()}
        want = ["train"] * train + ["eval"] * evaluate + ["test"] * 12
        assert [found[i] for i in order] == want[:12]
    for a, b in ((0, 3), (7, 10), (9, 12), (10, 11), (5, 5)):
        assert {r["event_id"] for r in slice_rows(df, "step", "event_id", a, b).collect()} == set(order[a:b])


def test_rows_without_label_are_no_class(spark):
    from riskweft.operators import resample

    rows = [(k, 0 if k < 40 else 1 if k < 52 else None, float(k), float(k % 7) if k != 50 else float("inf")) for k in range(55)]
    rows = [(i, y, None if i in (45, 46) else a, b) for i, y, a, b in rows]
    df = spark.createDataFrame(rows, "event_id bigint, isFraud int, a double, b double").repartition(3)
    assert resample.class_weights(df) == {0: 52 / 80, 1: 52 / 24}
    for out in (resample.smote(df, ["a", "b"]), resample.random_oversample(df), resample.rebalance(df, ["a", "b"])):
        counts = {r[0]: r[1] for r in out.groupBy("isFraud").count().collect()}
        assert counts == {0: 40, 1: 40, None: 3}


def test_training_drops_rows_without_label(spark, sf):
    import pytest

    from riskweft.plans.jobs import train_job
    from riskweft.session import scratch_path
    from riskweft.sources.transactions import transactions_as_text

    df, out = transactions_as_text(spark, sf), scratch_path(spark, "rejected")
    model, scored = train_job(df, "decision_tree", overrides={"max_depth": 3}, rejected=out)
    assert scored.count() > 0 and scored.filter("isFraud is null").count() == 0
    assert spark.read.parquet(out).filter("error is null").count() == 0
    with pytest.raises(ValueError, match="has a isFraud"):
        train_job(df.withColumn("isFraud", df["isFraud"].substr(0, 0)), "decision_tree")


def test_rows_without_probability_go_to_the_quarantine(spark):
    from riskweft.session import scratch_path
    from riskweft.streaming import scoring

    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    df = spark.createDataFrame([(1, 1, 0.9), (2, 1, None)], "event_id bigint, step int, p double")
    scoring.response_handler("p", good, bad)(df, 0)
    assert spark.read.parquet(good).count() == 1
    assert [r["error"] for r in spark.read.parquet(bad).collect()] == ["p is missing"]
