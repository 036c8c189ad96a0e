import random
from itertools import product

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskweft.operators import explain, knn, models, preprocess, resample, selection, tuning
from riskweft.operators.training import train
from riskweft.plans import catalog, jobs, queries_models
from riskweft.schema import REQUIRED_COLUMNS
from riskweft.sources import artifacts
from riskweft.sources.transactions import transactions


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(420, 3)) * 3, 1)
    points[100:240] = points[100]  # a third of the rows are copies of one point
    points[400:405] = points[100]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    df = knn.as_points(spark.createDataFrame(rows, "id bigint, a double, b double, c double"), "id", ["a", "b", "c"])
    for per_pivot, block in ((10_000, 10_000), (40, 50)):
        near = knn.knn_join(df, df, 4, exclude_self=True, points_per_pivot=per_pivot, block_rows=block)
        found = {}
        for r in near.collect():
            found.setdefault(r["id"], {})[r["place"]] = r["neighbour"]
        d = ((points[:, None, :] - points[None, :, :]) ** 2)
        d = d[:, :, 0] + d[:, :, 1] + d[:, :, 2]
        np.fill_diagonal(d, np.inf)
        for i in range(len(points)):
            expected = sorted(range(len(points)), key=lambda j: (d[i, j], j))[:4]
            assert [found[i][p] for p in (1, 2, 3, 4)] == expected


def test_smote_stays_inside_the_class(spark, txn):
    names = ["amount", "oldbalanceOrg"]
    bounds = txn.filter("isFraud = 1").agg(*[F.struct(F.min(c), F.max(c)) for c in names]).first()
    balanced = resample.smote(txn, names)
    assert {r["isFraud"]: r["count"] for r in balanced.groupBy("isFraud").count().collect()} == {0: 983, 1: 983}
    made = balanced.filter("copy > 0").agg(*[F.struct(F.min(c), F.max(c)) for c in names]).first()
    for have, allowed in zip(made, bounds):
        assert have[0] >= allowed[0] and have[1] <= allowed[1]
    with pytest.raises(ValueError):
        resample.synthetic_minority(txn, names, k=17)


def test_many_copies_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(resample, "COPIES_PER_TASK", 50)
    df = spark.range(1003).select(F.col("id").alias("event_id"), (F.col("id") < 3).cast("int").alias("isFraud"))
    balanced = resample.random_oversample(df)
    assert {r["isFraud"]: r["count"] for r in balanced.groupBy("isFraud").count().collect()} == {0: 1000, 1: 1000}
    assert balanced.filter("isFraud = 1").distinct().count() == 1000


def test_preprocessor_fit_transform_and_save_load(spark, tmp_path):
    columns = "step bigint, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double"
    rows = [
        (1, "TRANSFER", 100.0, "C1", 1000.0, 900.0, "M1", 0.0, 100.0),
        (2, "PAYMENT", 200.0, "C2", 2000.0, 1800.0, "M2", 0.0, 200.0),
        (3, "CASH_OUT", 300.0, "C3", 3000.0, 2700.0, "C1", 100.0, 400.0),
    ]
    df = spark.createDataFrame(rows, columns)
    fitted = preprocess.Preprocessor().fit(df)
    frame = fitted.to_frame(df)
    assert frame.count() == 3 and len(frame.columns) > len(df.columns)
    fitted.write().overwrite().save(str(tmp_path / "pre"))
    loaded = preprocess.PreprocessorModel.load(str(tmp_path / "pre"))
    assert loaded.feature_names() == fitted.feature_names()
    assert loaded.to_frame(df).collect() == frame.collect()
    with pytest.raises(ValueError):
        preprocess.PreprocessorModel().transform(df)


def test_unseen_categories(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "type string")
    found = preprocess.fit_categories(df, ["type"])
    new = spark.createDataFrame([("z",)], "type string")
    assert list(new.select(*preprocess.one_hot("type", found["type"], True).values()).first()) == [0.0, 0.0]
    with pytest.raises(Exception, match="unseen value"):
        new.select(preprocess.label_code("type", found["type"])).collect()


@pytest.fixture(scope="module")
def uniform(spark):
    rng = random.Random(0)
    rows = [(i, *[rng.random() for _ in range(10)], rng.randint(0, 1)) for i in range(100)]
    return spark.createDataFrame(rows, ["event_id", *[f"f{i}" for i in range(10)], "y"])


def test_feature_selection(uniform):
    names = [f"f{i}" for i in range(10)]
    chosen = selection.FeatureSelector("select_k_best", 5).fit(uniform, names, "y")
    assert len(chosen.transform(uniform).columns) == 5
    kept, dropped = selection.eliminate_features(uniform, names, "y", k=5, step=2, trees=3, depth=3)
    assert len(kept) == 5 and sorted(kept + [c for c, _ in dropped]) == sorted(names)
    with pytest.warns(UserWarning):
        assert selection.FeatureSelector("other").fit(uniform, names, "y").selected == names


@pytest.mark.parametrize("name,overrides", [("svm", {}), ("adaboost", {"n_estimators": 3}), ("mlp", {"hidden_layer_sizes": (4,), "max_iter": 5}), ("knn", {})])
def test_new_models_predict_every_row(uniform, name, overrides):
    frame = VectorAssembler(inputCols=[f"f{i}" for i in range(5)], outputCol="features").transform(uniform)
    frame = frame.select("event_id", "features", F.col("y").cast("double").alias("label"))
    model = models.build_classifier(name, overrides, inputs=5).fit(frame)
    scored = models.with_probability(model, frame, "p").collect()
    assert len(scored) == 100 and all(0.0 <= r["p"] <= 1.0 for r in scored)


def test_unknown_names_are_errors(uniform):
    with pytest.raises(ValueError):
        models.build_classifier("nope")
    with pytest.raises(ValueError):
        tuning.cross_validate(uniform, "logistic", scoring="nope")


def test_search_candidates():
    drawn = tuning.draw(tuning.SEARCH_SPACES["xgboost"], 20)
    assert len(drawn) == 20 and drawn == tuning.draw(tuning.SEARCH_SPACES["xgboost"], 20)
    assert all(0.01 <= c["learning_rate"] <= 0.3 and 3 <= c["max_depth"] <= 10 for c in drawn)
    assert tuning.draw({}, 5) == [{}]
    assert len(tuning.grid("random_forest")) == len(list(product([1] * 3, [1] * 3, [1] * 2)))


def test_registered_searches_run_the_defaults(spark, monkeypatch):
    calls, sf = [], "/root/testdata/sf0.001"
    table = spark.createDataFrame([(0, "m", "p", 0.5, 1)], "trial int, model string, parameters string, mean_score double, is_best int")

    def search(df, name, candidates, folds, scoring, **kw):
        calls.append((name, candidates, folds, scoring, kw))
        return candidates[0], table

    def eliminate(df, columns, label, **kw):
        calls.append((len(columns), kw))
        return columns, []

    board = spark.createDataFrame([(n, float(i)) for i, n in enumerate(["svm", "knn", "logistic", "mlp", "xgboost"])], "model string, pr_auc double")
    monkeypatch.setattr(tuning, "search", search)
    monkeypatch.setattr(selection, "eliminate_features", eliminate)
    monkeypatch.setattr(queries_models, "_leaderboard", lambda spark, sf: board)
    registered = catalog.queries()
    registered["k19_tuned_model"](spark, sf)
    assert calls == [("xgboost", tuning.draw(tuning.SEARCH_SPACES["xgboost"], 20), 5, "roc_auc", {})]
    calls.clear()
    assert registered["k20_randomised_search"](spark, sf).count() == 3
    assert calls == [(n, tuning.sample_grid(n, 20), 3, "pr_auc", {}) for n in ("xgboost", "mlp", "logistic")]
    calls.clear()
    registered["k2_recursive_elimination"](spark, sf)
    assert calls[0][0] > selection.DEFAULT_FEATURES and not calls[0][1]


def test_train_job_saves_scores_and_explains(spark, tmp_path):
    # The smallest tables have no positives in the last hours.
    table = transactions(spark, "/root/testdata/sf0.01").select("event_id", *REQUIRED_COLUMNS)
    trained, scored = jobs.train_job(table, "xgboost", overrides={"n_estimators": 3, "max_depth": 4}, path=str(tmp_path / "m"))
    assert trained.metrics["roc_auc"] > 0.9
    loaded = artifacts.load_model(str(tmp_path / "m"), spark)
    assert loaded.threshold == trained.threshold and loaded.metrics == trained.metrics
    left = {r["event_id"]: r["score"] for r in trained.score(table).collect()}
    assert left == {r["event_id"]: r["score"] for r in loaded.score(table).collect()}
    text = jobs.evaluation_report(scored, trained.threshold, str(tmp_path / "r"))
    assert "## metrics" in text and spark.read.parquet(str(tmp_path / "r" / "roc")).count() > 1
    values = explain.shapley_values(trained, scored.drop("score"), sample_rows=40, permutations=2)
    # contributions of a row add up to its score minus the mean score of its partners, so over all rows they cancel out
    assert values.select("event_id").distinct().count() == 40
    assert values.agg(F.sum("value")).first()[0] == pytest.approx(0.0, abs=1e-6)
    assert explain.feature_importances(trained, spark, 5).count() == 5


def test_samplers(txn):
    table = txn.select("event_id", *REQUIRED_COLUMNS)
    for sampler in ("smote", "oversample"):
        trained = train(table, "decision_tree", sampler, {"max_depth": 3})
        assert trained.score(table).count() == 1000
    with pytest.raises(ValueError):
        train(table, "decision_tree", "other")
