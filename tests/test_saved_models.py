"""Saved models and ensembles score as before; one fit of boosted trees answers for fewer rounds; folds in time; target means."""

import random

import pytest
from pyspark.sql import functions as F

from riskweft.operators import encoding, ensembles, splits, tuning
from riskweft.operators.models import first_trees
from riskweft.operators.training import train
from riskweft.schema import REQUIRED_COLUMNS
from riskweft.sources import artifacts

SMALL = {
    "random_forest": {"n_estimators": 3, "max_depth": 4},
    "gradient_boosting": {"n_estimators": 2},
    "xgboost": {"n_estimators": 2, "max_depth": 3},
    "lightgbm": {"n_estimators": 2, "num_leaves": 8},
    "catboost": {"n_estimators": 2, "max_depth": 3},
    "adaboost": {"n_estimators": 2},
    "mlp": {"hidden_layer_sizes": (4,), "max_iter": 5},
    "logistic": {"max_iter": 10},
}


@pytest.fixture(scope="module")
def table(txn):
    return txn.select("event_id", *REQUIRED_COLUMNS).coalesce(1).cache()


@pytest.fixture(scope="module")
def fitted(table):
    """Models by name, fitted when a test asks for them."""

    class Fits(dict):
        def __missing__(self, name):
            shared = next((t.preprocessor for t in self.values()), None)
            self[name] = train(table, name, overrides=SMALL.get(name), preprocessor=shared)
            return self[name]

    return Fits()


def scores(scorer, df):
    return {r["event_id"]: r["score"] for r in scorer.score(df).select("event_id", "score").collect()}


# The kernel machine takes minutes to fit; the queries a13_saved_* run all models.
@pytest.mark.parametrize("name", ["logistic", "adaboost", "xgboost", "knn"])
def test_every_model_scores_as_before(spark, table, fitted, tmp_path, name):
    path = artifacts.save_model(fitted[name], str(tmp_path / name), spark)
    before, after = scores(fitted[name], table), scores(artifacts.load_model(path, spark), table)
    assert len(after) == 1000 and after == before


def test_every_ensemble_scores_as_before(spark, table, fitted, tmp_path):
    found = {
        "vote": ensembles.SoftVote([fitted["logistic"], fitted["knn"]]),
        "bag": ensembles.bagging(table, "decision_tree", members=2, overrides={"max_depth": 3}),
        "stack": ensembles.stacking(table, ["naive_bayes", "decision_tree"], folds=2, overrides={"decision_tree": {"max_depth": 3}}),
    }
    for kind, scorer in found.items():
        path = artifacts.save_ensemble(scorer, str(tmp_path / kind), spark)
        loaded = artifacts.load_ensemble(path, spark)
        assert type(loaded) is type(scorer) and scores(loaded, table) == scores(scorer, table)
    with pytest.raises(TypeError):
        artifacts.save_ensemble(fitted["knn"], str(tmp_path / "none"), spark)


def test_first_rounds_are_the_smaller_fit(table):
    options = {"max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}
    whole = train(table, "xgboost", overrides={**options, "n_estimators": 5})
    part = train(table, "xgboost", overrides={**options, "n_estimators": 2}, preprocessor=whole.preprocessor)
    cut = first_trees(whole.model, 2)
    assert cut.getNumTrees == 2 and first_trees(whole.model, 99).getNumTrees == 5
    whole.model = cut
    assert scores(whole, table) == pytest.approx(scores(part, table), abs=1e-12)


def test_real_search_with_families(table):
    several = [{"n_estimators": n, "max_depth": d} for d in (2, 3) for n in (1, 3)]
    assert tuning.families("gradient_boosting", several) == [[0, 1], [2, 3]]
    assert tuning.families("random_forest", several) == [[0], [1], [2], [3]]
    candidates = several[:2]
    best, found = tuning.search(table, "gradient_boosting", candidates, folds=2)
    rows = {r["trial"]: r for r in found.collect()}
    assert len(rows) == 2 and rows[candidates.index(best)]["is_best"] == 1
    alone = tuning.cross_validate(table, "gradient_boosting", candidates[0], folds=2)
    assert rows[0]["mean_score"] == pytest.approx(sum(alone) / 2, abs=1e-9)


def test_time_blocks_and_folds(spark):
    rows = [(i, None if i % 10 == 0 else i // 3, i % 2) for i in range(47)]
    df = spark.createDataFrame(rows, "event_id long, step long, isFraud int")
    block = {r["event_id"]: r["block"] for r in splits.time_blocks(df, 4).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    size = 47 // 5
    assert [block[r[0]] for r in order] == [0] * (47 - 4 * size) + [j for j in range(1, 5) for _ in range(size)]
    folds = {r["fold"]: r for r in splits.time_folds(df, 4).collect()}
    assert [folds[f]["train_rows"] for f in range(1, 5)] == [11, 20, 29, 38] and {folds[f]["test_rows"] for f in folds} == {9}
    assert all(folds[f]["train_last"] <= folds[f]["test_first"] for f in range(1, 4))
    assert splits.time_blocks(df.limit(0), 4).count() == 0


def test_models_validated_over_time(table):
    found = tuning.cross_validate_over_time(table, "decision_tree", {"max_depth": 3}, folds=2)
    assert len(found) == 2 and all(v is None or 0 <= v <= 1 for v in found)
    with pytest.raises(ValueError):
        tuning.cross_validate_over_time(table, "decision_tree", scoring="nope")


@pytest.mark.parametrize("hot_share", [2000, 3])
def test_out_of_fold_means_equal_plain_loops(spark, monkeypatch, hot_share):
    monkeypatch.setattr(encoding, "HOT_SHARE", hot_share)
    rng = random.Random(4)
    names = [None if i % 17 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(40)}" for i in range(600)]
    rows = [(i, a, rng.randrange(2), i % 5, "x") for i, a in enumerate(names)]
    df = spark.createDataFrame(rows, "event_id long, account string, isFraud int, fold int, _n string").repartition(5)
    found = {r["event_id"]: r["encoded"] for r in encoding.out_of_fold_means(df, "account", "encoded").collect()}
    for i, account, _, fold, _ in rows:
        others = [y for _, _, y, f, _ in rows if f != fold]
        own = [y for _, a, y, f, _ in rows if f != fold and a == account and a is not None]
        prior = sum(others) / len(others)
        assert found[i] == pytest.approx((sum(own) + 20 * prior) / (len(own) + 20))
    encoder = encoding.fit_target_encoder(df, "account")
    fresh = spark.createDataFrame([(1, "hot"), (2, None), (3, "never")], "event_id long, account string")
    got = {r["event_id"]: r["m"] for r in encoder.transform(fresh, "m").collect()}
    hot = [y for _, a, y, _, _ in rows if a == "hot"]
    prior = sum(r[2] for r in rows) / len(rows)
    assert got[1] == pytest.approx((sum(hot) + 20 * prior) / (len(hot) + 20)) and got[2] == got[3] == pytest.approx(prior)


def test_target_means_of_empty_tables(spark):
    empty = spark.createDataFrame([], "event_id long, account string, isFraud int")
    assert encoding.out_of_fold_means(empty, "account", "m").count() == 0
    fresh = spark.createDataFrame([(1, "a")], "event_id long, account string")
    assert encoding.fit_target_encoder(empty, "account").transform(fresh, "m").first()["m"] == 0.0
