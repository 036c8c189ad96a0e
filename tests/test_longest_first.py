from types import SimpleNamespace

from riskweft.operators import ensembles
from riskweft.operators.metrics import BASIC_METRICS


def test_long_fits_and_scores_begin_first(spark, monkeypatch):
    names, fitted, assessed = ["logistic", "xgboost", "random_forest", "svm", "mlp", "knn"], [], []

    def trained(name):
        fitted.append(name)
        return SimpleNamespace(name=name, seconds=float(len(name)))

    def assess(model, rows):
        assessed.append(model.name)
        return dict.fromkeys(BASIC_METRICS, float(names.index(model.name)))

    monkeypatch.setattr(ensembles, "train", lambda rows, name, *args: trained(name))
    monkeypatch.setattr(ensembles, "train_boosted", lambda rows, candidates, *args: [trained(name) for name, _ in candidates])
    monkeypatch.setattr(ensembles, "assess", assess)
    monkeypatch.setattr(ensembles, "side_by_side", lambda session, rows: 1)
    df = spark.range(10).withColumnRenamed("id", "event_id")
    models = ensembles.train_models(df, names, fitted=SimpleNamespace())
    assert list(models) == names and fitted == ["xgboost", "mlp", "svm", "random_forest", "logistic", "knn"]
    board, _ = ensembles.compare_models(df, df, names, trained=models)
    assert assessed == ["knn", "random_forest", "logistic", "xgboost", "svm", "mlp"]
    assert {r["model"]: (r["pr_auc"], r["seconds"]) for r in board.collect()} == {n: (float(names.index(n)), float(len(n))) for n in names}
