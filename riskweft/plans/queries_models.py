"""Registered queries: models, selection, tuning, ensembles, scoring, artefacts. Fits have no SQL equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.exprs import round_doubles
from riskweft.functions.features import create_features
from riskweft.operators import ensembles, explain, metrics, scoring, selection, splits, tuning
from riskweft.operators.models import model_names
from riskweft.operators.preprocess import Preprocessor
from riskweft.operators.training import Trained, assess, train
from riskweft.plans import jobs
from riskweft.plans.queries_profile import describe_sql, union
from riskweft.plans.queries_splits import KEYED
from riskweft.plans.queries_stats import anova_sql
from riskweft.plans.registry import query
from riskweft.schema import NUMERIC_COLUMNS, REQUIRED_COLUMNS
from riskweft.session import scratch_path
from riskweft.sources import artifacts, writers
from riskweft.sources.transactions import transactions

#: Fits of this session by application, folder and model: queries that need the same model share one.
_FITS: dict[tuple[str, str, str], Trained] = {}
#: Parts of the transactions by application and folder: the borders of the split are found once.
_PARTS: dict[tuple[str, str], tuple] = {}


def _parts(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PARTS:
        df = transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS)
        _PARTS[key] = splits.split_parts(splits.fractional_split(df))
    return _PARTS[key]


def fitted_model(spark, sf, name: str) -> Trained:
    """The model with its default settings on the first 60 % of the hours."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITS:
        first, _, _ = _parts(spark, sf)
        prepared = next((t.preprocessor for (app, folder, _), t in _FITS.items() if (app, folder) == key[:2]), None)
        _FITS[key] = train(first, name, "weights", preprocessor=prepared)
    return _FITS[key]


def fitted_models(spark, sf, names: list[str]) -> dict[str, Trained]:
    """Several models; those that are not there yet are fitted together."""
    app = spark.sparkContext.applicationId
    missing = [n for n in names if (app, sf, n) not in _FITS]
    if missing:
        prepared = next((t.preprocessor for (one, folder, _), t in _FITS.items() if (one, folder) == (app, sf)), None)
        found = ensembles.train_models(_parts(spark, sf)[0], missing, fitted=prepared)
        _FITS.update({(app, sf, n): t for n, t in found.items()})
    return {n: _FITS[app, sf, n] for n in names}


def _one_model(name: str):
    """Score every row of the last 20 % of the hours."""

    def run(spark, sf):
        _, _, last = _parts(spark, sf)
        trained = fitted_model(spark, sf, name)
        return scoring.score_batch(last.select("event_id", *REQUIRED_COLUMNS), trained).select(
            "event_id", "isFraud", "predicted_fraud", "fraud_probability", "is_fraud"
        )

    return run


MODEL_IDS = {
    "logistic": "k5",
    "decision_tree": "k6",
    "random_forest": "k7",
    "gradient_boosting": "k8",
    "xgboost": "k9",
    "lightgbm": "k10",
    "catboost": "k11",
    "adaboost": "k12",
    "svm": "k13",
    "mlp": "k14",
    "knn": "k15",
    "naive_bayes": "k16",
}
for _name, _id in MODEL_IDS.items():
    query(f"{_id}_{_name}")(_one_model(_name))


@query("k1_select_k_best", f"SELECT feature, f_score FROM ({union([anova_sql(c, 'txn', 'isFraud') for c in NUMERIC_COLUMNS])}) t ORDER BY f_score DESC LIMIT 4")
def _(spark, sf):
    df = transactions(spark, sf)
    chosen = selection.select_k_best(df, NUMERIC_COLUMNS, "isFraud", 4)
    return round_doubles(selection.ranked_features(df, NUMERIC_COLUMNS, "isFraud").filter(F.col("feature").isin(chosen)).drop("place"))


@query(
    "b13_selected_projection",
    "SELECT event_id, amount, step, newbalanceOrig, newbalanceDest FROM txn",
)
def _(spark, sf):
    df = transactions(spark, sf)
    chosen = selection.FeatureSelector("all_of_them").fit(df, ["amount", "step", "newbalanceOrig", "newbalanceDest"], "isFraud")
    return chosen.transform(df, keep=["event_id"])


@query("k2_recursive_elimination")
def _(spark, sf):
    df = create_features(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS))
    names = [c for c, t in df.dtypes if t != "string" and c not in ("event_id", "isFraud", "isFlaggedFraud", "step")]
    kept, dropped = selection.eliminate_features(df, names, "isFraud")
    rows = [(c, 0) for c in kept] + dropped
    return spark.createDataFrame(rows, "feature string, dropped_in_round int")


@query("k3_unknown_method_keeps_all", union([f"SELECT '{c}' AS feature, count({c}) AS filled FROM txn" for c in NUMERIC_COLUMNS]))
def _(spark, sf):
    from riskweft.operators.projection import role_table

    df = transactions(spark, sf)
    kept = selection.FeatureSelector("no_such_method").fit(df, NUMERIC_COLUMNS, "isFraud").transform(df)
    return role_table(kept).select("feature" if "feature" in kept.columns else F.col("column").alias("feature"), "filled")


@query("k17_k18_registry_scores")
def _(spark, sf):
    """(model, rows, mean probability) on the test rows for every model of the registry."""
    _, _, last = _parts(spark, sf)
    table = None
    for name, trained in fitted_models(spark, sf, model_names()).items():
        scored = trained.score(last)
        row = scored.agg(F.lit(name).alias("model"), F.count("score").alias("rows"), F.avg("score").alias("mean_score"))
        table = row if table is None else table.unionByName(row)
    return table


@query("k19_tuned_model")
def _(spark, sf):
    first, _, _ = _parts(spark, sf)
    return tuning.tune(first, "xgboost")[1]


@query("k20_randomised_search")
def _(spark, sf):
    """Candidates of the three models with the largest area under the precision-recall curve on the test rows."""
    first, _, _ = _parts(spark, sf)
    table = None
    for name in _best_three(spark, sf):
        one = tuning.randomised_search(first, name)[1]
        table = one if table is None else table.unionByName(one)
    return table


@query("k21_grids", union([f"SELECT '{m}' AS model, CAST({len(tuning.grid(m))} AS BIGINT) AS candidates, count(*) AS training_rows FROM txn" for m in tuning.GRIDS]))
def _(spark, sf):
    sizes = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(len(tuning.grid(m))).cast("bigint").alias("candidates")) for m in tuning.GRIDS]))
    counted = transactions(spark, sf).agg(F.count(F.lit(1)).alias("training_rows"))
    return counted.select(sizes.alias("g"), "training_rows").select("g.model", "g.candidates", "training_rows")


@query("k22_cross_validated_score")
def _(spark, sf):
    first, _, _ = _parts(spark, sf)
    scores = tuning.cross_validate(first, "logistic", None, folds=5)
    return spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "fold int, roc_auc double")


@query("k23_soft_vote")
def _(spark, sf):
    """The three models with the largest area under the precision-recall curve on the test rows."""
    _, _, last = _parts(spark, sf)
    members = [fitted_model(spark, sf, name) for name in _best_three(spark, sf)]
    return ensembles.soft_vote(members, last).select("event_id", "isFraud", "score")


@query("k24_bagging")
def _(spark, sf):
    first, _, last = _parts(spark, sf)
    return ensembles.bagging(first, "decision_tree", members=10).score(last).select("event_id", "isFraud", "score")


@query("k25_stacking")
def _(spark, sf):
    first, _, last = _parts(spark, sf)
    stacked = ensembles.stacking(first, ["logistic", "decision_tree"], folds=5)
    return stacked.score(last).select("event_id", "isFraud", "score")


def _leaderboard(spark, sf):
    first, _, last = _parts(spark, sf)
    return ensembles.compare_models(first, last, model_names(), trained=fitted_models(spark, sf, model_names()))[0]


def _best_three(spark, sf) -> list[str]:
    return [r["model"] for r in _leaderboard(spark, sf).orderBy(F.desc("pr_auc"), "model").limit(3).collect()]


@query("k26_f7_leaderboard")
def _(spark, sf):
    return _leaderboard(spark, sf).drop("seconds")


@query("f6_best_models")
def _(spark, sf):
    return ensembles.best_models(_leaderboard(spark, sf))


@query("f5_top_importances")
def _(spark, sf):
    return explain.feature_importances(fitted_model(spark, sf, "random_forest"), spark, 5)


@query("i6_resampled_training")
def _(spark, sf):
    """Rebalancing acts on the training rows only: scores of the untouched test rows."""
    first, _, last = _parts(spark, sf)
    return train(first, "logistic", "smote").score(last).select("event_id", "isFraud", "score")


# ---- artefacts -------------------------------------------------------------------------------------------------------


@query("a13_saved_model_scores")
def _(spark, sf):
    _, _, last = _parts(spark, sf)
    path = artifacts.save_model(fitted_model(spark, sf, "decision_tree"), scratch_path(spark, "model"), spark)
    return artifacts.load_model(path, spark).score(last).select("event_id", "score")


def _saved_sql(name: str) -> str:
    last = "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY step, event_id) AS i, count(*) OVER () AS n FROM txn) r"
    return f"""SELECT '{name}' AS name, count(*) AS "rows", CAST(0 AS BIGINT) AS differing
      FROM ({last} WHERE i > CAST(floor(n * 0.6e0) AS BIGINT) + CAST(floor(n * 0.2e0) AS BIGINT)) t"""


def _saved(name: str, scorer, spark, sf):
    """(name, rows, differing): a model or ensemble is saved and read back; rows of the test part whose two scores differ."""
    _, _, last = _parts(spark, sf)
    path = scratch_path(spark, "saved")
    if isinstance(scorer, Trained):
        loaded = artifacts.load_model(artifacts.save_model(scorer, path, spark), spark)
    else:
        loaded = artifacts.load_ensemble(artifacts.save_ensemble(scorer, path, spark), spark)
    both = loaded.score(scorer.score(last, "before"), "after")
    unequal = F.count(F.when(~F.col("before").eqNullSafe(F.col("after")), 1)).alias("differing")
    return both.agg(F.lit(name).alias("name"), F.count("after").alias("rows"), unequal)


for _name in model_names():
    query(f"a13_saved_{_name}", _saved_sql(_name))(lambda spark, sf, name=_name: _saved(name, fitted_model(spark, sf, name), spark, sf))


@query("a13_saved_soft_vote", _saved_sql("soft_vote"))
def _(spark, sf):
    members = list(fitted_models(spark, sf, ["logistic", "decision_tree", "naive_bayes"]).values())
    return _saved("soft_vote", ensembles.SoftVote(members), spark, sf)


@query("a13_saved_bagging", _saved_sql("bagging"))
def _(spark, sf):
    return _saved("bagging", ensembles.bagging(_parts(spark, sf)[0], "decision_tree"), spark, sf)


@query("a13_saved_stacking", _saved_sql("stacking"))
def _(spark, sf):
    return _saved("stacking", ensembles.stacking(_parts(spark, sf)[0], ["logistic", "naive_bayes"]), spark, sf)


@query("a14_model_metadata")
def _(spark, sf):
    path = scratch_path(spark, "model")
    jobs.train_job(transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS), "decision_tree", path=path)
    return artifacts.load_metadata(path, spark).drop("saved_at")


@query("a15_model_info")
def _(spark, sf):
    return artifacts.model_info_table(fitted_model(spark, sf, "decision_tree"), spark)


@query(
    "a8_sample_summary",
    """SELECT 'rows' AS section, 'all' AS item, count(*) AS value FROM s UNION ALL SELECT 'class', CAST(isFraud AS VARCHAR), count(*) FROM s GROUP BY isFraud
       UNION ALL SELECT 'type', type, count(*) FROM s GROUP BY type""",
    ctes=f"""{KEYED}, s AS (SELECT t.* FROM txn t JOIN (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY k, event_id) AS i,
         CAST(floor((n // 2) * p / n) AS BIGINT) AS q, n // 2 AS size FROM (SELECT *, count(*) OVER () AS n, CAST(sum(isFraud) OVER () AS DOUBLE) AS p FROM keyed) c) r USING (event_id)
         WHERE i <= CASE WHEN r.isFraud = 1 THEN q ELSE size - q END)""",
)
def _(spark, sf):
    df = transactions(spark, sf).select("event_id", *REQUIRED_COLUMNS)
    return jobs.extract_job(df, scratch_path(spark, "extract"), df.count() // 2)["summary"]


@query("a7_prediction_sink", "SELECT event_id, round(score, 6) AS fraud_probability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS is_fraud FROM txn")
def _(spark, sf):
    records = scoring.banded_records(transactions(spark, sf), "score").select("event_id", "fraud_probability", "is_fraud")
    path = writers.write_predictions(records, scratch_path(spark, "predictions"))
    return round_doubles(spark.read.schema("event_id bigint, fraud_probability double, is_fraud int").option("header", True).csv(path))


@query("m21_evaluation_report")
def _(spark, sf):
    scored = transactions(spark, sf).select("event_id", "isFraud", "score", "amount")
    path = scratch_path(spark, "report")
    jobs.evaluation_report(scored, 0.41, path)
    return spark.read.parquet(f"{path}/metrics")


# ---- scoring records -------------------------------------------------------------------------------------------------


@query("n1_batch_scores")
def _(spark, sf):
    _, _, last = _parts(spark, sf)
    return scoring.score_batch(last, fitted_model(spark, sf, "xgboost"))


@query("n2_batch_scores_at_threshold")
def _(spark, sf):
    _, middle, last = _parts(spark, sf)
    trained = fitted_model(spark, sf, "decision_tree")
    tuned = metrics.threshold_for_recall(metrics.score_runs(trained.score(middle))).first()[0]
    return scoring.score_batch(last, trained, tuned).select("event_id", "fraud_probability", "is_fraud")


CONFIDENCE_2 = "CASE WHEN score > 0.8 OR score < 0.2 THEN 'high' ELSE 'medium' END"
CONFIDENCE_5 = """CASE WHEN score > 0.8 THEN 'high_fraud' WHEN score > 0.6 THEN 'medium_fraud' WHEN score > 0.4 THEN 'low_confidence'
  WHEN score > 0.2 THEN 'medium_legitimate' ELSE 'high_legitimate' END"""
RESPONSE_SQL = f"SELECT event_id, step AS transaction_id, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS is_fraud, score AS fraud_probability, {CONFIDENCE_2} AS confidence FROM txn"


@query("n3_response_records", RESPONSE_SQL)
def _(spark, sf):
    return scoring.response_records(transactions(spark, sf), "score")


@query(
    "n3_response_json",
    f"SELECT event_id, CAST(r.transaction_id AS BIGINT) AS transaction_id, r.confidence AS confidence FROM (SELECT event_id, {{'transaction_id': step, 'confidence': {CONFIDENCE_2}}} AS r FROM txn) j",
)
def _(spark, sf):
    texts = scoring.response_json(scoring.response_records(transactions(spark, sf), "score"))
    parsed = F.from_json("response", "transaction_id bigint, confidence string").alias("r")
    return texts.select("event_id", parsed).select("event_id", "r.transaction_id", "r.confidence")


@query(
    "n4_banded_records",
    f"""SELECT event_id, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction, score AS fraud_probability, CASE WHEN score >= 0.41 THEN 1 ELSE 0 END AS is_fraud,
        {CONFIDENCE_5} AS confidence, 0.41e0 AS threshold_used FROM txn""",
)
def _(spark, sf):
    return scoring.banded_records(transactions(spark, sf), "score", threshold=0.41)


@query("n5_both_probabilities")
def _(spark, sf):
    _, _, last = _parts(spark, sf)
    return scoring.score_both_classes(last, fitted_model(spark, sf, "logistic"))


@query(
    "n6_score_analysis",
    """SELECT count(*) AS total, count(*) FILTER (score >= 0.5) AS flagged, round(count(*) FILTER (score >= 0.5) * 100.0e0 / count(*), 6) AS flagged_pct,
       count(*) FILTER (score > 0.8) AS high_risk FROM txn""",
)
def _(spark, sf):
    return round_doubles(scoring.analyze_scores(transactions(spark, sf), "score"))


@query("n6_score_describe", describe_sql(["score"], "txn"))
def _(spark, sf):
    from riskweft.operators.profile import describe

    return round_doubles(describe(transactions(spark, sf), ["score"]))


HIGH_RISK_COLUMNS = ["amount", "oldbalanceOrg", "newbalanceOrig"]


@query("b10_high_risk_profile", describe_sql(HIGH_RISK_COLUMNS, "risky"), ctes="risky AS (SELECT * FROM txn WHERE score > 0.8)")
def _(spark, sf):
    return round_doubles(scoring.describe_high_risk(transactions(spark, sf), "score", HIGH_RISK_COLUMNS))


@query("n7_importances")
def _(spark, sf):
    return explain.feature_importances(fitted_model(spark, sf, "xgboost"), spark, 20)


@query("n8_shapley_summary")
def _(spark, sf):
    _, _, last = _parts(spark, sf)
    trained = fitted_model(spark, sf, "decision_tree")
    return explain.shapley_summary(explain.shapley_values(trained, last))


@query("n8_linear_contributions")
def _(spark, sf):
    _, _, last = _parts(spark, sf)
    return explain.shapley_summary(
        explain.linear_contributions(fitted_model(spark, sf, "logistic"), last).withColumnRenamed("contribution", "value")
    )


@query(
    "c2_encoded_block",
    """SELECT event_id, isFraud, CASE WHEN type = 'DEBIT' THEN 1.0e0 ELSE 0.0e0 END AS type_DEBIT, CASE WHEN type = 'TRANSFER' THEN 1.0e0 ELSE 0.0e0 END AS type_TRANSFER,
       CASE WHEN amount <= 1000 AND amount > 100 THEN 1.0e0 ELSE 0.0e0 END AS amount_category_small FROM txn""",
)
def _(spark, sf):
    df = transactions(spark, sf)
    frame = Preprocessor().fit(df).to_frame(df, ["event_id", "isFraud"])
    return frame.select("event_id", "isFraud", "type_DEBIT", "type_TRANSFER", "amount_category_small")


@query("k18_quality_over_baseline")
def _(spark, sf):
    """Areas of the boosted trees and of the logistic baseline on the same test rows."""
    _, _, last = _parts(spark, sf)
    rows = []
    for name in ("logistic", "xgboost"):
        bundle = assess(fitted_model(spark, sf, name), last)
        rows.append((name, float(bundle["roc_auc"]), float(bundle["pr_auc"])))
    return spark.createDataFrame(rows, "model string, roc_auc double, pr_auc double")
