"""Saving and loading of fitted models with their threshold, metrics and metadata."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskweft.operators.ensembles import Bagging, SoftVote, Stacking
from riskweft.operators.models import model_info
from riskweft.operators.training import Trained

METADATA = "name string, threshold double, metrics string, features string, info string, seed int, saved_at string"


def save_model(trained: Trained, path: str, spark: SparkSession, seed: int = 42) -> str:
    """``path/stages`` holds preprocessor and classifier, ``path/metadata`` one JSON row about them."""
    base = path.rstrip("/")
    PipelineModel(stages=[trained.preprocessor, trained.model]).write().overwrite().save(f"{base}/stages")
    names = trained.preprocessor.feature_names()
    row = (
        trained.name,
        float(trained.threshold),
        json.dumps({k: v for k, v in trained.metrics.items()}),
        json.dumps(names),
        json.dumps(model_info(trained.name, trained.model, names)),
        seed,
        datetime.now(timezone.utc).isoformat(timespec="seconds"),
    )
    spark.createDataFrame([row], METADATA).coalesce(1).write.mode("overwrite").json(f"{base}/metadata")
    return base


def load_metadata(path: str, spark: SparkSession) -> DataFrame:
    return spark.read.schema(METADATA).json(f"{path.rstrip('/')}/metadata")


def load_model(path: str, spark: SparkSession) -> Trained:
    """A missing part is an error raised by the read."""
    stages = PipelineModel.load(f"{path.rstrip('/')}/stages").stages
    row = load_metadata(path, spark).first()
    if row is None or len(stages) != 2:
        raise FileNotFoundError(f"incomplete model at {path}")
    return Trained(row["name"], stages[0], stages[1], row["threshold"], json.loads(row["metrics"]))


def model_info_table(trained: Trained, spark: SparkSession) -> DataFrame:
    info = model_info(trained.name, trained.model, trained.preprocessor.feature_names())
    return spark.createDataFrame(
        [(info["model"], info["class_name"], info["n_features"], int(info["has_importances"]))],
        "model string, class_name string, n_features int, has_importances int",
    )


# ---- ensembles -------------------------------------------------------------------------------------------------------

MEMBERS = "kind string, member int, features array<int>"


def save_ensemble(ensemble: SoftVote | Bagging | Stacking, path: str, spark: SparkSession, seed: int = 42) -> str:
    """``path/members`` holds kind and feature places of each member as Parquet, ``path/member=i`` the members themselves.

    A bag's preprocessor and a stack's final model lie beside them. The list of members is written last: without it the
    ensemble is not there.
    """
    base = path.rstrip("/")
    if isinstance(ensemble, Bagging):
        kind, places = "bagging", [list(indices) for indices, _ in ensemble.members]
        PipelineModel(stages=[ensemble.preprocessor]).write().overwrite().save(f"{base}/preprocessor")
        for i, (_, model) in enumerate(ensemble.members):
            PipelineModel(stages=[model]).write().overwrite().save(f"{base}/member={i}")
    elif isinstance(ensemble, (SoftVote, Stacking)):
        kind, places = "stacking" if isinstance(ensemble, Stacking) else "soft_vote", [[] for _ in ensemble.members]
        for i, member in enumerate(ensemble.members):
            save_model(member, f"{base}/member={i}", spark, seed)
        if isinstance(ensemble, Stacking):
            PipelineModel(stages=[ensemble.final]).write().overwrite().save(f"{base}/final")
    else:
        raise TypeError(f"no ensemble: {type(ensemble).__name__}")
    rows = [(kind, i, indices) for i, indices in enumerate(places)]
    spark.createDataFrame(rows, MEMBERS).coalesce(1).write.mode("overwrite").parquet(f"{base}/members")
    return base


def load_ensemble(path: str, spark: SparkSession) -> SoftVote | Bagging | Stacking:
    """A missing part is an error raised by the read."""
    base = path.rstrip("/")
    rows = spark.read.schema(MEMBERS).parquet(f"{base}/members").orderBy("member").collect()
    if not rows:
        raise FileNotFoundError(f"incomplete ensemble at {path}")

    def only_stage(part: str):
        return PipelineModel.load(f"{base}/{part}").stages[0]

    if rows[0]["kind"] == "bagging":
        return Bagging(only_stage("preprocessor"), [(list(r["features"]), only_stage(f"member={r['member']}")) for r in rows])
    members = [load_model(f"{base}/member={r['member']}", spark) for r in rows]
    return SoftVote(members) if rows[0]["kind"] == "soft_vote" else Stacking(members, only_stage("final"))
