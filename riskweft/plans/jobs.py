"""End-to-end jobs: training, scoring and extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweft.operators import metrics, quality_report, splits, tuning
from riskweft.operators.explain import feature_importances
from riskweft.operators.scoring import score_requests
from riskweft.operators.training import Trained, train
from riskweft.operators.validation import cast_schema, require_columns
from riskweft.schema import LABEL
from riskweft.sources import artifacts, inspection, writers


def train_job(
    df: DataFrame,
    name: str = "xgboost",
    sampler: str = "weights",
    overrides: dict | None = None,
    train_size: int | None = None,
    eval_size: int | None = None,
    target_recall: float = metrics.TARGET_RECALL,
    path: str | None = None,
    row_id: str = "event_id",
    rejected: str | None = None,
    tune_hyperparameters: bool = False,
    n_trials: int = 20,
) -> tuple[Trained, DataFrame]:
    """Cast, check, split in time, fit, tune the threshold on the middle part and measure on the last.

    Returns the trained model and the scored test rows. Sizes default to 60 % and 20 % of the rows. Rows whose label is missing
    or no number leave before the split; with ``rejected`` they are written there with the reason. If no row has a label, it
    is an error. With ``tune_hyperparameters`` the first part is searched for the best of ``n_trials`` settings before the fit;
    ``overrides`` go first.
    """
    cast = require_columns(cast_schema(df.drop("score")))
    typed = cast.filter(F.col(LABEL).isNotNull())
    if typed.isEmpty():
        raise ValueError(f"none of the {cast.count()} rows has a {LABEL}")
    if rejected:
        unlabelled = cast.filter(F.col(LABEL).isNull()).withColumn("error", F.lit(f"{LABEL} is missing"))
        writers.export_table(unlabelled, rejected, "parquet", "overwrite")
    if train_size is None or eval_size is None:
        parted = splits.fractional_split(typed, 0.6, 0.2, tie=row_id)
    else:
        parted = splits.temporal_split(typed, train_size, eval_size, tie=row_id)
    first, middle, last = splits.split_parts(parted)
    if tune_hyperparameters:
        best, _ = tuning.tune(first, name, n_trials, sampler=sampler, row_id=row_id)
        overrides = {**best, **(overrides or {})}
    trained = train(first, name, sampler, overrides, row_id=row_id)
    tuned = metrics.threshold_for_recall(metrics.score_runs(trained.score(middle)), target_recall).first()[0]
    scored = trained.score(last)
    trained.threshold = float(tuned)
    trained.metrics = {k: float(v) for k, v in metrics.evaluate(scored, trained.threshold).first().asDict().items() if v is not None}
    if path:
        artifacts.save_model(trained, path, df.sparkSession)
    return trained, scored


def evaluation_tables(scored: DataFrame, threshold: float) -> dict[str, DataFrame]:
    """Every table of the evaluation report."""
    runs = metrics.score_runs(scored)
    bundle = metrics.evaluate(scored, threshold)
    counts = metrics.confusion_at(scored, [threshold])
    names = [*metrics.metric_columns(), "roc_auc", "pr_auc"]
    return {
        "metrics": metrics.to_long(bundle, names),
        "confusion": metrics.confusion_matrix(scored, (F.col("score") >= threshold).cast("int")),
        "class_report": metrics.class_report(counts),
        "comparison": metrics.compare_thresholds(scored, threshold),
        "sweep": metrics.threshold_sweep(scored),
        "roc": metrics.roc_points(runs),
        "precision_recall": metrics.pr_points(runs),
        "histogram": metrics.score_histogram(scored),
        "impact": metrics.business_impact(scored, threshold),
        "advice": metrics.advice(bundle),
    }


# Tables whose number of rows does not depend on the data; the others are written, not rendered.
RENDERED = ["metrics", "confusion", "class_report", "comparison", "sweep", "impact", "advice"]


def evaluation_report(scored: DataFrame, threshold: float, path: str | None = None, title: str = "Model evaluation") -> str:
    """Markdown of the small tables; with ``path`` every table is written next to it as parquet."""
    tables = evaluation_tables(scored, threshold)
    if path:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    lines = [f"# {title}", "", f"Decision threshold: {threshold:.4f}"]
    for name in RENDERED:
        table = tables[name]
        lines += ["", f"## {name}", "", "| " + " | ".join(table.columns) + " |", "|" + "---|" * len(table.columns)]
        for row in table.orderBy(table.columns[0]).collect():
            lines.append("| " + " | ".join(f"{v:.4f}" if isinstance(v, float) else str(v) for v in row) + " |")
    return "\n".join(lines) + "\n"


def score_job(requests: DataFrame, model_path: str, out: str, spark: SparkSession, threshold: float | None = None, fmt: str = "csv") -> tuple[str, str]:
    """Score a table of requests with a saved model; returns the paths of the scored and the rejected rows."""
    trained = artifacts.load_model(model_path, spark)
    scored, rejected = score_requests(requests, trained, trained.threshold if threshold is None else threshold)
    return writers.write_predictions(scored, out, fmt=fmt), writers.export_table(rejected, f"{out.rstrip('/')}/rejected", "json", "overwrite")


def extract_job(df: DataFrame, out: str, sample_size: int = 10_000, stratified: bool = True, row_id: str = "event_id") -> dict[str, DataFrame]:
    """Sample, its summary, an inspection report and a quality report, written under ``out``."""
    typed = require_columns(cast_schema(df))
    sample = splits.stratified_sample(typed, sample_size, row_id=row_id) if stratified else splits.random_sample(typed, sample_size, row_id=row_id)
    base = out.rstrip("/")
    writers.export_table(sample, f"{base}/sample", "parquet", "overwrite")
    stored = df.sparkSession.read.parquet(f"{base}/sample")
    tables = {
        "summary": sample_summary(stored),
        "inspection": inspection.inspection_report(typed, [row_id]),
        "quality": quality_report.quality_report(typed),
        "recommendations": quality_report.recommendations(typed),
    }
    for name, table in tables.items():
        writers.export_table(table, f"{base}/{name}", "json", "overwrite")
    return {"sample": stored, **tables}


def sample_summary(sample: DataFrame) -> DataFrame:
    """(section, item, value): rows, classes and types of a sample."""
    from riskweft.operators.profile import value_counts

    size = sample.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows").alias("section"), F.lit("all").alias("item"), "value")
    classes = value_counts(sample, F.col("isFraud").cast("string"), "item").select(F.lit("class").alias("section"), "item", F.col("count").alias("value"))
    types = value_counts(sample, F.col("type"), "item").select(F.lit("type").alias("section"), "item", F.col("count").alias("value"))
    return size.unionByName(classes).unionByName(types)


def explain_job(trained: Trained, spark: SparkSession, top: int = 20) -> DataFrame:
    return feature_importances(trained, spark, top)
