"""Training: rebalancing inside the training rows only, then one estimator fit on the executors."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.operators import resample
from riskweft.operators.metrics import evaluate
from riskweft.operators.boosting import boost_together
from riskweft.operators.models import FEATURES, TARGET, WEIGHTING, boost_settings, build_classifier, parameters, with_probability
from riskweft.operators.preprocess import Preprocessor, PreprocessorModel
from riskweft.schema import LABEL

SAMPLERS = ("none", "weights", "smote", "oversample")


@dataclass
class Trained:
    """A fitted preprocessor and classifier with what is known about them."""

    name: str
    preprocessor: PreprocessorModel
    model: Model
    threshold: float = 0.5
    metrics: dict = field(default_factory=dict)
    seconds: float = 0.0

    def score(self, df: DataFrame, output: str = "score") -> DataFrame:
        """The input columns and the positive-class probability."""
        prepared = self.preprocessor.transform(df)
        return with_probability(self.model, prepared, output).select(*df.columns, output)


def training_frame(
    df: DataFrame, preprocessor: PreprocessorModel, name: str, sampler: str, overrides: dict | None, row_id: str, seed: int
) -> tuple[DataFrame, str | None]:
    """(row id, features, label[, weight]) of the training rows after rebalancing, and the weight column."""
    if sampler not in SAMPLERS:
        raise ValueError(f"unknown sampler {sampler!r}, choose one of {SAMPLERS}")
    if sampler == "smote":
        names = preprocessor.feature_names()
        flat = preprocessor.to_frame(df, keep=[row_id, LABEL])
        balanced = resample.rebalance(flat, names, LABEL, row_id, seed=seed)
        assembled = VectorAssembler(inputCols=names, outputCol=FEATURES).transform(balanced)
        return assembled.select(row_id, "copy", FEATURES, F.col(LABEL).cast("double").alias(TARGET), "weight"), "weight"
    if sampler == "oversample":
        df = resample.random_oversample(df, LABEL, row_id, seed)
    copy = ["copy"] if sampler == "oversample" else []
    frame = preprocessor.transform(df).select(row_id, *copy, FEATURES, F.col(LABEL).cast("double").alias(TARGET))
    if sampler == "weights" and name in WEIGHTING:
        if WEIGHTING[name] == "balanced":
            return resample.with_class_weights(frame, TARGET), "weight"
        return resample.with_positive_weight(frame, parameters(name, overrides).get("scale_pos_weight"), TARGET), "weight"
    return frame, None


# Rows of a partition in training, on average, where the table has enough of them.
PART_ROWS = 500_000
#: Fits that run side by side at most, and the rows that they keep together.
MOST_FITS, SIDE_ROWS = 8, 8_000_000


def side_by_side(spark, rows: int) -> int:
    """Fits of so many rows that may run at once: each keeps its training rows, so large tables are fitted one after another."""
    slots = min(MOST_FITS, max(2, spark.sparkContext.defaultParallelism))
    return max(1, min(slots, SIDE_ROWS // max(rows, 1)))


def spread(frame: DataFrame, row_id: str, rows: int, fits: int = 1) -> DataFrame:
    """Even partitions for the many passes of a fit, whatever the layout of the input and of the synthetic rows.

    Their number follows ``rows``, those of the table before rebalancing, which at most doubles it. ``fits`` fits that run side by
    side share the slots.
    """
    parts = max(math.ceil(frame.sparkSession.sparkContext.defaultParallelism / fits), math.ceil(2 * rows / PART_ROWS))
    keys = [row_id] + (["copy"] if "copy" in frame.columns else [])
    return frame.repartition(parts, *keys)


def train(
    df: DataFrame,
    name: str = "xgboost",
    sampler: str = "weights",
    overrides: dict | None = None,
    preprocessor: Preprocessor | PreprocessorModel | None = None,
    row_id: str = "event_id",
    seed: int = 42,
    fits: int = 1,
) -> Trained:
    """Fit preprocessor (unless a fitted one is given) and classifier on the rows of ``df``; ``fits`` such fits run side by side."""
    started = time.monotonic()
    preprocessor = preprocessor or Preprocessor()
    size = df.count()
    ready = isinstance(preprocessor, PreprocessorModel)
    # Fitting the preprocessing takes many passes too. Every estimator keeps its own copy of the feature vectors, so only the input
    # columns are kept here, a fraction of their size; synthetic rows, which cost more to make, are dealt again and kept.
    rows = spread(df, row_id, size, fits).persist()
    fitted = preprocessor if ready else preprocessor.fit(rows)
    frame, weight = training_frame(rows, fitted, name, sampler, overrides, row_id, seed)
    copies = "copy" in frame.columns
    if copies:
        frame = spread(frame, row_id, size, fits).persist()
    total = frame.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    if copies:
        rows.unpersist()
    estimator = build_classifier(name, overrides, len(fitted.feature_names()), weight, seed, row_id, float(total or 1))
    model = estimator.fit(frame)
    (frame if copies else rows).unpersist()
    return Trained(name, fitted, model, seconds=time.monotonic() - started)


def train_boosted(
    df: DataFrame, candidates: list[tuple[str, dict | None]], sampler: str, preprocessor: PreprocessorModel, row_id: str = "event_id", seed: int = 42, fits: int = 1
) -> list[Trained]:
    """Boosted trees of several (name, overrides) on the same rows: they grow in step, a pass over the rows answers all of them."""
    started = time.monotonic()
    size = df.count()
    # Class weights differ by candidate, so they are factors of the positive rows here instead of a column.
    frame, weight = training_frame(df, preprocessor, candidates[0][0], "none" if sampler == "weights" else sampler, None, row_id, seed)
    frame = spread(frame, row_id, size, fits).persist()
    boosts = []
    for name, overrides in candidates:
        p, positive = parameters(name, overrides), 1.0
        if sampler == "weights" and name in WEIGHTING:
            positive = float(p.get("scale_pos_weight") or resample.class_ratio(frame, TARGET))
        boosts.append(boost_settings(p, seed, positive))
    models = boost_together(frame, boosts, FEATURES, TARGET, weight, [c for c in (row_id, "copy") if c in frame.columns], fits)
    frame.unpersist()
    seconds = time.monotonic() - started
    return [Trained(name, preprocessor, model, seconds=seconds) for (name, _), model in zip(candidates, models)]


def assess(trained: Trained, df: DataFrame) -> dict:
    """Metric bundle of the model on the given rows, as a plain dict."""
    scored = trained.score(df.select(*[c for c in df.columns if c != "score"]))
    return evaluate(scored, trained.threshold).first().asDict()
