"""Ensembles of trained classifiers, and the comparison of models."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweft.functions.exprs import order_key, unit_interval
from riskweft.operators import resample
from riskweft.operators.metrics import BASIC_METRICS
from riskweft.operators.models import BOOSTED, FEATURES, TARGET, build_classifier, with_probability
from riskweft.operators.preprocess import Preprocessor, PreprocessorModel
from riskweft.operators.splits import stratified_folds
from riskweft.operators.training import Trained, assess, side_by_side, spread, train, train_boosted, training_frame
from riskweft.schema import LABEL


def _mean(columns: list[str]) -> F.Column:
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total / F.lit(float(len(columns)))


def soft_vote(members: list[Trained], df: DataFrame, output: str = "score") -> DataFrame:
    """Mean of the members' probabilities; every member adds one column to the same pass over the rows."""
    scored, names = df, []
    for i, m in enumerate(members):
        names.append(f"_p{i}")
        scored = m.score(scored, names[-1])
    return scored.select(*df.columns, _mean(names).alias(output))


@dataclass
class SoftVote:
    members: list[Trained]

    def score(self, df: DataFrame, output: str = "score") -> DataFrame:
        return soft_vote(self.members, df, output)


@dataclass
class Bagging:
    preprocessor: PreprocessorModel
    members: list[tuple[list[int], Model]]

    def score(self, df: DataFrame, output: str = "score") -> DataFrame:
        prepared = self.preprocessor.transform(df).withColumnRenamed(FEATURES, "_all")
        names = []
        for i, (indices, model) in enumerate(self.members):
            names.append(f"_p{i}")
            sliced = VectorSlicer(inputCol="_all", outputCol=FEATURES, indices=indices).transform(prepared)
            prepared = with_probability(model, sliced, names[-1]).drop(FEATURES)
        return prepared.select(*df.columns, _mean(names).alias(output))


def bagging(
    df: DataFrame, name: str, members: int = 10, rows: float = 0.8, features: float = 0.8, overrides: dict | None = None, row_id: str = "event_id", seed: int = 42
) -> Bagging:
    """Members fitted on hashed 80 % row samples and 80 % of the features each."""
    size = df.count()
    spread_rows = spread(df, row_id, size).persist()
    fitted = Preprocessor().fit(spread_rows)
    frame, weight = training_frame(spread_rows, fitted, name, "weights", overrides, row_id, seed)
    frame = frame.withColumnRenamed(FEATURES, "_all").persist()
    width = len(fitted.feature_names())
    keep = max(1, int(width * features))

    def fit(i: int) -> tuple[list[int], Model]:
        indices = sorted(random.Random(seed + i).sample(range(width), keep))
        chosen = frame.filter(unit_interval(order_key(seed + i, row_id)) < rows)
        sliced = VectorSlicer(inputCol="_all", outputCol=FEATURES, indices=indices).transform(chosen)
        total = chosen.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
        return indices, build_classifier(name, overrides, keep, weight, seed + i, row_id, float(total or 1)).fit(sliced)

    frame.count()
    spread_rows.unpersist()
    with ThreadPoolExecutor(min(members, side_by_side(df.sparkSession, size))) as pool:
        found = list(pool.map(fit, range(members)))
    frame.unpersist()
    return Bagging(fitted, found)


@dataclass
class Stacking:
    members: list[Trained]
    final: Model

    def score(self, df: DataFrame, output: str = "score") -> DataFrame:
        scored, names = df, []
        for i, m in enumerate(self.members):
            names.append(f"_p{i}")
            scored = m.score(scored, names[-1])
        vector = VectorAssembler(inputCols=names, outputCol=FEATURES).transform(scored)
        return with_probability(self.final, vector, output).select(*df.columns, output)


def stacking(df: DataFrame, names: list[str], folds: int = 3, overrides: dict[str, dict] | None = None, row_id: str = "event_id", seed: int = 42) -> Stacking:
    """Out-of-fold probabilities of the members feed a balanced logistic model; the members are then refitted on all rows.

    The members of all folds and those of all rows are fitted side by side while their rows together stay few; the medians of all of
    them come from shared passes.
    """
    folded = stratified_folds(df, folds, row_id=row_id, seed=seed)
    size = folded.count()
    folded = spread(folded, row_id, size).persist()
    options = overrides or {}
    fits = min(side_by_side(df.sparkSession, size), folds + 1)
    prepared = Preprocessor().fit_left_out(folded, "fold", fits)

    def members_of(kept: DataFrame, fitted: PreprocessorModel) -> list[Trained]:
        return [train(kept.drop("fold"), name, "weights", options.get(name), fitted, row_id, seed, fits) for name in names]

    def held_out_scores(fold: int) -> DataFrame:
        scored = folded.filter(F.col("fold") == fold).drop("fold")
        for i, member in enumerate(members_of(folded.filter(F.col("fold") != fold), prepared.get(fold, prepared[None]))):
            scored = member.score(scored, f"_p{i}")
        found = scored.select(F.col(LABEL).cast("double").alias(TARGET), *[f"_p{i}" for i in range(len(names))]).persist()
        found.count()  # scored here, side by side, instead of as one plan of all folds
        return found

    with ThreadPoolExecutor(fits) as pool:
        whole = pool.submit(members_of, folded, prepared[None])
        parts = list(pool.map(held_out_scores, range(folds)))
        members = whole.result()
    dealt = folded.rdd.getNumPartitions()
    folded.unpersist()
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    # The union has as many partitions as all folds together, for rows of two or three numbers and up to 100 passes.
    weighted = resample.with_class_weights(stacked.coalesce(dealt), TARGET)
    vector = VectorAssembler(inputCols=[f"_p{i}" for i in range(len(names))], outputCol=FEATURES).transform(weighted)
    final = LogisticRegression(featuresCol=FEATURES, labelCol=TARGET, weightCol="weight").fit(vector)
    for part in parts:
        part.unpersist()
    return Stacking(members, final)


# ---- comparison ------------------------------------------------------------------------------------------------------

#: What takes longest begins first, so that short fits and assessments fill the slots beside it: by the passes of a fit, and by the search.
LONG_FITS = ("mlp", "svm", "random_forest", "adaboost")
LONG_SCORES = ("knn", "random_forest")


def _longest_first(names: list[str], known: tuple[str, ...]) -> list[str]:
    return sorted(names, key=lambda name: known.index(name) if name in known else len(known))


def train_models(
    df: DataFrame,
    names: list[str],
    overrides: dict[str, dict] | None = None,
    sampler: str = "weights",
    row_id: str = "event_id",
    seed: int = 42,
    fitted: PreprocessorModel | None = None,
) -> dict[str, Trained]:
    """The models on shared preprocessing; those of small tables are fitted side by side, the boosted trees in step."""
    size = df.count()
    rows = spread(df, row_id, size).persist()
    shared = fitted or Preprocessor().fit(rows)
    options = overrides or {}
    single = _longest_first([n for n in names if n not in BOOSTED], LONG_FITS)
    units = [u for u in ([n for n in names if n in BOOSTED], *[[n] for n in single]) if u]
    fits = min(len(units), side_by_side(df.sparkSession, size))

    def fit(unit: list[str]) -> list[Trained]:
        if unit[0] in BOOSTED:
            return train_boosted(rows, [(name, options.get(name)) for name in unit], sampler, shared, row_id, seed, fits)
        return [train(rows, unit[0], sampler, options.get(unit[0]), shared, row_id, seed, fits)]

    with ThreadPoolExecutor(fits) as pool:
        found = {trained.name: trained for several in pool.map(fit, units) for trained in several}
    rows.unpersist()
    return {name: found[name] for name in names}


def compare_models(
    train_rows: DataFrame,
    test_rows: DataFrame,
    names: list[str],
    overrides: dict[str, dict] | None = None,
    sampler: str = "weights",
    row_id: str = "event_id",
    seed: int = 42,
    trained: dict[str, Trained] | None = None,
) -> tuple[DataFrame, dict[str, Trained]]:
    """(leaderboard, trained models): each model is fitted once on shared preprocessing and scored on the test rows.

    Models in ``trained`` are compared as they are.
    """
    models = dict(trained or {})
    missing = [n for n in names if n not in models]
    if missing:
        models |= train_models(train_rows, missing, overrides, sampler, row_id, seed)
    with ThreadPoolExecutor(side_by_side(test_rows.sparkSession, test_rows.count())) as pool:
        order = _longest_first(names, LONG_SCORES)
        bundles = dict(zip(order, pool.map(lambda name: assess(models[name], test_rows), order)))
    rows = [(name, *[float(bundles[name][m]) for m in BASIC_METRICS], models[name].seconds) for name in names]
    schema = "model string, " + ", ".join(f"{m} double" for m in BASIC_METRICS) + ", seconds double"
    return leaderboard(train_rows.sparkSession.createDataFrame(rows, schema)), models


def leaderboard(results: DataFrame, by: str = "pr_auc") -> DataFrame:
    """Rank of every model; one row per model, so one small window."""
    return results.withColumn("place", F.rank().over(Window.orderBy(F.desc(by))))


def best_models(board: DataFrame) -> DataFrame:
    """One row: the best model by recall, PR area and F1, and the fastest one."""
    return board.agg(
        F.max_by("model", "recall").alias("best_recall"),
        F.max_by("model", "pr_auc").alias("best_pr_auc"),
        F.max_by("model", "f1").alias("best_f1"),
        F.min_by("model", "seconds").alias("fastest"),
    )
