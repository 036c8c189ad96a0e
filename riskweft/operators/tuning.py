"""Hyper-parameter search with cross-validation. Every fit and every score is a Spark job; rebalancing stays inside a fold."""

from __future__ import annotations

import itertools
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.operators.metrics import ranking_areas, score_runs
from riskweft.operators.models import BOOSTED, first_trees, parameters
from riskweft.operators.preprocess import Preprocessor, PreprocessorModel
from riskweft.operators.splits import stratified_folds, time_blocks
from riskweft.operators.training import side_by_side, spread, train, train_boosted

# Search ranges per model: (kind, low, high); "log" draws uniformly on the logarithm.
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "xgboost": {
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.01, 0.3),
        "n_estimators": ("int", 50, 300),
        "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0),
        "min_child_weight": ("int", 1, 10),
        "scale_pos_weight": ("float", 50, 200),
    },
    "lightgbm": {
        "num_leaves": ("int", 10, 50),
        "learning_rate": ("log", 0.01, 0.3),
        "n_estimators": ("int", 50, 300),
        "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0),
        "min_child_samples": ("int", 10, 50),
        "scale_pos_weight": ("float", 50, 200),
    },
}

# Grids per model.
GRIDS: dict[str, dict[str, list]] = {
    "logistic": {"C": [0.1, 1.0, 10.0, 100.0], "l1_ratio": [1.0, 0.0]},
    "decision_tree": {"max_depth": [5, 10, 15, 30], "min_samples_leaf": [1, 2, 4], "criterion": ["gini", "entropy"]},
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [10, 20, 30], "min_samples_leaf": [1, 2]},
    "gradient_boosting": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [3, 5, 7]},
    "xgboost": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [3, 5, 7], "subsample": [0.8, 0.9, 1.0]},
    "lightgbm": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2], "num_leaves": [31, 50, 100], "subsample": [0.8, 0.9, 1.0]},
    "mlp": {"hidden_layer_sizes": [(50,), (100,), (100, 50)], "max_iter": [200]},
}
SCORINGS = ("roc_auc", "pr_auc")


def draw(space: dict[str, tuple], trials: int, seed: int = 42) -> list[dict]:
    """Random candidates of a search space; one empty candidate when the space is empty."""
    if not space:
        return [{}]
    rng = random.Random(seed)
    candidates = []
    for _ in range(trials):
        one = {}
        for name, (kind, low, high) in space.items():
            if kind == "int":
                one[name] = rng.randint(low, high)
            elif kind == "log":
                one[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                one[name] = rng.uniform(low, high)
        candidates.append(one)
    return candidates


def grid(name: str) -> list[dict]:
    options = GRIDS.get(name, {})
    return [dict(zip(options, values)) for values in itertools.product(*options.values())]


def sample_grid(name: str, trials: int, seed: int = 42) -> list[dict]:
    everything = grid(name)
    return everything if len(everything) <= trials else random.Random(seed).sample(everything, trials)


def _without_fold() -> Preprocessor:
    return Preprocessor(excludedCols=[*Preprocessor().getOrDefault("excludedCols"), "fold"])


def cross_validate(
    df: DataFrame,
    name: str,
    overrides: dict | None = None,
    folds: int = 5,
    scoring: str = "roc_auc",
    sampler: str = "weights",
    preprocessor: Preprocessor | None = None,
    row_id: str = "event_id",
    seed: int = 42,
    prepared: list[PreprocessorModel] | None = None,
) -> list[float]:
    """Score of each held-out fold; preprocessing and rebalancing are fitted on the other folds.

    ``prepared`` holds the preprocessing of each fold where it is fitted already.
    """
    if scoring not in SCORINGS:
        raise ValueError(f"unknown scoring {scoring!r}, choose one of {SCORINGS}")
    folded = df if "fold" in df.columns else stratified_folds(df, folds, row_id=row_id, seed=seed)
    rows = folded.count()
    folded = spread(folded, row_id, rows).persist()
    fits = min(folds, side_by_side(df.sparkSession, rows))

    def score(fold: int) -> float:
        own = prepared[fold] if prepared else preprocessor or _without_fold()
        if not isinstance(own, PreprocessorModel):
            own = own.fit(folded.filter(F.col("fold") != fold))
        return fold_score(folded, fold, name, overrides, scoring, sampler, own, row_id, seed, fits)

    try:
        with ThreadPoolExecutor(fits) as pool:
            return list(pool.map(score, range(folds)))
    finally:
        folded.unpersist()


def fold_score(
    folded: DataFrame, fold: int, name: str, overrides: dict | None, scoring: str, sampler: str, prepared: Preprocessor | PreprocessorModel, row_id: str, seed: int, fits: int = 1
) -> float:
    """Score of one held-out fold."""
    return family_scores(folded, fold, name, [overrides or {}], scoring, sampler, prepared, row_id, seed, fits)[0]


def families(name: str, candidates: list[dict]) -> list[list[int]]:
    """Places of the candidates that one fit answers: boosted trees that differ in their number of rounds alone."""
    found: dict[str, list[int]] = {}
    for i, candidate in enumerate(candidates):
        rest = {k: v for k, v in parameters(name, candidate).items() if k != "n_estimators"}
        found.setdefault(str(sorted(rest.items())) if name in BOOSTED else str(i), []).append(i)
    return list(found.values())


def family_scores(
    folded: DataFrame, fold: int, name: str, family: list[dict], scoring: str, sampler: str, prepared: Preprocessor | PreprocessorModel, row_id: str, seed: int, fits: int = 1
) -> list[float]:
    """Scores of a held-out fold for candidates of one family: the largest is fitted, the others are its first rounds."""
    return several_families(folded, fold, name, [family], scoring, sampler, prepared, row_id, seed, fits)[0]


def several_families(
    folded: DataFrame, fold: int, name: str, families: list[list[dict]], scoring: str, sampler: str, prepared: Preprocessor | PreprocessorModel, row_id: str, seed: int, fits: int = 1
) -> list[list[float]]:
    """Scores of a held-out fold by family; those of boosted trees are fitted in step."""
    held_out, kept = folded.filter(F.col("fold") == fold).drop("score"), folded.filter(F.col("fold") != fold)
    rounds = [[parameters(name, candidate).get("n_estimators") for candidate in family] for family in families]
    largest = [family[max(range(len(family)), key=lambda i: r[i] or 0)] for family, r in zip(families, rounds)]
    if name in BOOSTED and isinstance(prepared, PreprocessorModel):
        fitted = train_boosted(kept, [(name, one) for one in largest], sampler, prepared, row_id, seed, fits)
    else:
        fitted = [train(kept, name, sampler, one, prepared, row_id, seed, fits) for one in largest]
    found = []
    for model, family, r in zip(fitted, families, rounds):
        members = [model] if len(family) == 1 else [replace(model, model=first_trees(model.model, n)) for n in r]
        found.append([ranking_areas(score_runs(m.score(held_out))).first()[scoring] for m in members])
    return found


def cross_validate_over_time(
    df: DataFrame,
    name: str,
    overrides: dict | None = None,
    folds: int = 5,
    scoring: str = "roc_auc",
    sampler: str = "weights",
    order: str = "step",
    row_id: str = "event_id",
    seed: int = 42,
) -> list[float | None]:
    """Score of each block of time, by a model fitted on all that lies before it; None where the block has one class alone."""
    if scoring not in SCORINGS:
        raise ValueError(f"unknown scoring {scoring!r}, choose one of {SCORINGS}")
    blocks = time_blocks(df, folds, order, row_id).persist()
    try:
        scores: list[float | None] = []
        for fold in range(1, folds + 1):
            before, block = blocks.filter(F.col("block") < fold).drop("block"), blocks.filter(F.col("block") == fold).drop("block", "score")
            fitted = train(before, name, sampler, overrides, None, row_id, seed)
            scores.append(ranking_areas(score_runs(fitted.score(block))).first()[scoring])
        return scores
    finally:
        blocks.unpersist()


def search(
    df: DataFrame,
    name: str,
    candidates: list[dict],
    folds: int = 5,
    scoring: str = "roc_auc",
    sampler: str = "weights",
    parallelism: int | None = None,
    row_id: str = "event_id",
    seed: int = 42,
) -> tuple[dict, DataFrame]:
    """(best candidate, table of candidates with their mean score).

    The folds are kept and preprocessed once; candidates differ in the classifier alone, and one fit answers all candidates of a
    family. Every family on a fold is one unit, largest first (all families of boosted trees, which grow in step), and ``parallelism`` units (by default as ``side_by_side`` says, as each fit keeps its training rows) run side by side.
    """
    if scoring not in SCORINGS:
        raise ValueError(f"unknown scoring {scoring!r}, choose one of {SCORINGS}")
    folded = stratified_folds(df, folds, row_id=row_id, seed=seed)
    rows = folded.count()
    folded = spread(folded, row_id, rows).persist()
    fits = parallelism or side_by_side(df.sparkSession, rows)
    try:
        with ThreadPoolExecutor(min(folds, fits)) as pool:
            prepared = list(pool.map(lambda fold: _without_fold().fit(folded.filter(F.col("fold") != fold)), range(folds)))

        def score(unit: tuple[list[list[int]], int]) -> list[list[float]]:
            groups, fold = unit
            chosen = [[candidates[i] for i in members] for members in groups]
            return several_families(folded, fold, name, chosen, scoring, sampler, prepared[fold], row_id, seed, min(fits, len(units)))

        def cost(members: list[int]) -> float:
            p = parameters(name, candidates[members[0]])
            return max(parameters(name, candidates[i]).get("n_estimators", 1) for i in members) * (p.get("max_depth") or 5)

        groups = sorted(families(name, candidates), key=cost, reverse=True)
        units = [(part, fold) for part in ([groups] if name in BOOSTED else [[g] for g in groups]) for fold in range(folds)]
        values: dict[tuple[int, int], float] = {}
        with ThreadPoolExecutor(fits) as pool:
            for (part, fold), scores in zip(units, pool.map(score, units)):
                values |= {(i, fold): value for members, found in zip(part, scores) for i, value in zip(members, found)}
        means = [sum(values[i, fold] for fold in range(folds)) / folds for i in range(len(candidates))]
    finally:
        folded.unpersist()
    best = max(range(len(candidates)), key=lambda i: means[i])
    rows = [(i, name, str(sorted(c.items())), float(m), int(i == best)) for i, (c, m) in enumerate(zip(candidates, means))]
    table = df.sparkSession.createDataFrame(rows, "trial int, model string, parameters string, mean_score double, is_best int")
    return candidates[best], table


def tune(df: DataFrame, name: str, trials: int = 20, folds: int = 5, **kw) -> tuple[dict, DataFrame]:
    """Random search over the model's continuous space, by ROC area."""
    return search(df, name, draw(SEARCH_SPACES.get(name, {}), trials), folds, "roc_auc", **kw)


def randomised_search(df: DataFrame, name: str, trials: int = 20, folds: int = 3, **kw) -> tuple[dict, DataFrame]:
    """Random draws from the model's grid, by average precision."""
    return search(df, name, sample_grid(name, trials) or [{}], folds, "pr_auc", **kw)
