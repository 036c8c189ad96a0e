"""Feature selection."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.operators.tests_of_difference import anova_f
from riskweft.operators.training import PART_ROWS

DEFAULT_FEATURES = 20


def ranked_features(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(feature, f_score, place): best score first; of equal scores the later column comes first."""
    order = {c: i for i, c in enumerate(columns)}
    scores = [(r["feature"], r["f_score"], order[r["feature"]]) for r in anova_f(df, columns, label).collect()]
    scores.sort(key=lambda r: (r[1] is not None, r[1] or 0.0, r[2]), reverse=True)
    rows = [(f, s, i + 1) for i, (f, s, _) in enumerate(scores)]
    return df.sparkSession.createDataFrame(rows, "feature string, f_score double, place int")


def select_k_best(df: DataFrame, columns: list[str], label: str, k: int = DEFAULT_FEATURES) -> list[str]:
    """The k columns with the largest F, in their original order."""
    chosen = {r["feature"] for r in ranked_features(df, columns, label).filter(F.col("place") <= k).collect()}
    return [c for c in columns if c in chosen]


def eliminate_features(
    df: DataFrame, columns: list[str], label: str, k: int = DEFAULT_FEATURES, step: int = 1, trees: int = 50, depth: int = 10, seed: int = 42
) -> tuple[list[str], list[tuple[str, int]]]:
    """(kept columns, (column, round dropped) pairs): a forest is refitted after every dropped step."""
    kept = list(columns)
    dropped: list[tuple[str, int]] = []
    own = df.select(*columns, label)
    # The input may have few partitions, and every round passes over all rows many times.
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / PART_ROWS))
    # A forest keeps its own copy of the rows with a counter for each tree, so memory is left to it; a round reads these rows three times.
    own = own.repartition(parts).persist(StorageLevel.DISK_ONLY)
    typed = own.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias(label))
    round_number = 0
    while len(kept) > k:
        round_number += 1
        frame = VectorAssembler(inputCols=kept, outputCol="_x").transform(typed)
        forest = RandomForestClassifier(featuresCol="_x", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(frame)
        weakest = sorted(range(len(kept)), key=lambda i: (forest.featureImportances[i], i))[: min(step, len(kept) - k)]
        dropped += [(kept[i], round_number) for i in weakest]
        kept = [c for i, c in enumerate(kept) if i not in weakest]
    own.unpersist()
    return kept, dropped


@dataclass
class FeatureSelector:
    """``fit`` picks columns by "select_k_best" or "rfe"; any other method keeps all of them with a warning."""

    method: str = "rfe"
    n_features: int = DEFAULT_FEATURES
    step: int = 1
    trees: int = 50
    depth: int = 10
    selected: list[str] | None = None

    def fit(self, df: DataFrame, columns: list[str], label: str) -> FeatureSelector:
        if self.method == "select_k_best":
            self.selected = select_k_best(df, columns, label, self.n_features)
        elif self.method == "rfe":
            self.selected = eliminate_features(df, columns, label, self.n_features, self.step, self.trees, self.depth)[0]
        else:
            warnings.warn(f"unknown selection method {self.method!r}, keeping all features", stacklevel=2)
            self.selected = list(columns)
        return self

    def transform(self, df: DataFrame, keep: list[str] = []) -> DataFrame:
        if self.selected is None:
            raise ValueError("fit the selector before transforming")
        return df.select(*keep, *[c for c in self.selected if c in df.columns])
