"""Target encoding: smoothed means of the label by category, out of fold in training so that no row sees its own label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.operators.lookup import HOT_SHARE, SPREAD
from riskweft.operators.splits import stratified_folds
from riskweft.schema import LABEL

#: Weight of the overall mean, in rows.
SMOOTHING = 20.0


def _smoothed(positives: Column, rows: Column, prior: Column, smoothing: float) -> Column:
    return (positives + F.lit(smoothing) * prior) / (rows + F.lit(smoothing))


def _look_up(df: DataFrame, key: str, table: DataFrame, total: int) -> DataFrame:
    """``df`` left joined with the struct ``_enc`` of its key.

    Keys with more than 1/HOT_SHARE of the rows, fewer than HOT_SHARE of them, are broadcast; rows of hot and NULL keys carry a
    salt in the shuffled join of the others, so they are spread.
    """
    hot = table.filter(F.col("_enc.n") * HOT_SHARE > total).select(F.col(key).alias("_hot_key"), F.col("_enc").alias("_hot"))
    cold = table.filter(F.col("_enc.n") * HOT_SHARE <= total).select(F.col(key).alias("_key"), F.col("_enc").alias("_cold"), F.lit(0).alias("_slot"))
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    idle = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    others = [c for c in df.columns if c != key] or [key]
    marked = marked.withColumn("_salt", F.when(idle, 1 + F.pmod(F.xxhash64(*others), F.lit(SPREAD)).cast("int")).otherwise(0))
    joined = marked.join(cold, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_slot")), "left")
    return joined.select(*df.columns, F.coalesce("_hot", "_cold").alias("_enc"))


@dataclass
class TargetEncoder:
    """Means learned from all training rows, for rows that were not trained on; unknown and NULL categories get the prior."""

    key: str
    table: DataFrame
    prior: float
    rows: int
    smoothing: float

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        value = _smoothed(F.col("_enc.p"), F.col("_enc.n"), F.lit(self.prior), self.smoothing)
        return _look_up(df, self.key, self.table, self.rows).select(*df.columns, F.coalesce(value, F.lit(self.prior)).alias(output))


def _counts(df: DataFrame, key: str, label: str, fold: str | None, folds: int) -> DataFrame:
    """(key, ``_enc``: rows n and positives p, and the same for each fold): sums by key, combined before the shuffle."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("p")]
    for j in range(folds if fold else 0):
        sums += [F.count(F.when(F.col(fold) == j, 1)).alias(f"n{j}"), F.sum(F.when(F.col(fold) == j, F.col(label).cast("double")).otherwise(0.0)).alias(f"p{j}")]
    grouped = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(*sums)
    extra = [F.array(*[f"n{j}" for j in range(folds)]).alias("own_n"), F.array(*[f"p{j}" for j in range(folds)]).alias("own_p")] if fold else []
    return grouped.select(key, F.struct("n", "p", *extra).alias("_enc"))


def fit_target_encoder(df: DataFrame, key: str, label: str = LABEL, smoothing: float = SMOOTHING) -> TargetEncoder:
    """Smoothed means of the label by ``key``. Rows without a label don't count; without any labelled row the prior is 0."""
    overall = df.agg(F.avg(F.col(label).cast("double")).alias("prior"), F.count(label).alias("n")).first()
    return TargetEncoder(key, _counts(df, key, label, None, 0), overall["prior"] or 0.0, overall["n"], smoothing)


def out_of_fold_means(
    df: DataFrame, key: str, output: str, label: str = LABEL, folds: int = 5, smoothing: float = SMOOTHING, row_id: str = "event_id", seed: int = 42
) -> DataFrame:
    """``output``: smoothed mean of the label over the rows of the same category in the other folds of a stratified folding.

    NULL categories, and those that occur in the row's own fold alone, get the other folds' overall mean. A table with a
    single labelled fold gets 0. Columns of the input stay as they are.
    """
    folded = df if "fold" in df.columns else stratified_folds(df, folds, label, seed, row_id)
    per_fold = {r["fold"]: (r["n"], r["p"]) for r in folded.groupBy("fold").agg(F.count(label).alias("n"), F.sum(F.col(label).cast("double")).alias("p")).collect()}
    rows, positives = sum(n for n, _ in per_fold.values()), sum(p or 0.0 for _, p in per_fold.values())
    prior: Column = F.lit(0.0)
    for j, (n, p) in per_fold.items():
        if rows > n:
            prior = F.when(F.col("fold") == j, F.lit((positives - (p or 0.0)) / (rows - n))).otherwise(prior)
    looked = _look_up(folded, key, _counts(folded, key, label, "fold", folds), rows)
    own_n, own_p = F.get("_enc.own_n", F.col("fold")), F.get("_enc.own_p", F.col("fold"))
    value = _smoothed(F.col("_enc.p") - own_p, F.col("_enc.n") - own_n, prior, smoothing)
    return looked.select(*df.columns, F.coalesce(value, prior).alias(output))
