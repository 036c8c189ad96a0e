"""Model explanation: importances, linear contributions and sampled Shapley values."""

from __future__ import annotations

import random

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweft.functions.exprs import order_key
from riskweft.operators.models import FEATURES, positive_probability
from riskweft.operators.splits import random_sample
from riskweft.operators.training import Trained

SAMPLE_ROWS = 1000


def feature_importances(trained: Trained, spark, top: int = 20) -> DataFrame:
    """(feature, importance, place): impurity importances, or absolute coefficients of a linear model."""
    model, names = trained.model, trained.preprocessor.feature_names()
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        values = abs(model.coefficients.toArray())
    else:
        raise ValueError(f"{type(model).__name__} has no importances")
    ranked = sorted(zip(names, map(float, values)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(ranked)], "feature string, importance double, place int")


def linear_contributions(trained: Trained, df: DataFrame, row_id: str = "event_id") -> DataFrame:
    """(row id, feature, contribution) = coefficient x (value - mean): the exact Shapley values of a linear margin."""
    names = trained.preprocessor.feature_names()
    coefficients = trained.model.coefficients.toArray()
    wide = trained.preprocessor.to_frame(df, [row_id])
    means = wide.agg(*[F.avg(f"`{n}`").alias(n) for n in names]).first()
    parts = [(F.lit(float(c)) * (F.col(f"`{n}`") - F.lit(float(means[n])))).alias(n) for n, c in zip(names, coefficients)]
    return wide.select(row_id, *parts).unpivot([row_id], [F.col(f"`{n}`") for n in names], "feature", "contribution")


def shapley_values(
    trained: Trained, df: DataFrame, sample_rows: int = SAMPLE_ROWS, permutations: int = 4, row_id: str = "event_id", seed: int = 42
) -> DataFrame:
    """(row id, feature, value): mean marginal contribution over random feature orders (Strumbelj and Kononenko, 2014).

    Explained rows are a sample, as in the feature it replaces. Each is paired with one other sampled row per
    permutation by an equi-join on its position in a hash order. Features are switched one after another from the
    partner's value to the row's own, and the model scores every step in one pass.
    """
    names = trained.preprocessor.feature_names()
    width = len(names)
    sample = random_sample(df, sample_rows, seed, row_id)
    vectors = trained.preprocessor.transform(sample).select(F.col(row_id).alias("_id"), vector_to_array(FEATURES).alias("_x")).persist()
    size = vectors.count()
    # At most sample_rows rows.
    ordered = vectors.withColumn("_i", F.row_number().over(Window.orderBy(order_key(seed, "_id"), "_id")) - 1)
    rng = random.Random(seed)
    orders = [rng.sample(range(width), width) for _ in range(permutations)]
    shifts = [rng.randrange(1, max(size, 2)) for _ in range(permutations)]
    # rank of each feature in every order: a feature is "own" once its rank is below the step number
    ranks = [[order.index(f) for f in range(width)] for order in orders]
    plans = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(shifts[p]).alias("shift"), F.array(*[F.lit(r) for r in ranks[p]]).alias("rank")) for p in range(permutations)])
    own = ordered.select("_id", "_x", "_i", F.inline(plans)).withColumn("_j", F.pmod(F.col("_i") + F.col("shift"), F.lit(size)))
    partner = ordered.select(F.col("_i").alias("_j"), F.col("_x").alias("_b"))
    steps = own.join(F.broadcast(partner), "_j").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(width))))
    mixed = F.transform(F.arrays_zip("_x", "_b", "rank"), lambda z: F.when(z["rank"] < F.col("step"), z["_x"]).otherwise(z["_b"]))
    scored = trained.model.transform(steps.withColumn(FEATURES, array_to_vector(mixed))).select("_id", "p", "step", positive_probability().alias("_p"))
    before = scored.select("_id", "p", (F.col("step") + 1).alias("step"), F.col("_p").alias("_q"))
    gains = scored.join(before, ["_id", "p", "step"]).withColumn("gain", F.col("_p") - F.col("_q"))
    features = F.array(*[F.array(*[F.lit(names[f]) for f in order]) for order in orders])
    named = gains.withColumn("feature", F.element_at(F.element_at(features, F.col("p") + 1), F.col("step").cast("int")))
    return named.groupBy(F.col("_id").alias(row_id), "feature").agg(F.avg("gain").alias("value"))


def shapley_summary(values: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, mean_abs_value), largest first."""
    summary = values.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_value")).orderBy(F.desc("mean_abs_value"), "feature")
    return summary.limit(top) if top else summary
