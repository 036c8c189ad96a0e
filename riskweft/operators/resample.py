"""Class rebalancing: synthetic and random oversampling, and class weights. Numbers of rows are exact.

Rows without label are no class: they are kept, with weight 1, and neither counted nor copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import order_key, unit_interval
from riskweft.operators.knn import as_points, knn_join, written
from riskweft.operators.order_stats import prefix_cutoffs
from riskweft.operators.splits import KEY, class_sizes
from riskweft.schema import LABEL

NEIGHBOURS = 5
# Copies of one source row made by a single task at most.
COPIES_PER_TASK = 100_000


def _labelled_sizes(df: DataFrame, label: str) -> list[tuple[object, int]]:
    return [(value, rows) for value, _, rows in class_sizes(df.select(label), label) if value is not None]


def majority_minority(df: DataFrame, label: str = LABEL) -> tuple[tuple, tuple]:
    """((value, rows) of the largest class, (value, rows) of the smallest)."""
    sizes = sorted(((rows, value) for value, rows in _labelled_sizes(df, label)), reverse=True)
    if not sizes:
        raise ValueError(f"no row has a {label}")
    return (sizes[0][1], sizes[0][0]), (sizes[-1][1], sizes[-1][0])


def _spread_copies(df: DataFrame, total: int, rows: int, seed: int, row_id: str) -> DataFrame:
    """Each row ``copy`` = 1..n times with the n adding up to ``total``: an even share, the remainder by hash order.

    A row with very many copies is first cut into ranges that are spread over tasks.
    """
    share, rest = divmod(total, rows)
    hashed = df.withColumn(KEY, order_key(seed, row_id))
    extra: Column = F.lit(0)
    if rest:
        cutoff = prefix_cutoffs(hashed.select(KEY, row_id), KEY, row_id, [(F.lit(True), rows, rest)])[0]
        extra = F.when(cutoff.covers(KEY, row_id), 1).otherwise(0)
    counted = hashed.withColumn("_n", (F.lit(share) + extra).cast("bigint")).drop(KEY).filter("_n > 0")
    if share >= COPIES_PER_TASK:
        ranges = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.lit(float(COPIES_PER_TASK))))
        counted = counted.withColumn("_range", F.explode(ranges)).repartition(row_id, "_range")
        first = F.col("_range") * COPIES_PER_TASK + 1
        last = F.least(first + (COPIES_PER_TASK - 1), F.col("_n"))
        return counted.withColumn("copy", F.explode(F.sequence(first, last))).drop("_n", "_range")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n")


def synthetic_minority(
    df: DataFrame,
    columns: list[str],
    label: str = LABEL,
    row_id: str = "event_id",
    k: int = NEIGHBOURS,
    seed: int = 42,
    sizes: tuple[tuple, tuple] | None = None,
) -> DataFrame:
    """(row_id, copy, label, columns): new = x + u (neighbour - x) until the smallest class equals the largest.

    The neighbour is one of the k nearest rows of the class and u lies in [0, 1); both come from a hash of
    (row, copy, seed), so the rows are the same on any cluster. Rows with a null or non-finite coordinate are no source and
    no neighbour; the others make up for them. At most k class rows that can be one is an error. ``sizes`` is the result of
    ``majority_minority`` when it is known already.
    """
    (_, most), (value, least) = sizes or majority_minority(df, label)
    members = df.filter(F.col(label) == F.lit(value)).select(row_id, *[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        members = members.filter(F.abs(c) < float("inf"))
    # The planner derives two variants of a condition for every derived column in it, so a condition on all coordinates at once, as in
    # the neighbour search, has to see plain columns of a table.
    members = written(members, "minority")
    whole = members.count()
    if whole <= k:
        raise ValueError(f"the smallest class has {whole} rows with finite coordinates, more than {k} are needed")
    points = as_points(members, row_id, columns)
    near = knn_join(points, points, k, exclude_self=True).select(F.col("id").alias(row_id), F.col("neighbour").alias("_nid"), "place")
    ends = members.select(F.col(row_id).alias("_nid"), *[F.col(c).alias(f"_to_{c}") for c in columns])
    paired = near.join(ends, "_nid").drop("_nid")
    copies = _spread_copies(members, most - least, whole, seed, row_id)
    copies = copies.withColumn("place", (F.pmod(order_key(seed + 1, row_id, "copy"), F.lit(k)) + 1).cast("int"))
    copies = copies.withColumn("_u", unit_interval(order_key(seed + 2, row_id, "copy")))
    made = copies.join(paired, [row_id, "place"])
    moved = [(F.col(c) + F.col("_u") * (F.col(f"_to_{c}") - F.col(c))).alias(c) for c in columns]
    return made.select(row_id, "copy", F.lit(value).alias(label), *moved)


def smote(
    df: DataFrame,
    columns: list[str],
    label: str = LABEL,
    row_id: str = "event_id",
    k: int = NEIGHBOURS,
    seed: int = 42,
    sizes: tuple[tuple, tuple] | None = None,
) -> DataFrame:
    """Original rows (copy 0) and the synthetic ones."""
    original = df.select(row_id, F.lit(0).cast("bigint").alias("copy"), label, *[F.col(c).cast("double").alias(c) for c in columns])
    return original.unionByName(synthetic_minority(df, columns, label, row_id, k, seed, sizes))


def rebalance(df: DataFrame, columns: list[str], label: str = LABEL, row_id: str = "event_id", k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Synthetic oversampling with ``weight`` 1, or balanced class weights when the smallest class is too small."""
    sizes = majority_minority(df, label)
    finite = df.filter(F.col(label) == F.lit(sizes[1][0]))
    for c in columns:
        finite = finite.filter(F.abs(F.col(c).cast("double")) < float("inf"))
    if sizes[1][1] > k and finite.limit(k + 1).count() > k:
        return smote(df, columns, label, row_id, k, seed, sizes).withColumn("weight", F.lit(1.0))
    plain = df.select(row_id, F.lit(0).cast("bigint").alias("copy"), label, *[F.col(c).cast("double").alias(c) for c in columns])
    return with_class_weights(plain, label)


def random_oversample(df: DataFrame, label: str = LABEL, row_id: str = "event_id", seed: int = 42) -> DataFrame:
    """All rows with ``copy`` 0, and repeated rows of the smallest class until it equals the largest."""
    (_, most), (value, least) = majority_minority(df, label)
    extra = _spread_copies(df.filter(F.col(label) == F.lit(value)), most - least, least, seed, row_id)
    return df.withColumn("copy", F.lit(0).cast("bigint")).unionByName(extra)


def class_weights(df: DataFrame, label: str = LABEL) -> dict[object, float]:
    """Balanced weights n / (classes x rows of the class)."""
    sizes = _labelled_sizes(df, label)
    total = sum(rows for _, rows in sizes)
    return {value: total / (len(sizes) * rows) for value, rows in sizes}


def _weighted(df: DataFrame, weights: dict[object, float], label: str, output: str) -> DataFrame:
    weight = F.lit(1.0)
    for value, w in weights.items():
        weight = F.when(F.col(label) == F.lit(value), F.lit(w)).otherwise(weight)
    return df.withColumn(output, weight)


def with_class_weights(df: DataFrame, label: str = LABEL, output: str = "weight") -> DataFrame:
    return _weighted(df, class_weights(df, label), label, output)


def class_ratio(df: DataFrame, label: str = LABEL) -> float:
    """Negatives / positives."""
    sizes = dict(_labelled_sizes(df, label))
    return sizes.get(0, 0) / sizes[1]


def with_positive_weight(df: DataFrame, weight: float | None = None, label: str = LABEL, output: str = "weight") -> DataFrame:
    """Weight of the positive class: the given number, or negatives / positives. Negatives weigh 1."""
    if weight is None:
        weight = class_ratio(df, label)
    return _weighted(df, {1: float(weight)}, label, output)
