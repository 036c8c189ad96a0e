"""Splitting, sampling and folding by exact counts.

Every operator finds the few cutoff rows of an order (by clock, or by a seeded hash of the row) and then labels rows by
comparing with those literals. The data itself is neither sorted nor shuffled, whatever the class skew, and the result
depends on rows and seed only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import order_key
from riskweft.operators.order_stats import MAX_GROUPS, Cutoff, prefix_cutoffs
from riskweft.schema import LABEL

KEY = "_order_key"


def _covered(cutoff: Cutoff | None, key: str, tie: str) -> Column:
    return F.lit(False) if cutoff is None else cutoff.covers(key, tie)


def _hashed(df: DataFrame, seed: int, row_id: str) -> DataFrame:
    return df.withColumn(KEY, order_key(seed, row_id))


def _label_by_lengths(df: DataFrame, key: str, tie: str, names: list[str], lengths: list[int]) -> DataFrame:
    """``split``: the first ``lengths[0]`` rows get names[0], the next names[1], ..., the rest the last name."""
    total = df.count()
    ends, end = [], 0
    for length in lengths:
        end = min(end + max(length, 0), total)
        ends.append(end)
    cutoffs = prefix_cutoffs(df.select(key, tie), key, tie, [(F.lit(True), total, e) for e in ends], nulls=True)
    split = F.lit(names[-1])
    for name, cutoff in reversed(list(zip(names, cutoffs))):
        split = F.when(_covered(cutoff, key, tie), name).otherwise(split)
    return df.withColumn("split", split)


def temporal_split(df: DataFrame, train_size: int = 4_000_000, eval_size: int = 1_000_000, order: str = "step", tie: str = "event_id") -> DataFrame:
    """First ``train_size`` rows in clock order, next ``eval_size``, rest test; short tables are truncated.

    Rows without a clock come last, ordered by the tie-break.
    """
    return _label_by_lengths(df, order, tie, ["train", "eval", "test"], [train_size, eval_size])


def shuffled_split(df: DataFrame, train_size: int, eval_size: int, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """The same sizes in a seeded random order."""
    hashed = _hashed(df, seed, row_id)
    return _label_by_lengths(hashed, KEY, row_id, ["train", "eval", "test"], [train_size, eval_size]).drop(KEY)


def fractional_split(df: DataFrame, train: float = 0.6, evaluate: float = 0.2, order: str = "step", tie: str = "event_id") -> DataFrame:
    """Temporal split with sizes given as shares of the row count."""
    total = df.count()
    return temporal_split(df, int(total * train), int(total * evaluate), order, tie)


def split_parts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(df.filter(F.col("split") == name).drop("split") for name in ("train", "eval", "test"))


def class_sizes(df: DataFrame, label: str = LABEL) -> list[tuple[object, Column, int]]:
    """(value, condition, rows) per class, by value; one aggregation."""
    rows = df.groupBy(label).agg(F.count(F.lit(1))).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{label} has more than {MAX_GROUPS} values; splitting expects a class-like column")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    return [(value, F.col(label).eqNullSafe(F.lit(value)), n) for value, n in ordered]


def _per_class(df: DataFrame, label: str, seed: int, row_id: str, ends: callable) -> tuple[DataFrame, list[tuple[Column, list]]]:
    """Hashed frame, and per class its condition with the cutoffs of the prefix lengths ``ends(value, rows)``."""
    hashed = _hashed(df, seed, row_id)
    narrow = hashed.select(label, KEY, row_id)
    classes = class_sizes(narrow, label)
    wanted, owners = [], []
    for i, (value, cond, rows) in enumerate(classes):
        for length in ends(value, rows):
            wanted.append((cond, rows, length))
            owners.append(i)
    cutoffs = prefix_cutoffs(narrow, KEY, row_id, wanted)
    found = [(cond, []) for _, cond, _ in classes]
    for owner, cutoff in zip(owners, cutoffs):
        found[owner][1].append(cutoff)
    return hashed, found


def stratified_split(df: DataFrame, test_share: float = 0.2, label: str = LABEL, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """Test, validation and train parts with the class shares of the whole: ``test_share`` twice, the rest trains."""

    def ends(_, rows: int) -> list[int]:
        part = int(rows * test_share + 0.5)
        return [part, min(2 * part, rows)]

    hashed, found = _per_class(df, label, seed, row_id, ends)
    split = F.lit("train")
    for cond, (test, evaluate) in found:
        split = F.when(cond & _covered(test, KEY, row_id), "test").when(cond & _covered(evaluate, KEY, row_id), "eval").otherwise(split)
    return hashed.withColumn("split", split).drop(KEY)


def stratified_folds(df: DataFrame, folds: int = 5, label: str = LABEL, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """``fold`` 0..folds-1, every class spread evenly (sizes differ by at most one row per class)."""
    hashed, found = _per_class(df, label, seed, row_id, lambda _, rows: [rows * (j + 1) // folds for j in range(folds - 1)])
    fold = F.lit(folds - 1)
    for cond, cutoffs in found:
        for j, cutoff in reversed(list(enumerate(cutoffs))):
            fold = F.when(cond & _covered(cutoff, KEY, row_id), j).otherwise(fold)
    return hashed.withColumn("fold", fold).drop(KEY)


def time_blocks(df: DataFrame, folds: int = 5, order: str = "step", tie: str = "event_id") -> DataFrame:
    """``block`` 0..folds in clock order: blocks 1..folds hold rows // (folds + 1) rows each, block 0 the earlier rest.

    Rows without a clock come last, ordered by the tie-break. Fold f trains on the blocks before f and is tested on block f.
    """
    total = df.count()
    size = total // (folds + 1)
    ends = [total - size * (folds - j) for j in range(folds)]
    cutoffs = prefix_cutoffs(df.select(order, tie), order, tie, [(F.lit(True), total, end) for end in ends], nulls=True)
    block = F.lit(folds)
    for j, cutoff in reversed(list(enumerate(cutoffs))):
        block = F.when(_covered(cutoff, order, tie), j).otherwise(block)
    return df.withColumn("block", block)


def time_folds(df: DataFrame, folds: int = 5, order: str = "step", tie: str = "event_id", label: str = LABEL) -> DataFrame:
    """One row for each expanding window: sizes and positives of its two parts, and the clock borders between them."""
    per_block = (
        time_blocks(df, folds, order, tie)
        .groupBy("block")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"), F.min(order).alias("low"), F.max(order).alias("high"))
    )
    spread = per_block.withColumn("fold", F.explode(F.sequence(F.greatest("block", F.lit(1)), F.lit(folds))))
    earlier, tested = F.col("block") < F.col("fold"), F.col("block") == F.col("fold")

    def part(column: str, where: Column, function) -> Column:
        return function(F.when(where, F.col(column)))

    return (
        spread.groupBy("fold")
        .agg(
            part("n", earlier, F.sum).alias("train_rows"),
            part("p", earlier, F.sum).alias("train_positives"),
            part("high", earlier, F.max).alias("train_last"),
            F.coalesce(part("n", tested, F.sum), F.lit(0)).alias("test_rows"),
            part("p", tested, F.sum).alias("test_positives"),
            part("low", tested, F.min).alias("test_first"),
            part("high", tested, F.max).alias("test_last"),
        )
    )


def random_sample(df: DataFrame, size: int, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """Exactly ``size`` rows (all when there are fewer), uniformly by hash order."""
    hashed = _hashed(df, seed, row_id)
    total = hashed.count()
    if size >= total:
        return df
    cutoff = prefix_cutoffs(hashed.select(KEY, row_id), KEY, row_id, [(F.lit(True), total, size)])[0]
    return hashed.filter(_covered(cutoff, KEY, row_id)).drop(KEY)


def stratified_sample(df: DataFrame, size: int, label: str = LABEL, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """``size`` rows holding int(size x positive share) positives; the rest are negatives."""
    counts = {value: rows for value, _, rows in class_sizes(df.select(label), label)}
    total = sum(counts.values())
    positives = int(size * counts.get(1, 0) / total) if total else 0
    quota = {1: positives, 0: size - positives}
    hashed, found = _per_class(df, label, seed, row_id, lambda value, rows: [min(quota.get(value, 0), rows)])
    keep = F.lit(False)
    for cond, (cutoff,) in found:
        keep = keep | (cond & _covered(cutoff, KEY, row_id))
    return hashed.filter(keep).drop(KEY)


def slice_rows(df: DataFrame, order: str, tie: str, start: int, stop: int) -> DataFrame:
    """Rows at positions [start, stop) of the (order, tie) sequence, those without ``order`` last."""
    total = df.count()
    narrow = df.select(order, tie)
    first, last = prefix_cutoffs(narrow, order, tie, [(F.lit(True), total, start), (F.lit(True), total, stop)], nulls=True)
    return df.filter(_covered(last, order, tie) & ~_covered(first, order, tie))


def sort_rows(df: DataFrame, order: str = "step", tie: str = "event_id") -> DataFrame:
    """Global ascending order with a unique tie-break: range partitioning and a local sort."""
    return df.orderBy(order, tie)


def shuffle_rows(df: DataFrame, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """Seeded global shuffle, independent of the partitioning."""
    return _hashed(df, seed, row_id).orderBy(KEY, row_id).drop(KEY)


def random_union_sample(parts: list[DataFrame], size: int, seed: int = 42, row_id: str = "event_id") -> DataFrame:
    """Rows of all parts concatenated, then a uniform sample of the union."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return random_sample(union, size, seed, row_id)


def split_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(split, rows, positives)."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("positives"))
