"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label; a negative of another label serves a positive if its score lies between
a share of the positive's score and the score itself. The windows of one anchor overlap, so they are not searched one by one:

1. Rows are scored against blocks of anchors by exact integer products. Tasks keep each anchor's best rows of its label, a window
   over the anchors picks the positives.
2. The positives' scores, the upper limits of the windows, cut the scores into disjoint slots: slot j reaches from the limit of
   positive j down to that of positive j + 1, which isn't in it. Scores under the lower limit of the slot's own window serve no
   window and are left out. Tasks keep the best rows of every slot and anchor, the groups of all tasks are combined alike.
3. Slots are merged from the last to the first: what window j may choose from are the best of slot j followed by those of window
   j + 1. Each window then drops what lies below its own lower limit.

Anchors are sent to the tasks in blocks of ``BLOCK_ANCHORS`` rows, one pass over the rows for each block, so memory is bounded by
the block on driver and executors; the results of each block are written. Between tasks only ``per_positive`` rows for each slot
and anchor are shuffled, whatever the number of rows and however many share one vector.

Nulls, ties and odd rows: rows with a null id, label or vector, or with a null, NaN or infinite component take no part. Rows that share an
id are rows of their own: each may be a positive of another one, and each anchor among them has results of its own. Equal scores
are ordered by id. Only vectors of the same length have a score; empty vectors score 0 with each other. Scores beyond 64 bits are the
largest (or smallest) 64-bit number. An empty table gives no rows. Only id, vector and label are read, so other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import tidy, written
from riskweft.session import scratch_path

POSITIVES, NEGATIVES = 5, 5
#: A negative has at least this share (numerator, denominator) of the positive's score.
SHARE = (80, 100)
#: Components become whole numbers after this factor.
SCALE = 256
#: Anchors of one pass, and rows and anchors of one product.
BLOCK_ANCHORS, TILE_ROWS, TILE_ANCHORS = 16_384, 2048, 1024
#: Candidates that a task holds before it thins them out.
HELD = 1_000_000

_LEAST, _MOST = -(2**63), 2**63 - 1


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector (doubles) of the rows that take part."""
    df = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.dropna(subset=["vec_id", "label", "vector"]).filter(~odd)


def whole(vectors: np.ndarray) -> np.ndarray:
    """Floors of the scaled components: doubles where all products and sums are exact, else Python's integers."""
    floors = np.floor(SCALE * vectors)
    if not floors.size or float(np.abs(floors).max()) ** 2 * floors.shape[1] < 2.0**53:
        return floors
    return np.array([[int(x) if math.isfinite(x) else int(y) * SCALE for x, y in zip(a, b)] for a, b in zip(floors, vectors)], object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b as 64-bit integers."""
    bound = [max((abs(x) for x in m.ravel().tolist()), default=0) for m in (a, b)] if object in (a.dtype, b.dtype) else None
    if bound is None:
        top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        if top < 2.0**53:
            return (a @ b.T).astype(np.int64)
        a, b = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    a, b = (m if m.dtype == object else np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    out = [[min(max(sum(x * y for x, y in zip(p, q)), _LEAST), _MOST) for q in b] for p in a]
    return np.array(out, np.int64).reshape(len(a), len(b))


def lower_limit(score: int, share: tuple[int, int] = SHARE) -> int:
    """The smallest score that has the share of a score."""
    return -((-share[0] * score) // share[1])


class Anchors:
    """A block of anchors, by vector length: keys, labels, vectors, and the limits of their windows where they are known."""

    def __init__(self, rows: list, share: tuple[int, int] = SHARE):
        self.by_size: dict[int, tuple] = {}
        rows = sorted(rows, key=lambda r: (len(r["vector"]), r["anchor"]))
        for size in sorted({len(r["vector"]) for r in rows}):
            own = [r for r in rows if len(r["vector"]) == size]
            keys, labels = np.array([r["anchor"] for r in own]), np.array([r["label"] for r in own])
            vectors = whole(np.array([r["vector"] for r in own], np.float64).reshape(len(own), size))
            uppers = lowers = None
            if "uppers" in own[0]:
                # Descending limits; a window that is absent or below zero holds nothing.
                most = max(len(r["uppers"]) for r in own)
                limits = [[u for u in r["uppers"] if u >= 0] for r in own]
                uppers = np.array([u + [-1] * (most - len(u)) for u in limits], np.int64).reshape(len(own), most)
                lowers = np.array([[lower_limit(x, share) for x in u] + [0] * (most - len(u)) for u in limits], np.int64).reshape(len(own), most)
            self.by_size[size] = keys, labels, vectors, uppers, lowers


def thinned(columns: list[np.ndarray], keep: int) -> list[np.ndarray]:
    """The first ``keep`` of each (anchor, slot): higher scores first, ties by smaller id. Columns: anchor, slot, score, id."""
    anchor, slot, score, name = columns
    order = np.lexsort((name, -1 - score, slot, anchor))  # -1 - x turns the order around for every 64-bit number
    anchor, slot = anchor[order], slot[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    first = np.flatnonzero(fresh)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[rank < keep]
    return [c[order] for c in columns]


def _search(shared, keep: int, negatives: bool):
    """The best rows of each anchor: of its label in one slot, or of other labels in the slots of its windows."""

    def found(block: tuple, lo: int, scores: np.ndarray, names: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        keys, own, _, uppers, lowers = block
        keys, own = keys[lo : lo + scores.shape[1]], own[lo : lo + scores.shape[1]]
        same = labels[:, None] == own[None, :]
        if not negatives:
            row, col = np.nonzero(same)
            slot = np.zeros(len(row), np.int64)
            return [keys[col], slot, scores[row, col], names[row]]
        uppers, lowers = uppers[lo : lo + scores.shape[1]], lowers[lo : lo + scores.shape[1]]
        least = np.where(uppers >= 0, lowers, _MOST).min(axis=1, initial=_MOST)
        most = uppers.max(axis=1, initial=-1)
        row, col = np.nonzero(~same & (scores >= least) & (scores <= most))
        score = scores[row, col]
        # The last window whose upper limit isn't exceeded is the slot; limits descend.
        slot = (score[:, None] <= uppers[col]).sum(axis=1) - 1
        serves = score >= lowers[col, slot]
        return [keys[col][serves], slot[serves], score[serves], names[row][serves]]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        held: list[list[np.ndarray]] = []
        count, limit = 0, HELD
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            ids, kinds = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            for size, block in anchors.by_size.items():
                at = np.flatnonzero(sizes == size)
                for lo in range(0, len(at), TILE_ROWS):
                    some = at[lo : lo + TILE_ROWS]
                    flat = vectors.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
                    own = whole(np.asarray(flat, np.float64).reshape(len(some), size))
                    for k in range(0, len(block[0]), TILE_ANCHORS):
                        scores = products(own, block[2][k : k + TILE_ANCHORS])
                        part = thinned(found(block, k, scores, ids[some], kinds[some]), keep)
                        held.append(part)
                        count += len(part[0])
                        if count > limit:
                            held = [thinned([np.concatenate(c) for c in zip(*held)], keep)]
                            count = len(held[0][0])
                            limit = max(HELD, 2 * count)
        if held:
            held = thinned([np.concatenate(c) for c in zip(*held)], keep)
            for lo in range(0, len(held[0]), 65_536):
                arrays = [pa.array(c[lo : lo + 65_536].astype(np.int64)) for c in held]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "slot", "score", "vec_id"])

    return run


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_FOUND = "anchor bigint, slot bigint, score bigint, vec_id bigint"


def _best(found: DataFrame, keep: int) -> DataFrame:
    """Arrays (score, vec_id), best first, of the first rows of each anchor and slot."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    rows = F.sort_array(F.collect_list(F.struct("place", "score", "vec_id")))
    return first.groupBy("anchor", "slot").agg(rows.alias("rows"))


def _windows(anchors: list, near: list, positives: int, share: tuple[int, int]) -> list[dict]:
    """The anchors with their positives, as limits (descending, none below zero) and ids. One row of the anchor's own id and score is itself."""
    best = {r["anchor"]: [(x["score"], x["vec_id"]) for x in r["rows"]] for r in near}
    out = []
    for r in anchors:
        vector = whole(np.array([r["vector"]], np.float64).reshape(1, len(r["vector"])))
        found = list(best.get(r["anchor"], []))
        itself = int(products(vector, vector)[0, 0]), r["vec_id"]
        if itself in found:
            found.remove(itself)
        found = found[:positives]
        out.append(r.asDict() | {"uppers": [x for x, _ in found], "ids": [i for _, i in found], "lowers": [lower_limit(x, share) for x, _ in found]})
    return out


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, per_positive: int = NEGATIVES, share: tuple[int, int] = SHARE
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``is_anchor`` is a condition on vec_id and label."""
    spark = rows.sparkSession
    data = written(usable(rows), "vectors")
    # Anchors that share an id are told apart by a number of their own; the table is written, so the number stays.
    anchors = written(data.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    blocks = math.ceil(anchors.count() / BLOCK_ANCHORS)
    block = F.pmod(F.xxhash64("anchor"), F.lit(max(1, blocks)))
    folder = scratch_path(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(f"{folder}/block=-1")
    for k in range(blocks):
        own = anchors.filter(block == k).collect()  # about BLOCK_ANCHORS
        shared = spark.sparkContext.broadcast(Anchors(own, share))
        near = _best(data.mapInArrow(_search(shared, positives + 1, False), _FOUND), positives + 1).collect()
        shared.destroy()
        own = _windows(own, near, positives, share)
        shared = spark.sparkContext.broadcast(Anchors(own, share))
        best = _best(data.mapInArrow(_search(shared, per_positive, True), _FOUND), per_positive)
        slots = best.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "rows"))).alias("slots"))
        none = F.array().cast("array<array<struct<place:int,score:bigint,vec_id:bigint>>>")

        def merge(later: Column, j: Column) -> Column:
            """The best of slot j before what the windows below may choose from."""
            empty = F.array().cast("array<struct<place:int,score:bigint,vec_id:bigint>>")
            here = F.concat(F.coalesce(F.element_at("slots", j), empty), F.coalesce(F.get(later, F.lit(0)), empty))
            return F.concat(F.array(F.slice(here, 1, per_positive)), later)

        merged = slots.select("anchor", F.aggregate(F.sequence(F.lit(positives - 1).cast("bigint"), F.lit(0).cast("bigint")), none, merge).alias("merged"))
        limits = [(r["anchor"], r["vec_id"], j, i, u, lo) for r in own for j, (i, u, lo) in enumerate(zip(r["ids"], r["uppers"], r["lowers"])) if u >= 0]
        windows = spark.createDataFrame(limits, "anchor bigint, anchor_id bigint, j int, positive_id bigint, positive_score bigint, lower bigint")
        chosen = F.filter(F.get("merged", F.col("j")), lambda x: x["score"] >= F.col("lower"))
        out = windows.join(merged, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(chosen).alias("place", "row"))
        out = out.select(
            "anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("row.vec_id").alias("negative_id"), "positive_score",
            F.col("row.score").alias("negative_score"),
        )
        out.write.parquet(f"{folder}/block={k}")
        shared.destroy()
    return spark.read.schema(RESULT).parquet(folder).select(*[c.split()[0] for c in RESULT.split(", ")])
