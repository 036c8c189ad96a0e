"""Packing into fixed-length sequences by cutting-stock column generation.

1. Every text is tokenised once, in a map without a shuffle. A document is cut into full sequences and one rest; a piece is
   described by its start, length and checksum.
2. Piece lengths are counted in classes of ``grain`` tokens (at most capacity / grain classes, whatever the input's size).
   A linear program over packing patterns is solved by column generation: a knapsack by dynamic programming prices new
   patterns with the duals of the restricted program. Patterns are rounded down; what is left of each class (fewer pieces than
   patterns hold) is packed by best fit.
3. Pieces are ranked within their class (in salted blocks, so that a hot length is no single task) and the rank gives the
   sequence by a join with the pattern table, whose size is bounded by the square of the number of classes.

Nulls and ties: a null text is an empty text and has one token, the end; documents with equal ids, or without id, are packed
as separate rows; equal pieces may swap places, which leaves the same rows; an empty table gives no rows. Only the id and the
text are read, so other columns don't matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import slices, tidy, written
from riskweft.llm.tokens import WordIds

CAPACITY = 2048
GRAIN = 8
BLOCK_ROWS = 20_000
PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _tokenise(path: str, end_id: int, capacity: int):
    """The tokenizer never joins across white space, so words are encoded alone and joined."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            names = batch.column("doc_id")
            for first, run_of in slices(batch.column("text")):
                for k, own in enumerate(ids.texts(run_of)):
                    data = own + end
                    for start in range(0, len(data), 4 * capacity):
                        piece = data[start : start + 4 * capacity]
                        for column, value in zip(rows, (first + k, start // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4)):
                            column.append(value)
            arrays = [names.take(pa.array(rows[0], pa.int64())), *[pa.array(c, pa.int64()) for c in rows[1:]]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pieces_of(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of at most ``capacity`` ids."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _tokenise(tokenizer, end_id, capacity), PIECES.format(id=kind)
    )


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes within the capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = sizes <= c
        gains = np.where(fits, values + best[np.maximum(c - sizes, 0)], -1.0)
        k = int(gains.argmax())
        best[c] = best[c - 1]
        if gains[k] > best[c] + 1e-12:
            best[c], pick[c] = gains[k], k
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return float(best[capacity]), counts


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3, rounds: int = 4000):
    """Column generation by the revised simplex method: patterns and how often each is used, as real numbers.

    It stops when the cost is within ``gap`` of the lower bound that the best price gives. Any basis it stops at covers the
    demand, so ``rounds`` bounds only how close to the optimum the patterns come.
    """
    columns = np.diag(capacity // sizes).astype(float)
    costs = np.ones(len(sizes))
    inverse = np.diag(1.0 / (capacity // sizes))
    # Small unequal amounts keep ties from stalling the search.
    extra = demand.sum() * 1e-7 * (1 + np.arange(len(sizes)) / len(sizes))
    used = inverse @ (demand + extra)
    for _ in range(rounds):
        duals = np.einsum("i,ij->j", costs, inverse)
        worst = int(duals.argmin())
        if duals[worst] < -1e-9:
            column, cost = np.zeros(len(sizes)), 0.0  # more pieces of a class than asked for
            column[worst] = -1
        else:
            value, column = best_pattern(duals, sizes, capacity)
            cost = 1.0
            if value <= 1 + gap:
                break
        step = np.einsum("ij,j->i", inverse, column)
        up = step > 1e-9
        if not up.any():
            break
        ratios = np.where(up, used / np.where(up, step, 1), np.inf)
        out = int(ratios.argmin())
        columns[:, out], costs[out] = column, cost
        used -= ratios[out] * step
        used[out] = ratios[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
    real = costs > 0
    return columns.T[real].round().astype(np.int64), used[real]


def plan(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Whole patterns that hold every piece: (times used, [(class, copies)])."""
    if not sizes:
        return []
    size, left = np.array(sizes, np.int64), np.array(demand, np.int64)
    patterns, used = solve(size, left.astype(float), capacity)
    out: dict[tuple, int] = {}
    for k in np.argsort(-used, kind="stable"):
        own = patterns[k]
        held = own > 0
        times = min(int(used[k] + 1e-6), int((left[held] // own[held]).min())) if held.any() else 0
        if times > 0:
            left -= times * own
            key = tuple((int(i), int(own[i])) for i in np.flatnonzero(own))
            out[key] = out.get(key, 0) + times
    # Fewer pieces than the patterns hold are left: the best filling of one sequence at a time.
    while left.any():
        counts, room = np.zeros(len(size), np.int64), capacity
        while True:
            fits = np.flatnonzero((left - counts > 0) & (size <= room))
            if not len(fits):
                break
            k = fits[size[fits].argmax()]
            more = min(int(left[k] - counts[k]), room // int(size[k]))
            counts[k] += more
            room -= more * int(size[k])
        held = counts > 0
        times = int((left[held] // counts[held]).min())
        left -= times * counts
        key = tuple((int(i), int(counts[i])) for i in np.flatnonzero(counts))
        out[key] = out.get(key, 0) + times
    return [(times, list(key)) for key, times in out.items()]


def pack(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Pieces with sequence_id and offset; sequences hold at most ``capacity`` ids without gaps."""
    pieces = written(pieces_of(documents, tokenizer, end_id, capacity), "pieces")
    return place(pieces, capacity, grain)


def place(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    spark = pieces.sparkSession
    pieces = pieces.withColumn("size", F.ceil(F.col("length") / grain).cast("int"))
    counts = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = sorted(counts)
    slots, base = [], 0
    taken = dict.fromkeys(range(len(sizes)), 0)
    for times, held in plan(sizes, [counts[s] for s in sizes], capacity // grain):
        for i, copies in held:
            slots.append((sizes[i], taken[i], taken[i] + times * copies, copies, base))
            taken[i] += times * copies
        base += times
    table = spark.createDataFrame(slots or [(0, 0, 0, 1, 0)], "size int, first bigint, past bigint, copies bigint, base bigint")
    # Rank of a piece in its class: rank within a block of the class, and the pieces in the blocks before.
    blocks = max(1, math.ceil(sum(counts.values()) / BLOCK_ROWS))
    order = [F.desc("length"), "doc_id", "start", "ids_crc32"]
    ranked = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("size", "block").orderBy(*order)) - 1
    )
    before = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        pieces.groupBy("size", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)).alias("block"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("size", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    placed = (
        ranked.join(shift, ["size", "block"])
        .withColumn("rank", F.col("rank") + F.col("shift"))
        .join(F.broadcast(table.withColumnRenamed("size", "of")), (F.col("of") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
        .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("copies")))
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    )
