"""Substring dedup: Rabin-Karp hashes of all windows of ``width`` words, counted in Spark, merged into removal intervals.

Words are the runs between ASCII white space, unchanged. A window of a document is a repeat if the same words also begin in a
document with a smaller id; all words that repeats cover are removed, judged on the input alone.

Every window's hash goes to a bucket, less those that a task can decide alone (``firsts``); the number of buckets follows the
input. Windows around a phrase of many documents are counted first and spread over several buckets. Answers are joined with the documents by id, and covered words are cut.

Hashes have 64 bits: among n different windows about n**2 / 2**65 pairs collide, which is 0.0004 pairs for 10**8 windows.

Nulls and ties: a null or empty text has no words; documents without id neither cause nor suffer removals; rows that share an
id don't count against one another, and each is cut against smaller ids; an empty table gives no rows. Only the id and the text
are read, so other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import Rolling, WordCodes, covered, mixed, spans_of
from riskweft.llm.firsts import flagged, repeats

WIDTH, ANCHOR = 50, 8
#: Windows that a bucket holds on average.
BUCKET_WINDOWS = 1_000_000
#: An anchor of more than this share of a bucket's windows is dealt in parts of that size.
HOT_SHARE = 1 / 4
#: English and most European texts have a word for each six bytes.
BYTES_PER_WORD = 6


class _Windows:
    """Hashes of all windows of a text.

    A window is dealt by the smallest hash of the ``ANCHOR`` word stretches in it. Equal windows have equal anchors, and windows
    side by side mostly share one, so a repeated passage is answered by few buckets.
    """

    def __init__(self, width: int):
        self.width, self.codes, self.roll = width, WordCodes(), Rolling()

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        codes = self.codes.array(text.split())
        hashes = self.roll.windows(codes, self.width)
        anchor = min(ANCHOR, self.width)
        return hashes, mixed(_lowest(self.roll.windows(codes, anchor), self.width - anchor + 1))


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row."""
    if len(values) < width:
        return values[:0]
    n, span = len(values) - width + 1, 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:n], values[width - span : width - span + n])


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(width)
        for batch in batches:
            counts, removed, spans, kept = [], [], [], []
            for text, answers in zip(batch.column("text"), batch.column("answers")):
                data = text.as_py() or b""
                words = data.split()
                gone: list[tuple[int, int]] = []
                if answers.is_valid and len(words) >= width:
                    repeat = flagged(windows(data)[0], answers.as_py())
                    gone = spans_of(covered(np.flatnonzero(repeat), width, len(words)))
                counts.append(len(words))
                removed.append(sum(b - a for a, b in gone))
                spans.append([{"start": a, "end": b} for a, b in gone])
                left, at = [], 0
                for a, b in gone:
                    left += words[at:a]
                    at = b
                kept.append(b" ".join(left + words[at:] if gone else words))
            arrays = [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "removed_spans", "kept"])

    return run


def dedup_substrings(documents: DataFrame, width: int = WIDTH, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Each document with n_words, n_removed, removed_spans (word numbers, end exclusive) and kept (words joined by spaces)."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BYTES_PER_WORD / bucket_windows))
    by_doc = repeats(source, lambda: _Windows(width), buckets, max(1, int(bucket_windows * HOT_SHARE)))
    cut = source.join(by_doc, "doc_id", "left").mapInArrow(
        _cut(width),
        "doc_id bigint, n_words bigint, n_removed bigint, removed_spans array<struct<start:int,end:int>>, kept binary",
    )
    return cut.withColumn("kept", F.col("kept").cast("string"))


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
