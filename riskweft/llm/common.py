"""Helpers the corpus operators share: tables, written intermediates, word splitting and window hashes."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskweft.session import scratch_path

#: Bytes of text that a task turns into numbers at once.
SLICE_BYTES = 4 << 20
#: Distinct words whose codes a task keeps; beyond it the table starts anew.
CACHE_WORDS = 250_000

# Lower-cases A-Z, keeps a-z, 0-9 and every byte from 0x80, and makes all else a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read the table again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """A task function that gives its memory back when it ends: workers outlive tasks, and the next stage needs the room."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
        if trim:
            trim(0)

    return tidied


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """The whole row as one column ``row``, whatever its columns are called, beside others."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def packed_schema(df: DataFrame, more: str) -> StructType:
    """Schema of the packed row and further columns."""
    return StructType([StructField("row", df.schema), *StructType.fromDDL(more).fields])


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of non-ASCII characters."""
    return text.translate(WORD_BYTES).split() if text else []


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """Cut a batch into runs of rows of about SLICE_BYTES: the first row's number and the texts."""
    first, size, run = 0, 0, []
    for i in range(len(texts)):
        run.append(texts[i].as_py())
        size += len(run[-1] or b"") + 64
        if size >= SLICE_BYTES:
            yield first, run
            first, size, run = i + 1, 0, []
    if run:
        yield first, run


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Rabin-Karp hashes modulo 2**64 of all windows of a sequence, from running sums.

    With an odd base B the hash of w[i:i+n] is B**i-normalised: sum of w[i+j] * B**(-j). A running sum of w[k] * B**(-k)
    gives every window with one subtraction and one product.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            step = np.full(n, self.BASE, np.uint64)
            step[0] = 1
            self.powers = np.multiply.accumulate(step)
            step[1:] = pow(self.BASE, -1, 1 << 64)
            self.inverses = np.multiply.accumulate(step)

    def windows(self, codes: np.ndarray, n: int) -> np.ndarray:
        """Hash of codes[i:i+n] for each i; none when there are fewer than n codes."""
        if len(codes) < n:
            return np.zeros(0, np.uint64)
        self._grow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.inverses[: len(codes)], out=sums[1:])
        return mixed((sums[n:] - sums[:-n]) * self.powers[: len(codes) - n + 1])


class WordCodes(dict):
    """64-bit codes of words (xxHash), kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true values: (start, end), end exclusive."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window that begins at one of the starts."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return np.cumsum(marks[:n]) > 0
