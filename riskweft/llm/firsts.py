"""Which hashes of a document also occur in a document with a smaller id, decided in Spark.

A map hashes the documents; flushes of about ``FLUSH_BYTES`` of text are compared at once: for each hash only the document with
the smallest id stays open, the others are repeats already. A hash that stands in a third of all documents therefore leaves a
task once for each flush, not once for each document. Open hashes are dealt to buckets as packed
arrays; a bucket sorts its hashes and answers those that a smaller document has elsewhere. The number of buckets is up to the
caller and has to follow the input.

Where hashes share the number by which they are dealt, one number can have too many of them for a bucket: all windows around a
phrase that stands in many documents. Such numbers are counted first, over all documents, and their hashes are dealt to as many
parts as needed by the hash itself, so equal hashes still meet. The count only says where hashes meet; the answers are the same
whatever it finds.

Documents without id or text are left out. Rows that share an id don't count against one another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import mixed, spans_of, tidy

FLUSH_BYTES = 6 << 20
#: Makes, in a task, the function that gives the hashes of a text, and for each hash the number by which it is dealt to a bucket.
#: Equal hashes need equal numbers; hashes that stand side by side may share one, so that a document's answers are few rows.
Hasher = Callable[[], Callable[[bytes], tuple[np.ndarray, np.ndarray]]]

_RUNS, _HASHES = 0, 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: the leading bytes of sorted numbers repeat, and the shuffle's compression removes them."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes()


def _numbers(planes: bytes, kind: type, offset: int, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8, n * size, offset).reshape(size, n).T).view(kind).reshape(n)


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text")):
            data = text.as_py()
            held.append((doc.as_py(), data))
            size += len(data) + 100
            if size >= FLUSH_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


@dataclass
class Hot:
    """Numbers with more hashes than one part is to hold, in order, and the parts of each."""

    numbers: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    parts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def dealt(self, deal: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The numbers by which hashes are dealt, with those of hot ones salted by the hash."""
        if not len(self.numbers):
            return deal
        at = np.minimum(np.searchsorted(self.numbers, deal), len(self.numbers) - 1)
        hot = self.numbers[at] == deal
        out = deal.copy()
        out[hot] = mixed(deal[hot] + mixed(hashes[hot]) % self.parts[at[hot]] * _STEP)
        return out

    def part_of(self, deal: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The part, from 1, that a hash of a hot number goes to; 0 for numbers that are whole."""
        out = np.zeros(len(deal), np.int64)
        if len(self.numbers) and len(deal):
            at = np.minimum(np.searchsorted(self.numbers, deal), len(self.numbers) - 1)
            hot = self.numbers[at] == deal
            out[hot] = (mixed(hashes[hot]) % self.parts[at[hot]]).astype(np.int64) + 1
        return out


def _counts(hasher: Hasher, limit: int):
    """Hashes that leave a flush by number. Numbers of a single document are left out unless they fill a part alone."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = hasher()
        for held in flushes(batches):
            own = [hashes_of(text) for _, text in held]
            rows = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h, _ in own])
            if not len(rows):
                continue
            _, first = np.unique(np.concatenate([h for h, _ in own]), return_index=True)
            deal, rows = np.concatenate([d for _, d in own])[first], rows[first]
            order = np.argsort(deal, kind="stable")
            deal, rows = deal[order], rows[order]
            starts = np.flatnonzero(np.concatenate(([True], deal[1:] != deal[:-1])))
            n = np.diff(np.append(starts, len(deal)))
            kept = (np.minimum.reduceat(rows, starts) < np.maximum.reduceat(rows, starts)) | (n > limit)
            arrays = [pa.array(deal[starts][kept].view(np.int64)), pa.array(n[kept].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["number", "n"])

    return run


def hot_numbers(source: DataFrame, hasher: Hasher, limit: int) -> Hot:
    """Numbers with more than ``limit`` open hashes; at most one for each ``limit`` hashes reaches the driver."""
    counted = source.dropna().mapInArrow(_counts(hasher, limit), "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n"))
    found = counted.filter(F.col("n") > limit).collect()
    numbers = np.array([r["number"] for r in found], np.int64).view(np.uint64)
    parts = np.array([-(-r["n"] // limit) for r in found], np.uint64)
    order = np.argsort(numbers)
    return Hot(numbers[order], parts[order])


def _open_hashes(hasher: Hasher, buckets: int, hot: Hot):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = hasher()
        for held in flushes(batches):
            held.sort(key=lambda row: row[0])
            ids = np.array([doc for doc, _ in held], np.int64)
            own = [hashes_of(text) for _, text in held]
            sizes = np.array([len(h) for h, _ in own])
            hashes, deal = np.concatenate([h for h, _ in own]), np.concatenate([d for _, d in own])
            if not len(hashes):
                continue
            rows = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
            order = np.argsort(hashes, kind="stable")
            by_hash, by_row = hashes[order], rows[order]
            new = np.concatenate(([True], by_hash[1:] != by_hash[:-1]))
            first = np.flatnonzero(new)
            lowest = np.repeat(ids[by_row[first]], np.diff(np.append(first, len(order))))
            repeat = np.zeros(len(hashes), bool)
            repeat[order] = ids[by_row] > lowest
            out: list[list] = [[], [], [], [], []]

            def emit(bucket, kind, doc, data, docs, out=out):
                for column, value in zip(out, (bucket, kind, doc, data, docs)):
                    column.append(value)

            starts = np.concatenate(([0], np.cumsum(sizes)))
            for k in np.unique(rows[repeat]).tolist():
                runs = np.array(spans_of(repeat[starts[k] : starts[k + 1]]), np.int32)
                emit(k % buckets, _RUNS, int(ids[k]), runs.tobytes(), None)
            number = hot.dealt(deal[order][first], by_hash[first])
            bucket = ((number >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            dealt = np.argsort(bucket, kind="stable")  # sorted by hash within each bucket
            open_hashes, open_rows = by_hash[first][dealt], by_row[first][dealt].astype(np.uint32)
            cuts = np.searchsorted(bucket[dealt], np.arange(buckets + 1))
            for b in range(buckets):
                if cuts[b] < cuts[b + 1]:
                    used, at = np.unique(open_rows[cuts[b] : cuts[b + 1]], return_inverse=True)
                    docs = np.uint32(len(used)).tobytes() + _planes(ids[used]) + _planes(at.astype(np.uint32 if len(used) > 65535 else np.uint16))
                    emit(b, _HASHES, None, _planes(open_hashes[cuts[b] : cuts[b + 1]]), docs)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["bucket", "kind", "doc_id", "data", "docs"])

    return run


def _answer(group: pa.Table) -> pa.Table:
    """Of one bucket: hashes that begin in a document with a smaller id, by the document they are to leave."""
    doc_ids, kinds, data = [], [], []
    hashes, docs = [], []
    for row in group.select(["kind", "doc_id", "data", "docs"]).to_pylist():
        if row["kind"] == _RUNS:
            doc_ids.append(row["doc_id"])
            kinds.append(_RUNS)
            data.append(row["data"])
            continue
        own = _numbers(row["data"], np.uint64, 0, len(row["data"]) // 8)
        n = int(np.frombuffer(row["docs"], np.uint32, 1)[0])
        ids = _numbers(row["docs"], np.int64, 4, n)
        at = _numbers(row["docs"], np.uint32 if n > 65535 else np.uint16, 4 + 8 * n, len(own))
        hashes.append(own)
        docs.append(ids[at])
    if hashes:
        all_hashes, all_docs = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(all_hashes, kind="stable")
        by_hash, by_doc = all_hashes[order], all_docs[order]
        first = np.flatnonzero(np.concatenate(([True], by_hash[1:] != by_hash[:-1])))
        lowest = np.repeat(np.minimum.reduceat(by_doc, first), np.diff(np.append(first, len(order))))
        late = by_doc > lowest
        by_hash, by_doc = by_hash[late], by_doc[late]
        order = np.argsort(by_doc, kind="stable")
        by_hash, by_doc = by_hash[order], by_doc[order]
        edges = np.flatnonzero(np.concatenate(([True], by_doc[1:] != by_doc[:-1]))) if len(by_doc) else []
        for a, b in zip(edges, np.append(edges[1:], len(by_doc)).astype(int) if len(edges) else []):
            doc_ids.append(int(by_doc[a]))
            kinds.append(_HASHES)
            data.append(by_hash[a:b].tobytes())
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "kind": pa.array(kinds, pa.int32()), "data": pa.array(data, pa.binary())})


def opened(source: DataFrame, hasher: Hasher, buckets: int, limit: int | None = None) -> DataFrame:
    """Open hashes by bucket; with a limit, numbers that have more of them are counted first and dealt in parts."""
    hot = hot_numbers(source, hasher, limit) if limit and buckets > 1 else Hot()
    return source.dropna().mapInArrow(_open_hashes(hasher, buckets, hot), "bucket int, kind int, doc_id bigint, data binary, docs binary")


def repeats(source: DataFrame, hasher: Hasher, buckets: int, limit: int | None = None) -> DataFrame:
    """doc_id and answers, for the documents with a repeat; the source has doc_id (bigint) and text (binary)."""
    answered = opened(source, hasher, buckets, limit).groupBy("bucket").applyInArrow(_answer, "doc_id bigint, kind int, data binary")
    return answered.groupBy("doc_id").agg(F.collect_list(F.struct("kind", "data")).alias("answers"))


def flagged(hashes: np.ndarray, answers: list[dict]) -> np.ndarray:
    """Which of a document's hashes, in the hasher's order, are repeats."""
    mask = np.zeros(len(hashes), bool)
    found = [np.frombuffer(a["data"], np.uint64) for a in answers if a["kind"] == _HASHES]
    if found:
        mask |= np.isin(hashes, np.concatenate(found))
    for a in answers:
        if a["kind"] == _RUNS:
            for start, end in np.frombuffer(a["data"], np.int32).reshape(-1, 2):
                mask[start:end] = True
    return mask
