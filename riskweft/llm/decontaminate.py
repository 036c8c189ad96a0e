"""Benchmark decontamination: windows of normalised test words, scanned in every document against a broadcast hash set.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters. A window is ``ngram`` consecutive words
of one benchmark item; an item of fewer words, but not none, is one window. A document word inside any occurrence of a window
is hit. The scan is one map over the documents, without a shuffle: words become numbers of the benchmark's vocabulary, window
hashes preselect places and an exact comparison confirms them.

The benchmark is read in parts of at most ``PART_BYTES`` of text, counted first. Each part is broadcast on its own, the
documents pass through all parts and are written between them, so a benchmark of any size works with bounded memory.

Nulls and ties: a null or empty text has no words and no hits; benchmark rows without id or without words are ignored; rows of
one item id count as one item; repeated documents are scanned one by one; an empty benchmark hits nothing. Other columns of
``documents`` are kept by ``scan`` and ``remove_spans``, whatever their names; the columns that ``scan`` adds come last and
replace columns of the same name.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweft.llm.common import Rolling, alnum_words, mixed, packed, slices, spans_of, tidy, written

PART_BYTES = 32 << 20
SPANS = "array<struct<start:int,end:int>>"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass
class Part:
    """Windows of one part of the benchmark: word numbers, and by window length the hashes and the exact windows."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: list[str] = field(default_factory=list)
    windows: dict[int, dict[bytes, list[int]]] = field(default_factory=lambda: defaultdict(dict))
    hashes: dict[int, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[str, bytes]], ngram: int) -> Part:
        part, roll, numbers = Part(), Rolling(), {}
        for item, text in rows:
            words = alnum_words(text)
            if not words:
                continue
            number = numbers.setdefault(item, len(numbers))
            codes = np.array([part.vocabulary.setdefault(w, len(part.vocabulary) + 1) for w in words], np.int32)
            n = min(ngram, len(codes))
            for i in range(len(codes) - n + 1):
                held = part.windows[n].setdefault(codes[i : i + n].tobytes(), [])
                if number not in held:
                    held.append(number)
        part.items = list(numbers)
        part.windows = dict(part.windows)
        for n, held in part.windows.items():
            rows_of = np.frombuffer(b"".join(held), np.int32).reshape(-1, n)
            part.hashes[n] = np.unique([roll.windows(mixed(r), n)[0] for r in rows_of])
        return part

    def find(self, codes: np.ndarray, roll: Rolling) -> list[tuple[int, int, list[int]]]:
        """(place, length, items) of every window that occurs in the codes; 0 is a word the part doesn't know."""
        found = []
        known = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(codes != 0, out=known[1:])
        for n, hashes in self.hashes.items():
            if len(codes) < n or not len(hashes):
                continue
            places = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(places):
                continue
            own = roll.windows(mixed(codes), n)[places]
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            for p in places[hashes[at] == own].tolist():
                items = self.windows[n].get(codes[p : p + n].tobytes())
                if items is not None:
                    found.append((p, n, items))
        return found


def _parts(benchmark: DataFrame, ngram: int, part_bytes: int) -> Iterator[Part]:
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).dropna()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / part_bytes))
    for i in range(count):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == i).collect()
        yield Part.of(sorted((r[0], bytes(r[1])) for r in rows), ngram)


def _scanner(shared):
    """Map one batch: words, hit spans and items of each text, joined with what earlier parts found."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll = shared.value, Rolling()
        lookup = part.vocabulary.get
        for batch in batches:
            words, hits, spans, items = [], [], [], []
            before = {c: batch.column(c).to_pylist() for c in ("hit_spans", "item_ids") if c in batch.schema.names}
            for first, run_of in slices(batch.column("text")):
                codes, starts = [], []
                for text in run_of:
                    starts.append(len(codes))
                    codes.extend([lookup(w, 0) for w in alnum_words(text)])
                    codes.append(0)
                starts.append(len(codes))
                codes = np.array(codes, np.int32)
                found = part.find(codes, roll)
                marks = np.zeros(len(codes) + 1, np.int32)
                own = defaultdict(set)
                if found:
                    places = np.array([p for p, _, _ in found])
                    ends = places + np.array([n for _, n, _ in found])
                    np.add.at(marks, places, 1)
                    np.add.at(marks, ends, -1)
                    rows = np.searchsorted(np.array(starts), places, side="right") - 1
                    for row, (_, _, held) in zip(rows.tolist(), found):
                        own[row].update(part.items[k] for k in held)
                hit = np.cumsum(marks[:-1]) > 0
                some = np.add.reduceat(hit, starts[:-1]) if len(codes) else []
                for k in range(len(run_of)):
                    i, n = first + k, starts[k + 1] - starts[k] - 1
                    mask = hit[starts[k] : starts[k] + n] if some[k] else None
                    if before and before["hit_spans"][i]:
                        mask = np.zeros(n, bool) if mask is None else mask.copy()
                        for s in before["hit_spans"][i]:
                            mask[s["start"] : s["end"]] = True
                        own[k].update(before["item_ids"][i])
                    words.append(n)
                    hits.append(0 if mask is None else int(mask.sum()))
                    spans.append([] if mask is None else [{"start": a, "end": b} for a, b in spans_of(mask)])
                    items.append(sorted(own.get(k, ())))
            names = ["row", "text"]
            arrays = [batch.column(c) for c in names] + [
                pa.array(words, pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "n_words", "n_hit", "hit_spans", "item_ids"])

    return run


def _scan_rows(rows: DataFrame, benchmark: DataFrame, ngram: int, part_bytes: int) -> DataFrame:
    """Rows (row, text) with what the scan finds; between two parts they are written, so one part is in memory at a time."""
    spark, shared = rows.sparkSession, None
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"n_words bigint, n_hit bigint, hit_spans {SPANS}, item_ids array<string>").fields])
    for part in _parts(benchmark, ngram, part_bytes):
        if shared is not None:
            rows = written(rows, "scanned")
            shared.destroy()
        shared = spark.sparkContext.broadcast(part)
        rows = rows.mapInArrow(_scanner(shared), schema)
    return rows


def scan(documents: DataFrame, benchmark: DataFrame, ngram: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each document with n_words, n_hit, hit_spans (word numbers, end exclusive) and item_ids (sorted as strings)."""
    held = documents.drop("n_words", "n_hit", "hit_spans", "item_ids")
    found = _scan_rows(packed(held, F.col("text").cast("binary").alias("text")), benchmark, ngram, part_bytes)
    return found.select("row.*", "n_words", "n_hit", "hit_spans", "item_ids")


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def _cleaner(shared):
    """Cut and look again until no window of the part occurs."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll = shared.value, Rolling()
        lookup = part.vocabulary.get
        for batch in batches:
            out = []
            for _, run_of in slices(batch.column("text")):
                for text in run_of:
                    while text:
                        words = alnum_words(text)
                        hit = np.zeros(len(words), bool)
                        for p, n, _ in part.find(np.array([lookup(w, 0) for w in words], np.int32), roll):
                            hit[p : p + n] = True
                        if not hit.any():
                            break
                        text = cut_spans(text, spans_of(hit))
                    out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], ["row", "text"])

    return run


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [
            cut_spans(text.as_py(), [(s["start"], s["end"]) for s in spans])
            for text, spans in zip(batch.column("text"), batch.column("hit_spans").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], ["row", "text"])


def remove_spans(documents: DataFrame, benchmark: DataFrame, ngram: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents with every hit span cut out of the text, again until no window occurs; n_chars follows.

    Cutting can bring the words on both sides together, so passes repeat for as long as a pass finds hits; every pass removes
    words, and only documents with hits change. A benchmark of one part is repeated within the task; with more parts, every pass
    over all parts is written, and the next one reads the documents that were cut.
    """
    columns = documents.columns
    held = documents.select(*[F.col(f"`{c}`") for c in columns if c != "text"])
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in held.columns]).alias("row"), F.col("text").cast("binary").alias("text"))
    size = benchmark.select(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    if size <= part_bytes:
        shared = documents.sparkSession.sparkContext.broadcast(next(_parts(benchmark, ngram, part_bytes)))
        out = rows.mapInArrow(_cleaner(shared), rows.schema)
    else:
        schema, out = rows.schema, None
        while True:
            scanned = written(_scan_rows(rows, benchmark, ngram, part_bytes), "scanned")
            clean = scanned.filter("n_hit = 0").select("row", "text")
            out = clean if out is None else out.union(clean)
            hit = scanned.filter("n_hit > 0")
            if not hit.head(1):
                break
            rows = hit.select("row", "text", "hit_spans").mapInArrow(_cut, schema)
    new = {"text": F.col("text").cast("string")}
    if "n_chars" in columns:
        new["n_chars"] = F.length(new["text"]).cast(documents.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and hashes of a scan, one row for each document."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
