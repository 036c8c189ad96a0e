"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

1. Every text is tokenised once and ends with the end id. The ids are counted; the most frequent id gets rank 0 (ties: the smaller
   id first). The table of ranks has at most as many entries as the vocabulary.
2. A rank is stored in 1 to 4 bytes, little-endian without its leading zero bytes. The number of bytes less one is a code of two
   bits; four codes, the first one lowest, are a control byte. Control bytes and data bytes are apart. A document starts a
   new control byte; codes that fill up its last one stand for ranks of 0 that the reader drops.
3. Documents are range-partitioned by id, sorted, and every partition is written to one file. The place of a file's first id among
   all ids follows from the files' counts.
4. A reader looks up each control byte in a table of lengths and of byte places, so that four ranks are one gather, and the ranks
   in the table of ids.

Files in the folder:

* ``ids.tab``: ``TABMAGIC``, number of ranks (u64), id of each rank (u32).
* ``part-*.tvb``: ``MAGIC``, then blocks: numbers of documents, control bytes and data bytes (u64 each); ids of the documents (i64),
  flags (u8, 1: the document has an id), numbers of tokens (u64); control bytes; data bytes. All numbers are little-endian.
* ``manifest``: a Parquet table with one row for each file that counts: part, path, documents, ids, first (ids in the files before).
  A file that a lost or repeated attempt left behind isn't named there.

Tasks reach the folder by ``pyarrow.fs``, so it is a path or address that every executor can open.

Nulls and ties: a null text is an empty text and has one token, the end; documents without id come first and keep the null; documents
with equal ids follow one another by number of tokens, then in the order of their rows, each with tokens of its own. An empty table
gives no files and no rows. Very long texts are one document of one block. Only the id (a whole number) and the text are read, so
other columns don't matter, whatever their names.
"""

from __future__ import annotations

import bisect
import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweft.llm.common import slices, tidy, written
from riskweft.llm.tokens import WordIds, code_for
from riskweft.session import scratch_path

# Fixed values of the file format.
MAGIC, TABMAGIC = b"TOKVB\x00\x00\x01", b"TOKTAB\x00\x01"
HEAD = "<3Q"

#: Ids of one file, about, and payload bytes of one block.
FILE_IDS, BLOCK_BYTES = 16_000_000, 1 << 20
#: Control bytes that are decoded at once.
DECODE = 1 << 16

# The four lengths of each control byte, their sum, and the places of the sixteen bytes; 16 marks a byte that isn't stored.
LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)
TOTALS = LENGTHS.sum(axis=1)
_STARTS = np.cumsum(LENGTHS, axis=1) - LENGTHS
GATHER = np.where(np.arange(4) < LENGTHS[:, :, None], _STARTS[:, :, None] + np.arange(4), 16).reshape(256, 16)


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a document's ranks."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[: len(ranks)] = ranks
    sizes = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (sizes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = padded.view(np.uint8).reshape(-1, 4)[np.arange(4) <= sizes[:, None]]
    return control.tobytes(), data.tobytes()


def decoded(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Four ranks for each control byte."""
    ends = np.cumsum(TOTALS[control])
    out = np.empty((len(control), 16), np.uint8)
    for lo in range(0, len(control), DECODE):
        part = control[lo : lo + DECODE]
        first = int(ends[lo - 1]) if lo else 0
        own = np.concatenate((data[first : int(ends[lo + len(part) - 1])], np.zeros(1, np.uint8)))
        places = GATHER[part]
        at = (ends[lo : lo + len(part)] - TOTALS[part] - first)[:, None] + places
        at[places == 16] = len(own) - 1
        out[lo : lo + len(part)] = own[at]
    return out.view("<u4").reshape(-1)


def opened(folder: str):
    """File system and path of a folder that Spark names."""
    from pyarrow import fs

    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _tokenise(path: str, end_id: int, code: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, row = WordIds(path, code), struct.pack(f"<{code}", end_id), TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, run_of in slices(batch.column("text")):
                own = [x + end for x in ids.texts(run_of)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(own)),
                        pa.array(range(row, row + len(own)), pa.int64()),
                        pa.array([len(x) // len(end) for x in own], pa.int64()),
                        pa.array(own, pa.binary()),
                    ],
                    ["doc_id", "row", "n_tokens", "ids"],
                )
                row += len(own)

    return run


def _count(code: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for batch in batches:
            texts = batch.column("ids")
            for lo in range(0, len(texts), 100):
                more = np.bincount(np.frombuffer(b"".join(texts[lo : lo + 100].to_pylist()), f"<{code}"))
                if len(more) > len(counts):
                    counts, more = more, counts
                counts[: len(more)] += more
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["id", "n"])

    return run


def _order(doc_id: int | None, n_tokens: int, row: int) -> tuple:
    """The order of documents: none without id, then by id, number of tokens and row."""
    return doc_id is not None, doc_id or 0, n_tokens, row


def _encode(shared, code: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bounds = shared.value
        rank_of = np.zeros(int(table.max(initial=0)) + 1, "<u4")
        rank_of[table] = np.arange(len(table))
        for batch in batches:
            both = [coded(rank_of[np.frombuffer(x.as_buffer(), f"<{code}")]) for x in batch.column("ids")]
            arrays = [batch.column(c) for c in ("doc_id", "n_tokens", "row")]
            part = [max(0, bisect.bisect_right(bounds, _order(*own)) - 1) for own in zip(*[a.to_pylist() for a in arrays])]
            arrays += [pa.array([x[k] for x in both], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(part, pa.int32())], ["doc_id", "n_tokens", "row", "control", "data", "part"])

    return run


def _block(rows: list[tuple]) -> bytes:
    """Rows of (doc_id, n_tokens, control, data)."""
    control, data = b"".join([r[2] for r in rows]), b"".join([r[3] for r in rows])
    names = np.array([r[0] or 0 for r in rows], "<i8").tobytes()
    known = bytes([r[0] is not None for r in rows])
    return b"".join([struct.pack(HEAD, len(rows), len(control), len(data)), names, known, np.array([r[1] for r in rows], "<u8").tobytes(), control, data])


def _files(folder: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tvb"
        documents, ids, rows, size = 0, 0, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n_tokens", "control", "data")]
            for k in range(batch.num_rows):
                row = tuple(c[k].as_py() for c in columns)
                rows.append(row)
                documents, ids, size = documents + 1, ids + row[1], size + len(row[2]) + len(row[3])
                if size >= BLOCK_BYTES:
                    if out is None:
                        system, path = opened(folder)
                        out = system.open_output_stream(f"{path}/{name}")
                        out.write(MAGIC)
                    out.write(_block(rows))
                    rows, size = [], 0
        if rows or out is not None:
            if out is None:
                system, path = opened(folder)
                out = system.open_output_stream(f"{path}/{name}")
                out.write(MAGIC)
            if rows:
                out.write(_block(rows))
            out.close()
            columns = [[part], [name], [documents], [ids]]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "path", "documents", "ids"])

    return run


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 1, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents' ids to the folder; returns the manifest."""
    spark = documents.sparkSession
    code = code_for(tokenizer, end_id)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    tokens = texts.mapInArrow(_tokenise(tokenizer, end_id, code), "doc_id bigint, row bigint, n_tokens bigint, ids binary")
    tokens = written(tokens, "token-ids")
    counts = tokens.select("ids").mapInArrow(_count(code), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = sorted((-r["n"], r["id"]) for r in counts.collect())  # at most the vocabulary
    table, total = np.array([i for _, i in ranked], "<u4"), -sum(n for n, _ in ranked)
    system, path = opened(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/ids.tab") as out:
        out.write(TABMAGIC + struct.pack("<Q", len(table)) + table.tobytes())
    # The first document of each file, from the keys alone. The row's own number splits documents that share an id, however many.
    order, parts = ["doc_id", "n_tokens", "row"], max(1, math.ceil(total / file_ids))
    keys = tokens.select(*order).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    firsts = keys.groupBy("part").agg(F.min_by(F.struct(*order), F.struct(F.col("doc_id").isNotNull(), *order)).alias("first"))
    bounds = sorted(_order(*r["first"]) for r in firsts.collect())  # one for each file
    shared = spark.sparkContext.broadcast((table, bounds))
    schema = "doc_id bigint, n_tokens bigint, row bigint, control binary, data binary, part int"
    rows = tokens.select(*order, "ids").mapInArrow(_encode(shared, code), schema)
    files = rows.repartitionById(parts, "part").sortWithinPartitions(*order)
    manifest = written(files.mapInArrow(_files(folder), "part bigint, path string, documents bigint, ids bigint"), "files")
    shared.destroy()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    manifest = manifest.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of an open file: ids of documents, whether they are known, numbers of tokens, control and data bytes."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")
    while head := stream.read(struct.calcsize(HEAD)):
        n, controls, size = struct.unpack(HEAD, head)
        parts = [np.frombuffer(stream.read(k), kind) for k, kind in ((8 * n, "<i8"), (n, np.uint8), (8 * n, "<u8"), (controls, np.uint8), (size, np.uint8))]
        if len(parts[-1]) != size:
            raise ValueError("the file ends inside a block")
        yield tuple(parts)


def id_table(folder: str) -> np.ndarray:
    system, path = opened(folder)
    with system.open_input_stream(f"{path}/ids.tab") as stream:
        if stream.read(len(TABMAGIC)) != TABMAGIC:
            raise ValueError("not a table of token ids")
        (n,) = struct.unpack("<Q", stream.read(8))
        return np.frombuffer(stream.read(4 * n), "<u4")


def _read(folder: str, keep_ids: bool):
    names = ["doc_id", "start", "n_tokens", "ids" if keep_ids else "ids_crc32"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            for name, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                table = id_table(folder) if table is None else table
                system, path = opened(folder)
                with system.open_input_stream(f"{path}/{name}") as stream:
                    for docs, known, sizes, control, data in blocks(stream):
                        ids, sizes = table[decoded(control, data)], sizes.astype(np.int64)
                        at = np.cumsum(-(-sizes // 4) * 4) - -(-sizes // 4) * 4
                        own = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), sizes.tolist())]
                        starts = first + np.cumsum(sizes) - sizes
                        first += int(sizes.sum())
                        last = pa.array(own, pa.binary()) if keep_ids else pa.array([zlib.crc32(x) for x in own], pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(docs, mask=known == 0), pa.array(starts), pa.array(sizes), last], names)

    return run


def read(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and the ids (u32, little-endian) of every document in the folder, or the checksum of its ids."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", "path", "first")
    files = manifest.count()
    last = "ids binary" if keep_ids else "ids_crc32 bigint"
    return manifest.repartitionByRange(max(1, files), "part").mapInArrow(_read(folder, keep_ids), f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the documents to a new folder beside the shared intermediates, and read start, tokens and checksums back."""
    folder = scratch_path(documents.sparkSession, "token-files")
    write(documents, folder, tokenizer, end_id)
    return read(documents.sparkSession, folder, keep_ids=False)
