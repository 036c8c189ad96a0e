"""MinHash near-dedup with DartMinHash signatures.

Two documents are linked when the sets of their shingles (five consecutive words; a shorter text is one shingle) have a Jaccard
similarity of at least 0.8. Words are runs between ASCII white space, A-Z lower-cased.

DartMinHash throws darts into the plane of weight and rank of each element: a Poisson number in every cell, with place, rank and
coordinate from hashes of element and dart, so that the same darts hit the same element in every document. A dart counts if it
lies below the element's weight. Cells of rank double in width and are opened from below until a document has so many darts that
nearly every coordinate is hit; a document with an empty coordinate opens the next cell. The earliest dart of each coordinate is
the signature; the chance that two signatures agree there is the (weighted) Jaccard similarity.

1. Texts with equal words are one copy class, found by a grouped minimum; one document of each class goes on.
2. Signatures are cut into bands. Each bucket of equal bands links its members to its smallest document; distinct pairs are
   verified exactly and joined into components. A bucket of any size gives one pair for each member.
3. Buckets that still hold several components may hide links between members that are not the smallest. All their pairs of members
   of different components are compared exactly: the members of the bucket's largest component and the others are dealt in blocks, each
   block of others meets every block, and a task counts common shingles of two blocks with a product of matrices. Rows follow the
   members and the blocks of others, never the pairs.
4. Verification deals the members of a head in blocks; the head's shingles are sent once for each block.

A pair at the threshold shares no bucket with a probability of (1 - 0.8**4)**16 = 0.02 %.

Nulls and ties: texts that are null or without words, and documents without id, link with nothing and are kept; equal texts are
one class; rows that share an id are one node with the text whose word hash is smallest, and all get the smallest class among
them; an empty table gives no rows. Other columns
are kept by ``mark``, whatever their names; class_id and kept come last and replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import Rolling, WordCodes, mixed, packed, slices, tidy, written
from riskweft.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
#: Width of the first cell of rank, and cells at most: the last one ends at 2**20.
FIRST_CELL, CELLS = 0.125, 24
#: Members of a head, or of an open bucket, that are verified as one block.
BLOCK = 256
#: Shingles that are columns of a matrix at once.
COLUMNS = 4096
#: Documents whose ids are broadcast to their texts; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _poisson(mean: float) -> np.ndarray:
    """Distribution function of a Poisson number, as far as double precision tells it from 1."""
    n = int(mean + 12 * math.sqrt(mean) + 30)
    logs = np.arange(1, n) * math.log(mean) - np.cumsum(np.log(np.arange(1, n))) - mean
    return np.cumsum(np.concatenate(([math.exp(-mean)], np.exp(logs))))


class Darts:
    """Signatures of weighted sets; ``size`` coordinates."""

    def __init__(self, size: int):
        self.size, self.wanted = size, size * (math.log(size) + 4)
        self.low = [0.0] + [FIRST_CELL * 2.0**c for c in range(CELLS - 1)]
        self.high = [FIRST_CELL * 2.0**c for c in range(CELLS)]
        self.counts: dict[int, np.ndarray] = {}

    def _throw(self, cell: int, elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
        # One unit of weight at a time: an element of weight 2.5 has the units 0, 1 and half of 2.
        units = np.maximum(np.ceil(weights), 1).astype(np.int64)
        at = np.repeat(np.arange(len(elements)), units)
        unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
        salt = np.uint64((cell + 1) * 0x9E3779B97F4A7C15 % 2**64)
        seed = mixed(elements[at] + salt + unit.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        if cell not in self.counts:
            self.counts[cell] = _poisson(self.high[cell] - self.low[cell])
        n = np.searchsorted(self.counts[cell], (mixed(seed) >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
        some = np.repeat(np.arange(len(at)), n)
        which = (np.arange(len(some)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
        dart = mixed(seed[some] + (which + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))
        place = mixed(dart + np.uint64(0x9FB21C651E98DF25))
        hits = unit[some] + (place >> np.uint64(11)).astype(np.float64) * 2.0**-53 < weights[at[some]]
        dart, place, at = dart[hits], place[hits], at[some[hits]]
        rank = self.low[cell] + (self.high[cell] - self.low[cell]) * (dart >> np.uint64(11)).astype(np.float64) * 2.0**-53
        # Positive floats keep their order as integers, so rank and dart fit one number whose minimum is the earliest dart.
        packed = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (mixed(dart) & np.uint64(0xFFFFFFFF))
        np.minimum.at(out.reshape(-1), owner[at] * self.size + ((place >> np.uint64(3)) % np.uint64(self.size)).astype(np.int64), packed)

    def signatures(self, elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One row of ``size`` numbers for each set; sets follow one another, each with ``sizes`` elements."""
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        out = np.full((len(sizes), self.size), none, np.uint64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        total = np.bincount(owner, weights, len(sizes))
        reach = self.wanted / np.maximum(total, 1e-300)
        for cell in range(CELLS):
            going = (total > 0) & ((self.low[cell] < reach) | (out == none).any(axis=1))
            own = going[owner]
            if own.any():
                self._throw(cell, elements[own], weights[own], owner[own], out)
        return out


class Shingles:
    """Sorted distinct shingle hashes of a text, and the hash of all its words."""

    def __init__(self, width: int):
        self.width, self.codes, self.roll = width, WordCodes(), Rolling()

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, bytes | None]:
        words = self.codes.array((text or b"").lower().split())
        if not len(words):
            return words, None
        n = min(self.width, len(words))
        mark = self.roll.windows(words, len(words)).tobytes() + self.roll.windows(mixed(words), len(words)).tobytes()
        return np.unique(self.roll.windows(words, n)), mark


def _sketch(bands: int, rows: int, width: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, darts = Shingles(width), Darts(bands * rows)
        for batch in batches:
            marks, keys = [], []
            for _, run_of in slices(batch.column("text")):
                own = [shingles(text) for text in run_of]
                sizes = np.array([len(s) for s, _ in own])
                elements = np.concatenate([s for s, _ in own])
                signs = mixed(darts.signatures(elements, np.ones(len(elements)), sizes))
                marks += [mark for _, mark in own]
                bands_of = np.zeros((len(own), bands), np.uint64)
                for r in range(rows):
                    bands_of = mixed(bands_of + signs[:, r::rows] + np.arange(1, bands + 1, dtype=np.uint64))
                keys += list(bands_of.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "mark", "bands"]
            )

    return run


def _set_rows(width: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            own = [shingles(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([m for _, m in own], pa.binary()), pa.array([s.tobytes() for s, _ in own], pa.binary())],
                ["doc_id", "mark", "shingles"],
            )

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


@tidy
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by head and block: first the head (``doc`` is null), then the members that are compared with it."""
    head: np.ndarray | None = None
    for batch in batches:
        out: list[list] = [[], [], []]
        sets = batch.column("shingles")
        for k, (a, b) in enumerate(zip(batch.column("head").to_pylist(), batch.column("doc").to_pylist())):
            own = np.frombuffer(sets[k].as_buffer(), np.uint64)
            if b is None:
                head = own.copy()
                continue
            for column, value in zip(out, (a, b, jaccard(head, own))):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "similarity"])


def shingle_sets(texts: DataFrame, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """doc and shingles of the documents in ``docs``. Their ids are broadcast if they are counted to be few, else joined by a shuffle."""
    some = docs.select(F.col("doc").alias("doc_id")).distinct()
    some = F.broadcast(some) if some.count() <= BROADCAST_IDS else some
    sets = texts.join(some, "doc_id", "left_semi").mapInArrow(_set_rows(width), "doc_id bigint, mark binary, shingles binary")
    sets = written(sets, "shingles").join(nodes, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id"])
    return written(sets.select(F.col("doc_id").alias("doc"), "shingles"), "sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, similarity) among the pairs (head, doc)."""
    sizes = pairs.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = pairs.join(sizes, "head").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")).join(sets, "doc")
    heads = sizes.join(sets.withColumnRenamed("doc", "head"), "head").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    none = F.lit(None).cast("bigint").alias("doc")
    rows = members.select("head", "block", "doc", "shingles").union(heads.select("head", "block", none, "shingles"))
    rows = rows.repartition("head", "block").sortWithinPartitions("head", "block", F.col("doc").asc_nulls_first())
    return rows.mapInArrow(_verify, "a bigint, b bigint, similarity double").filter(F.col("similarity") >= threshold)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each left and each right set."""
    sides = [np.concatenate(s) for s in (left, right)]
    shared = np.intersect1d(*sides)
    counts = np.zeros((len(left), len(right)))
    for start in range(0, len(shared), COLUMNS):
        some, parts = shared[start : start + COLUMNS], []
        for sets, values in zip((left, right), sides):
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            at = np.minimum(np.searchsorted(some, values), len(some) - 1)
            hit = some[at] == values
            part = np.zeros((len(sets), len(some)), np.float32)
            part[owner[hit], at[hit]] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts


def _similar(docs: np.ndarray, component: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, ...]:
    """Links (a, b, similarity) of members of different components: of both sides, or within the only one."""
    left = np.flatnonzero(side == side[0])
    right = np.flatnonzero(side != side[0]) if side[0] != side[-1] else left
    sizes = np.array([len(s) for s in sets])
    both = _common([sets[i] for i in left], [sets[i] for i in right])
    similarity = both / (sizes[left][:, None] + sizes[right][None, :] - both)
    i, j = np.nonzero((similarity >= threshold) & (component[left][:, None] != component[right][None, :]))
    a, b = docs[left[i]], docs[right[j]]
    return np.minimum(a, b), np.maximum(a, b), similarity[i, j]


def _compare(threshold: float):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by pair of blocks and side; a pair of blocks may go on in the next batch."""
        rest: pa.Table | None = None

        def links(rows: pa.Table) -> pa.RecordBatch:
            names = [rows.column(c).to_numpy() for c in ("key", "x", "y")]
            ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
            found = []
            for start, end in zip([0, *ends], [*ends, len(rows)]):
                part = rows.slice(start, end - start)
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in part.column("shingles")]
                found.append(_similar(*[part.column(c).to_numpy() for c in ("doc", "component", "side")], sets, threshold))
            columns = [pa.array(np.concatenate(c), kind) for c, kind in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "similarity"])

        for batch in batches:
            if len(batch):
                rows = pa.Table.from_batches([batch])
                rows = pa.concat_tables([rest, rows]) if rest is not None else rows
                names = [rows.column(c).to_numpy() for c in ("key", "x", "y")]
                last = np.flatnonzero(np.any([c != c[-1] for c in names], axis=0))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield links(rows.slice(0, cut))
                rest = rows.slice(cut).combine_chunks()
        if rest is not None:
            yield links(rest)

    return run


def hidden_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All links (a, b, similarity) between members (key, doc, component) of one bucket that are of different components."""
    by_component = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = by_component.groupBy("key").agg(F.count(F.lit(1)).alias("components"), F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"))
    blocks = [F.ceil(n / BLOCK).cast("int").alias(name) for n, name in ((F.col("most"), "mains"), (F.col("n") - F.col("most"), "others"))]
    opened = members.join(buckets.filter("components > 1").select("key", "main", *blocks), "key")
    # Blocks of others are numbered first; x < others always, and y is x or a later block.
    other = F.col("component") != F.col("main")
    block = F.when(other, F.pmod(F.xxhash64("doc"), F.col("others"))).otherwise(F.col("others") + F.pmod(F.xxhash64("doc"), F.col("mains"))).cast("int")
    opened = opened.withColumn("block", block)
    # A block of others is the left side with itself and all later blocks, and the right side with the earlier ones.
    later = F.transform(F.sequence(F.col("block"), F.col("others") + F.col("mains") - 1), lambda y: F.struct(F.col("block").alias("x"), y.alias("y"), F.lit(0).alias("side")))
    before = F.least("block", "others")
    earlier = F.transform(F.sequence(F.lit(0), before - 1), lambda x: F.struct(x.alias("x"), F.col("block").alias("y"), F.lit(1).alias("side")))
    none = F.array().cast("array<struct<x:int,y:int,side:int>>")
    places = F.concat(F.when(other, later).otherwise(none), F.when(before > 0, earlier).otherwise(none))
    rows = opened.select("key", "doc", "component", F.inline(places)).join(sets, "doc")
    rows = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side")
    columns = ["key", "x", "y", "side", "doc", "component", "shingles"]
    return rows.select(*columns).mapInArrow(_compare(threshold), "a bigint, b bigint, similarity double").dropDuplicates(["a", "b"])


def classes(
    documents: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """The classes (doc_id, class_id) of documents with words, and the verified links (a, b, similarity) between different texts."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).dropna()
    sketched = texts.mapInArrow(_sketch(bands, rows, shingle), "doc_id bigint, mark binary, bands array<bigint>")
    sketched = written(sketched.filter("mark is not null"), "sketches")
    copies = written(sketched.groupBy("mark").agg(F.min("doc_id").alias("first")), "copies")
    nodes = copies.groupBy(F.col("first").alias("doc_id")).agg(F.min("mark").alias("mark"))
    firsts = sketched.join(nodes, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id"])
    banded = firsts.select(F.col("doc_id").alias("doc"), F.posexplode("bands").alias("band", "value"))
    buckets = written(banded.select(F.xxhash64("band", "value").alias("key"), "doc"), "bands")
    heads = buckets.groupBy("key").agg(F.min("doc").alias("head"), F.max("doc").alias("tail")).filter("head < tail").select("key", "head")
    # Bucket members with others; the rows that later steps read.
    members = written(buckets.join(heads, "key"), "buckets")
    sets = shingle_sets(texts, members, nodes, shingle)
    tried = written(members.filter("doc <> head").select("head", "doc").distinct(), "pairs")
    links = written(verified(tried, sets, threshold), "links")
    labels = components(links, "a", "b")
    named = members.select("key", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    named = written(named.withColumn("component", F.coalesce("component", "doc")), "members")
    more = written(hidden_links(named, sets, threshold), "links")
    if more.head(1):
        links = links.union(more)
        labels = components(labels.select("node", "component").union(more.select("a", "b")), "node", "component")
    by_copy = copies.join(labels.withColumnRenamed("node", "first"), "first", "left").select("mark", F.coalesce("component", "first").alias("class_id"))
    return sketched.select("doc_id", "mark").join(by_copy, "mark").groupBy("doc_id").agg(F.min("class_id").alias("class_id")), links


def mark(documents: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """The documents with class_id (the smallest id of the class) and kept (whether the document stands for its class)."""
    found, _ = classes(documents, threshold, shingle)
    held = documents.drop("class_id", "kept")
    out = packed(held).join(found, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left")
    own = F.coalesce("class_id", F.col("row.doc_id").cast("long"))
    return out.select("row.*", own.alias("class_id"), F.coalesce(own == F.col("row.doc_id").cast("long"), F.lit(True)).alias("kept"))
