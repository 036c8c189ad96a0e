"""Prefix trie of conversations, with subtree totals by depth bands.

A node is a sequence of turns (role, text) that some conversation begins with. Its key is the sum of its turns' codes, each times a
power of an odd base (two lanes of 64 bits, the codes are xxHash of the turn), so that keys of a spliced sequence follow from those
of its parts.

1. ``prefixes``: rows are range-partitioned by conversation and turn and hashed within their partition; a conversation that
   reaches over several partitions gets what the ones before it hold, from a table of at most one row for each border.
   So a conversation of any length is spread over tasks.
2. ``spliced``: the first turns of one conversation before the later turns of another, from the heads of the two
   conversations (a bounded number of turns).
3. ``trie``: nodes are groups of equal keys. For subtree totals the depths are cut into bands of ``BAND`` levels. Every node explodes
   to its ancestors within its band alone. Totals of band roots become complete first, in a trie of the band roots, which is a
   ``BAND``-th as deep and is handled alike; then each band root's total goes to its ancestors in the band above. So there
   are as many rounds as the depth has digits to the base ``BAND``, and a row explodes to at most ``BAND`` rows in each.

Nulls and ties: rows without conversation id take no part; a null turn comes first; null role and text are empty; turns of
equal number are ordered by role and text, repeated rows are turns of their own; conversations without turns end at the root;
texts of any length are hashed whole. An empty table gives no rows. Only conv_id, turn, role and text are read, so other columns
don't matter.

The key of a node is 128 bits, so two different nodes among 10**12 share one with a probability of about 10**-15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import tidy, written

#: Levels of a band.
BAND = 8
#: Odd bases of the two lanes.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
#: Conversation ids that are joined to one run of text.
RUN_IDS = 10_000
#: A key with more than this share of the rows is answered by a broadcast, so there are fewer such keys.
HOT_SHARE = 2000
PREFIX = "conv_id bigint, pos bigint, x bigint, y bigint, cx bigint, cy bigint, bytes bigint"
STEP = "conv_id bigint, depth bigint, x bigint, y bigint, px bigint, py bigint, bytes bigint"
SPLICE = ["x", "y", "cx", "cy", "off_x", "off_y", "before_x", "before_y"]
KEY = ["depth", "x", "y"]


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2**64, for negative exponents as well (an odd base has an inverse)."""
    out = np.ones(len(exponents), np.uint64)
    left = np.abs(exponents).astype(np.uint64)
    bases = np.where(exponents < 0, np.uint64(pow(base, -1, 1 << 64)), np.uint64(base))
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] *= bases[odd]
        bases *= bases
        left >>= np.uint64(1)
    return out


def _codes(role: bytes, text: bytes) -> tuple[int, int]:
    """Two codes of a turn; the role's length keeps role and text apart."""
    own = b"%d %b%b" % (len(role), role, text)
    return xxhash.xxh3_64_intdigest(own), xxhash.xxh64_intdigest(own, 1)


def _lanes(batch: pa.RecordBatch, names: tuple[str, str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in names]


@tidy
def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and key of every turn, counted within the partition; rows come by conversation and turn."""
    conv, pos, x, y, scale = None, 0, 0, 0, [1, 1]
    part, mask = TaskContext.get().partitionId(), (1 << 64) - 1
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for own, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role"), batch.column("text")):
            if own != conv:
                conv, pos, x, y, scale = own, 0, 0, 0, [1, 1]
            pos, scale = pos + 1, [s * b & mask for s, b in zip(scale, BASES)]
            text = text.as_py()
            a, b = _codes(role.as_py(), text)
            x, y = (x + a * scale[0]) & mask, (y + b * scale[1]) & mask
            for column, value in zip(out, (pos, x, y, a, b, len(text))):
                column.append(value)
        lanes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[1:5]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(out[0], pa.int64()), *lanes, pa.array(out[5], pa.int64()), pa.array([part] * len(out[0]), pa.int64())],
            [*_names(PREFIX), "part"],
        )


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


@tidy
def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of spliced rows: what is before them, and their own key without its first part (``off``) at another place (``by``)."""
    for batch in batches:
        by, pos = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("by", "pos"))
        depth = pos + by
        keys, parents = [], []
        for base, lane in zip(BASES, ("x", "y")):
            x, off, before, code = _lanes(batch, (lane, f"off_{lane}", f"before_{lane}", f"c{lane}"))
            key = before + (x - off) * powers(base, by)
            keys.append(key)
            parents.append(key - code * powers(base, depth))
        lanes = [pa.array(v.view(np.int64)) for v in (*keys, *parents)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(depth), *lanes, batch.column("bytes")], _names(STEP))


def _shifted(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "pos", "by", *SPLICE, "bytes").mapInArrow(_shift, STEP)


def matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table that has each key once. Keys with more than 1/HOT_SHARE of the rows are answered by a broadcast of their rows."""
    spark, total = left.sparkSession, left.count()
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter(F.col("n") > max(1, total / HOT_SHARE)).select(*keys).collect()  # fewer than HOT_SHARE rows
    if not hot:
        return left.join(right, keys, "left")
    names = F.broadcast(spark.createDataFrame(hot, left.select(*keys).schema))
    few = F.broadcast(right.join(names, keys, "left_semi"))
    cold = left.join(names, keys, "left_anti").join(right, keys, "left")
    return cold.unionByName(left.join(names, keys, "left_semi").join(few, keys, "left"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key (x, y) of the turns so far, codes (cx, cy) and text bytes of every turn."""
    spark = conversations.sparkSession
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).cast("binary").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).dropna(subset=["conv_id"])
    # The row's number parts repeated rows of one conversation, however many.
    order = ["conv_id", "turn", "role", "text"]
    sorted_turns = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row").sortWithinPartitions(*order)
    local = written(sorted_turns.mapInArrow(_hash, f"{PREFIX}, part bigint"), "turns")
    cut = local.groupBy("conv_id").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("conv_id")
    # At most one conversation crosses each border of partitions, so there are fewer than twice as many rows as partitions.
    pieces = local.join(F.broadcast(cut), "conv_id").groupBy("conv_id", "part").agg(F.max_by(F.struct("pos", "x", "y"), "pos").alias("last")).collect()
    before, held = [], {}
    for conv, part, (n, x, y) in sorted(pieces):
        pos, a, b = held.get(conv, (0, 0, 0))
        if pos:
            before.append((conv, part, pos, _signed(a), _signed(b)))
        held[conv] = pos + n, a + x * pow(BASES[0], pos, 2**64), b + y * pow(BASES[1], pos, 2**64)
    if not before:
        return local.drop("part")
    carry = F.broadcast(spark.createDataFrame(before, "conv_id bigint, part bigint, by bigint, before_x bigint, before_y bigint"))
    joined = local.join(carry, ["conv_id", "part"], "left").na.fill(0, ["by", "before_x", "before_y"])
    moved = joined.withColumns({"off_x": F.lit(0).cast("long"), "off_y": F.lit(0).cast("long")})
    return written(moved.select("conv_id", "pos", "by", *SPLICE, "bytes").mapInArrow(_move, PREFIX), "prefixes")


def _signed(x: int) -> int:
    x %= 2**64
    return x - 2**64 if x >= 2**63 else x


@tidy
def _move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of conversations that began in another partition."""
    for batch in batches:
        moved = next(_shift.__wrapped__(iter([batch])))
        columns = [moved.column(c) for c in ("conv_id", "depth", "x", "y")] + [batch.column(c) for c in ("cx", "cy", "bytes")]
        yield pa.RecordBatch.from_arrays(columns, _names(PREFIX))


def spliced(turns: DataFrame, source: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation's first ``heads`` turns replaced by those of the conversation ``source``.

    ``source`` and ``heads`` are expressions of conv_id, ``heads`` at most ``most``. Returns the steps (conv_id, depth, key, parent's
    key, bytes; the root is depth 0) and the ends (conv_id, depth, key) of the conversations.
    """
    first = F.sort_array(F.collect_list(F.when(F.col("pos") <= most, F.struct("pos", "x", "y", "cx", "cy", "bytes"))))
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n"), F.max_by(F.struct("x", "y"), "pos").alias("last"), first.alias("own"))
    own = written(own.withColumns({"source": source.cast("long"), "heads": heads.cast("long")}), "conversations")
    theirs = own.select(F.col("conv_id").alias("source"), F.col("own").alias("theirs"), F.col("n").alias("their_n"))
    both = matched(own, theirs, ["source"])
    taken = F.least("heads", F.coalesce("their_n", F.lit(0)))
    zero = F.lit(0).cast("long")

    def lane(turns: str, at: Column, name: str) -> Column:
        return F.coalesce(F.get(turns, (at - 1).cast("int"))[name], zero)

    table = both.select(
        "conv_id", "n", "last", "heads", taken.alias("taken"), F.slice(F.coalesce("theirs", F.array()), F.lit(1), taken.cast("int")).alias("theirs"),
        *[lane("theirs", taken, c).alias(f"before_{c}") for c in "xy"], *[lane("own", F.col("heads"), c).alias(f"off_{c}") for c in "xy"],
    )
    table = written(table, "splices")
    none = {c: zero for c in ("by", "off_x", "off_y", "before_x", "before_y")}
    names = ["conv_id", "pos", "by", *SPLICE, "bytes"]
    root = table.select("conv_id").withColumns(none | {c: zero for c in ("pos", "x", "y", "cx", "cy", "bytes")}).select(*names)
    front = table.select("conv_id", F.inline("theirs")).withColumns(none).select(*names)
    by = F.col("taken") - F.col("heads")
    later = matched(turns, table.select("conv_id", "heads", by.alias("by"), "before_x", "before_y", "off_x", "off_y"), ["conv_id"])
    later = later.filter(F.col("pos") > F.col("heads")).select(*names)
    steps = written(_shifted(root.unionByName(front).unionByName(later)), "steps")
    longer = F.col("n") > F.col("heads")
    ends = table.withColumns({"by": by, "cx": zero, "cy": zero, "bytes": zero, "pos": F.greatest("n", "heads")})
    ends = ends.withColumns({c: F.when(longer, F.col("last")[c]).otherwise(F.col(f"off_{c}")) for c in "xy"})
    return steps, _shifted(ends).select("conv_id", *KEY)


def totals(steps: DataFrame, nodes: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """Sums of the values over the subtree of every node: depth, x, y and the values.

    ``nodes`` name a conversation that goes through them (conv_id), ``steps`` (conv_id, depth, x, y) are the conversations' paths.
    """
    of = F.floor(F.col("depth") / band)
    path = F.sort_array(F.collect_list(F.struct("depth", "x", "y"))).alias("path")  # at most ``band`` steps
    paths = written(steps.groupBy("conv_id", of.alias("band")).agg(path), "paths")
    sums = [F.sum(v).alias(v) for v in values]

    def exploded(rows: DataFrame, wanted) -> DataFrame:
        above = rows.withColumnsRenamed({c: f"own_{c}" for c in KEY}).join(paths, ["conv_id", "band"])
        return above.select(F.inline(F.filter("path", wanted)), *values).groupBy(*KEY).agg(*sums)

    inside = exploded(nodes.withColumn("band", of), lambda p: p["depth"] <= F.col("own_depth"))
    inside = written(inside.join(nodes.select(*KEY, "conv_id"), KEY), "bands")
    if nodes.agg(F.max("depth")).first()[0] < band:
        return inside.select(*KEY, *values)
    scaled = {"depth": of}
    at_root = F.col("depth") % band == 0
    roots = inside.filter(at_root).withColumns(scaled)
    complete = written(totals(steps.filter(at_root).withColumns(scaled), roots, values, band), "roots")
    given = complete.join(roots.select(*KEY, "conv_id"), KEY).filter("depth > 0").withColumn("band", F.col("depth") - 1)
    given = exploded(given, lambda p: p["depth"] % band != 0)
    rest = inside.filter(~at_root).select(*KEY, *values).unionByName(given).groupBy(*KEY).agg(*sums)
    return rest.unionByName(complete.withColumn("depth", F.col("depth") * band))


@tidy
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversation ids of a node as text, cut into runs."""
    key, first, ids = None, None, []
    for batch in batches:
        out: list[tuple] = []
        for *own, conv in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id")]):
            if own != key or len(ids) >= RUN_IDS:
                if ids:
                    out.append((*key, first, ",".join(ids)))
                key, first, ids = own, conv, []
            ids.append(str(conv))
        yield from _run_batch(out)
    if ids:
        yield from _run_batch([(*key, first, ",".join(ids))])


def _run_batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], [*KEY, "first", "ids"])


@tidy
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the runs of every node, in order; only the state of the hash is held."""
    key, state = None, None

    def row(key: list, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in key], pa.array([state.hexdigest()])], [*KEY, "ends_sha256"])

    for batch in batches:
        done: list = []
        for *own, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
            if own != key:
                if key is not None:
                    done.append(row(key, state))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if key is not None:
        yield row(key, state)


def end_digests(ends: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that end at a node, joined by commas."""
    order = ["x", "y", "depth", "conv_id"]
    schema = "depth bigint, x bigint, y bigint, "
    runs = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, schema + "first bigint, ids string")
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, schema + "ends_sha256 string")


def trie(steps: DataFrame, ends: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes = steps.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.min(c).alias(c) for c in ("px", "py", "bytes")]
    )
    nodes = written(nodes, "nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = nodes.filter("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, KEY, "left").na.fill(0, ["n_children"])
    nodes = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = written(nodes, "children")
    if not nodes.head(1):
        whole = nodes.select(*KEY, "n_leaves", "saved_tokens")
    else:
        whole = totals(steps.select("conv_id", *KEY), nodes.select("conv_id", *KEY, "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], band)
    above = nodes.select(F.col("depth").alias("up"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    own = nodes.select(*KEY, "conv_id", "n_convs", "n_children", (F.col("depth") - 1).alias("up"), "px", "py")
    named = matched(own, above, ["up", "px", "py"])
    found = named.join(whole, KEY).join(end_digests(ends), KEY, "left")
    none = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return found.select(*[F.col(c).cast("long").alias(c) for c in columns], F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def rebuilt(conversations: DataFrame, source: Column, heads: Column, most: int, band: int = BAND) -> DataFrame:
    """The trie of the spliced conversations."""
    return trie(*spliced(prefixes(conversations), source, heads, most), band)
