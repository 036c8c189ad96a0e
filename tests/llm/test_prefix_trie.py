"""The prefix trie against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from riskweft.llm import queries, trie
from tests.llm import helpers as H

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, heads=lambda c: zlib.crc32(str(c).encode()) % 9):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = heads(c)
        base = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    out = []
    for key, own in members.items():
        leaves = saved = 0
        todo = [key]
        while todo:
            node = todo.pop()
            leaves += node not in children
            saved += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
            todo += children.get(node, [])
        last = ",".join(map(str, sorted(ends.get(key, []))))
        parent = min(members[key[:-1]]) if key else None
        out.append((min(own), len(key), parent, len(own), len(children.get(key, [])), leaves, saved, hashlib.sha256(last.encode()).hexdigest()))
    return out


def built(df, band=trie.BAND):
    conv = F.col("conv_id")
    out = trie.rebuilt(df, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8, band)
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    return [tuple(r) for r in out.collect()]


@pytest.fixture(scope="module")
def hard_rows():
    rng = random.Random(5)
    turn = lambda k: (rng.choice(["user", "bot", None]), rng.choice(["a", "b", "ü", "", None]))
    rows = [(c, k, *turn(k)) for c in range(120) for k in range(rng.randrange(1, 14))]
    rows += [(c, 0, "user", "hello") for c in range(200, 260)]
    rows += [(c, 0, "us", "erhello") for c in range(260, 264)]
    rows += [(300, None, "user", "null first"), (300, None, "user", "null first"), (300, 1, "bot", "x"), (300, 1, "bot", "a"), (300, 1, None, "x")]
    rows += [(None, 1, "user", "no id"), (-7, 0, "user", "hello"), (-5, 0, "bot", "minus"), (-5, 1, "bot", "minus")]
    rows += [(405, k, "user", f"deep {k % 3}") for k in range(90)] + [(406, k, "user", f"deep {k % 3}") for k in range(80)]
    rows += [(500, 7, "user", "same row")] * 40 + [(505, 0, "user", "long " * 100_000)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_plain_version(spark, hard_rows):
    df = spark.createDataFrame(hard_rows, SCHEMA).withColumn("pos", F.lit("x")).withColumn("bytes", F.lit(None).cast("int")).repartition(7)
    want = H.ordered(plain(hard_rows))
    assert H.ordered(built(df)) == want
    assert H.ordered(built(df, band=3)) == want


def test_conversation_over_many_partitions(spark, monkeypatch):
    """One conversation holds nearly all rows: its rows lie in several partitions, and hot keys are answered by a broadcast."""
    rows = [(c, k, "user", f"{k % 7} of {c}") for c, n in ((0, 700), (3, 20), (10, 6), (11, 9)) for k in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = trie.prefixes(df)
        assert [c for c, _ in parts.dtypes] == trie._names(trie.PREFIX)
        assert sorted(r["pos"] for r in parts.filter("conv_id = 0").collect()) == list(range(1, 701))
        assert H.ordered(built(df, band=5)) == H.ordered(plain(rows))
        monkeypatch.setattr(trie, "HOT_SHARE", 1e9)
        assert H.ordered(built(df)) == H.ordered(plain(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_end_digests_in_runs(spark, monkeypatch):
    ends = spark.range(1000).select(F.col("id").alias("conv_id"), (F.col("id") % 3).alias("depth"), F.lit(5).cast("long").alias("x"), F.lit(6).cast("long").alias("y"))
    want = {d: hashlib.sha256(",".join(str(c) for c in range(1000) if c % 3 == d).encode()).hexdigest() for d in range(3)}
    assert {r["depth"]: r["ends_sha256"] for r in trie.end_digests(ends).collect()} == want
    monkeypatch.setattr(trie, "RUN_IDS", 7)
    assert {r["depth"]: r["ends_sha256"] for r in trie.end_digests(ends).collect()} == want


def test_bands_bound_the_explosion(spark):
    """A chain of n nodes explodes to at most band rows for each node in every round."""
    rows = [(0, k, "user", str(k)) for k in range(200)]
    got = built(spark.createDataFrame(rows, SCHEMA), band=4)
    assert H.ordered(got) == H.ordered(plain(rows))


def test_empty_and_turnless(spark):
    assert built(spark.createDataFrame([], SCHEMA)) == []
    assert built(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
    one = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(one, 1, "user", "only turn")]
    assert built(spark.createDataFrame(rows, SCHEMA)) == plain(rows) == [(one, 0, None, 1, 0, 1, 0, hashlib.sha256(str(one).encode()).hexdigest())]


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert H.ordered(queries.QUERIES["op13_prefix_trie"](spark, sf).collect()) == H.ordered(plain(rows))
