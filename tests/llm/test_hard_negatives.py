"""Hard negatives against a plain version that searches every window by itself."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.llm import negatives, queries
from tests.llm import helpers as H

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, positives=5, per=5):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (i, v, label) in enumerate(good):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, kind, b) for b, (j, w, kind) in enumerate(good) if len(w) == len(v)]
        best = sorted(x for x in scored if x[2] == label and x[3] != a)[:positives]
        for p, j, _, _ in best:
            fit = sorted((n, m) for n, m, kind, _ in scored if kind != label and 80 * -p <= 100 * -n <= 100 * -p)
            out += [(i, j, k + 1, m, -p, -n) for k, (n, m) in enumerate(fit[:per])]
    return out


@pytest.fixture(scope="module")
def hard_rows():
    rng = random.Random(8)
    middle = [rng.gauss(0, 1) for _ in range(6)]
    near = lambda s: [x + rng.gauss(0, s) for x in middle]
    rows = [(k, near(rng.choice([0.05, 0.2, 1.0])), rng.choice([0, 0, 1, 2])) for k in range(600)]
    rows += [(k, middle, 1) for k in range(600, 800)]  # many rows share one vector
    rows += [(900, middle, 1), (900, middle, 1), (900, near(0.1), 1), (900, middle, 2), (901, middle, 2), (901, middle, 2)]
    rows += [(1000, None, 1), (1100, middle, None), (None, middle, 1), (1200, [None] + middle[1:], 1), (1300, [float("nan")] * 6, 1)]
    rows += [(1400, [float("inf")] + middle[1:], 1), (1500, [], 1), (1501, [], 1), (1502, [], 2), (1600, [-x for x in middle], 3), (1601, middle, 3)]
    rows += [(1700, [0.5, 0.5], 4), (1701, [0.5, 0.4], 4), (1702, [0.5, 0.45], 5), (-100, near(0.1), 2), (1800, middle, 6)]
    return rows


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return [tuple(r) for r in negatives.mine(df.withColumn("label", label), F.col("vec_id") % 100 == 0).collect()]


def test_hard_negatives_equal_plain_version(spark, hard_rows, monkeypatch):
    df = spark.createDataFrame(hard_rows, SCHEMA).withColumn("anchor", F.lit("x")).withColumn("score", F.lit(1)).repartition(5)
    want = plain(hard_rows)
    assert len(want) > 100
    assert H.ordered(mined(df)) == H.ordered(want)
    # Small blocks, tiles and held tables give the same rows.
    for name, value in {"BLOCK_ANCHORS": 4, "TILE_ROWS": 16, "TILE_ANCHORS": 3, "HELD": 50}.items():
        monkeypatch.setattr(negatives, name, value)
    assert H.ordered(mined(df)) == H.ordered(want)


def test_large_components_are_exact(spark):
    big = [(0, [2.0**60, 2.0**60], 0), (1, [2.0**40, -(2.0**40)], 0), (2, [2.0**55, 1.0], 1), (100, [3e38, 3e38], 0), (101, [1e38, 1e38], 2), (102, [1.0, 1.0], 0)]
    got = mined(spark.createDataFrame(big, SCHEMA))
    assert got and all(-(2**63) <= r[5] <= r[4] <= 2**63 - 1 for r in got)
    a, b = np.array([[3.0**30, 1.0]]), np.array([[3.0**30, -1.0]])
    assert negatives.products(negatives.whole(a), negatives.whole(b))[0, 0] == 2**63 - 1
    small = negatives.products(negatives.whole(a / 3.0**17), negatives.whole(b / 3.0**17))[0, 0]
    assert small == math.floor(256 * 3.0**30 / 3.0**17) ** 2 + math.floor(256 / 3.0**17) * math.floor(-256 / 3.0**17)


def test_empty_table_and_no_anchor(spark):
    empty = negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0)
    assert empty.count() == 0 and [f"{f.name} {f.dataType.simpleString()}" for f in empty.schema] == negatives.RESULT.split(", ")
    assert mined(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)) == []


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = [tuple(r) for r in queries.QUERIES["op12_hard_negatives"](spark, sf).collect()]
    assert H.ordered(got) == H.ordered(plain(rows))
