import numpy as np
from pyspark.sql import functions as F

from riskweft.operators import knn


def _plain(left, right, k, exclude_self):
    rows = []
    for i, a in left:
        found = []
        for j, b in right:
            if a is None or b is None or None in a or None in b or (exclude_self and i == j):
                continue
            total = 0.0
            for x, y in zip(a, b):
                total += (x - y) * (x - y)
            if np.isfinite(total):
                found.append((total, j))
        rows += [(i, j, d, place) for place, (d, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(rows)


def test_neighbours_over_cells_with_ties_gaps_and_far_points(spark):
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 6, (250, 2)).astype(float)
    far = np.round(rng.exponential(1, (150, 2)) ** 4, 2) + 1e9
    rows = [(i, p) for i, p in enumerate(np.concatenate([grid, far]).tolist())]
    rows += [(400, None), (401, [None, 1.0]), (402, [float("nan"), 1.0]), (403, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    for block in (40, 10_000):
        near = knn.knn_join(df, df, 4, exclude_self=True, points_per_pivot=16, block_rows=block).collect()
        assert sorted((r["id"], r["neighbour"], r["distance_sq"], r["place"]) for r in near) == _plain(rows, rows, 4, True)


def test_few_candidates_and_none(spark):
    left = spark.range(300).select("id", F.array(F.col("id").cast("double"), F.lit(0.0)).alias("v"))
    few = left.filter("id < 3")
    assert knn.knn_join(left, few, 5, block_rows=2).count() == 900
    assert knn.knn_join(left, left.filter("id < 0"), 5).count() == 0


def test_work_for_a_point_does_not_follow_the_candidates(monkeypatch):
    pairs = []
    exact = knn._exact
    monkeypatch.setattr(knn, "_exact", lambda a, b: pairs.append(len(a)) or exact(a, b))
    for n in (4_000, 32_000):
        points = np.random.default_rng(n).normal(size=(n, 2))
        pairs.clear()
        knn._nearest(points, np.arange(n), points, np.arange(n), 5, 256, True, np.full(n, np.inf))
        assert sum(pairs) < 400 * n
