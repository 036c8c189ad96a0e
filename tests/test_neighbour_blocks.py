import tracemalloc

import numpy as np

from riskweft.operators import knn


def test_one_matrix_for_the_pairs_of_a_bounded_search():
    """Exact neighbours; beside the product of a box with many, no other matrix of all their pairs is made."""
    rng = np.random.default_rng(3)
    others, points = np.round(rng.normal(size=(6000, 4)), 2) + 50, np.round(rng.normal(size=(250, 4)), 2) + 50
    ids = np.arange(6000)[::-1].copy()
    d = ((points[:, None, :] - others[None, :, :]) ** 2)
    d = ((d[:, :, 0] + d[:, :, 1]) + d[:, :, 2]) + d[:, :, 3]
    order = np.array([np.lexsort((ids, row))[:5] for row in d])
    expected = np.take_along_axis(d, order, axis=1)
    for bound in (np.full(250, np.inf), expected[:, -1] + 4.0):
        tracemalloc.start()
        best, near = knn._nearest(points, np.arange(250) + 10_000, others, ids, 5, 256, False, bound)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert near.tolist() == ids[order].tolist() and best.tolist() == expected.tolist()
    matrix = 8 * len(points) * knn.BOXES_AT_ONCE * 256
    assert peak < 2.5 * matrix
