import random

import numpy as np

from riskweft.llm import minhash
from tests.llm import helpers as H
from tests.llm.test_similarity_operators import varied


def crowded() -> list[tuple[int, str]]:
    """Texts that share buckets but lie under the threshold, nearly all, and twenty pairs among them that lie above it."""
    rng = random.Random(9)
    base = [f"g{k}" for k in range(300)]
    rows = [(k * 7 % 421, varied(rng, base, 5)) for k in range(300)]
    return rows + [((300 + k) * 7 % 421, varied(rng, rows[100 + k][1].split(), 1)) for k in range(20)]


def test_minhash_finds_every_link_of_a_crowded_group(spark):
    rows = crowded()
    want = H.near_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in minhash.mark(H.docs_frame(spark, rows)).collect()}
    assert got == want and len(set(want.values())) > 100


def test_similar_pairs_of_two_blocks_equal_plain_jaccard(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in rng.integers(1, 30, 24)]
    docs, component = rng.permutation(24), rng.integers(0, 5, 24)
    for side in (np.zeros(24, int), np.repeat([0, 1], 12)):
        found = set(zip(*[c.tolist() for c in minhash._similar(docs, component, side, sets, 0.3)]))
        want = set()
        for i in range(24):
            for j in range(24):
                apart = side[i] < side[j] if side[-1] else i < j
                if apart and component[i] != component[j] and minhash.jaccard(sets[i], sets[j]) >= 0.3:
                    want.add((int(min(docs[i], docs[j])), int(max(docs[i], docs[j])), minhash.jaccard(sets[i], sets[j])))
        assert found == want and want
