"""Near-duplicate operators against all-pairs versions."""

import random

import numpy as np

import corpus_pipeline
from riskweft.llm import components, embeddings, lines, minhash, queries
from tests.llm import helpers as H


def varied(rng, words, changes):
    out = list(words)
    for k in rng.sample(range(len(out)), changes):
        out[k] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(500, k) for k in range(501, 900)] + [(7, 899)]
    links = spark.createDataFrame(chain + hub + [(3, 3), (1000, 1001), (1001, 1000)], "a bigint, b bigint").repartition(7)
    found = {r["node"]: r["component"] for r in components.components(links, "a", "b").collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(500, 900)]} | {1000: 1000, 1001: 1000}
    assert found == want
    assert components.components(links.filter("a < 0"), "a", "b").count() == 0


def test_minhash_classes_equal_all_pairs(spark):
    rng = random.Random(2)
    rows, number = [], 0
    for _ in range(12):
        base = [f"t{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 5, 9])):
            # Some copies lie clearly above the threshold, some clearly below it.
            changes = rng.choice([0, 0, max(1, len(base) // 100), len(base) // 12]) if len(base) > 20 else 0
            rows.append((number * 7 % 1009, varied(rng, base, changes)))
            number += 1
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "a b"), (2004, "A  b"), (2005, "a b c"), (None, rows[0][1]), rows[3]]
    df = H.docs_frame(spark, rows).withColumnRenamed("source", "kept").repartition(6)
    out = minhash.mark(df)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "class_id", "kept"]
    want = H.near_classes(rows)
    got = [(r["doc_id"], r["class_id"], r["kept"]) for r in out.collect()]
    assert H.ordered(got) == H.ordered([(i, want.get(i), i is None or want[i] == i) for i, _ in rows])
    assert minhash.mark(H.docs_frame(spark, [])).count() == 0


def test_minhash_hidden_links_in_a_bucket(spark):
    # The smallest document is near none or few of the others, which are near one another.
    rng = random.Random(9)
    base = [f"u{k}" for k in range(300)]
    rows = [(1, varied(rng, base, 14))] + [(k, varied(rng, base, 6)) for k in range(2, 60)]
    want = H.near_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in minhash.mark(H.docs_frame(spark, rows)).collect()}
    assert got == want


def test_minhash_recall_in_a_crowded_group(spark):
    """Hundreds of texts that are near one another, most of them just under the threshold: links and classes against all pairs."""
    rng = random.Random(4)
    base = [f"u{k}" for k in range(300)]
    rows = [(k, varied(rng, base, rng.choice([4, 7, 9]))) for k in range(400)]
    want, sets = H.near_classes(rows), {i: H.shingles(t) for i, t in rows}
    got = {r["doc_id"]: r["class_id"] for r in minhash.mark(H.docs_frame(spark, rows)).collect()}
    pairs = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) > 300 and len(set(want.values())) > 1
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.9 * len(pairs)  # links that lie in one class
    assert all(want[i] == want[j] for i, j in got.items())  # no class holds two
    assert sum(got[i] == want[i] for i in want) >= 0.9 * len(want)


def test_minhash_pairs_follow_the_members(spark, monkeypatch):
    """Pairs that are verified grow with the members of a group, not with their square."""
    seen, plain = [], minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    counts = []
    for n in (100, 400):
        rng, base = random.Random(6), [f"u{k}" for k in range(300)]
        seen.clear()
        minhash.classes(H.docs_frame(spark, [(k, varied(rng, base, 12)) for k in range(n)]))
        counts.append(max(seen))
    assert counts[1] < 8 * counts[0]


def test_minhash_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = H.near_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op8_minhash"](spark, sf).collect()}
    assert got == want


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    elements = rng.integers(1, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
    darts = minhash.Darts(2048)
    sign = darts.signatures(np.concatenate([elements, elements]), np.concatenate([a, b]), np.array([300, 300]))
    assert (sign != np.uint64(2**64 - 1)).all()
    assert abs((sign[0] == sign[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_line_dedup_equals_plain_version(spark, sf):
    rng = random.Random(8)
    common = " ".join(f"c{x}" for x in "abcdefghijkl")
    rows = [(k, f"own line {'xyz'[k % 3]} {rng.random()}\n{common}\nshort one\n{common} user {'abcdefgh'[k % 8]} said so") for k in range(30)]
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, common + "\r\n" + common), (None, common), (3, common), (3, common), (-1, "w " * 30_000)]
    df = H.docs_frame(spark, rows).withColumnRenamed("lang", "n_lines").repartition(5)
    out = lines.dedup_lines(df)
    assert H.ordered(lines.digest(out).collect()) == H.ordered(H.line_dedup(rows))
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] is not None and r["n_removed"])
    # A round for each few templates of a leaf gives the same.
    many = lines.dedup_lines(df, room=1)
    assert H.ordered(lines.digest(many).collect()) == H.ordered(H.line_dedup(rows))
    assert lines.dedup_lines(H.docs_frame(spark, [])).count() == 0
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert H.ordered(queries.QUERIES["op10_line_dedup"](spark, sf).collect()) == H.ordered(H.line_dedup(table))


def test_line_templates_are_learned(spark):
    """Fields without digits, two of them, in quarters of their own, are found; lines of other leaves and unlike lines are not."""
    names = ["alice", "bob", "carol", "dave", "erin", "frank"]
    rows = [(k, f"Posted by {n} on Monday\nThe user {n} has left the room and will {n}ly return on monday") for k, n in enumerate(names)]
    rows += [(7, "Posted by alice in June"), (8, "Written by alice on Monday"), (9, "Posted by bob on Monday at noon")]
    out = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(H.docs_frame(spark, rows)).collect()}
    assert out == {0: 0, 1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 7: 0, 8: 0, 9: 0}


def test_hot_leaves_are_cut_and_merged(spark):
    """A leaf of far more lines than a part takes: templates with different fields in each line, and lines of their own."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = [(k, f"see the page of {word()} for more about this and that") for k in range(60)]
    rows += [(100 + k, "see the " + " ".join(word() for _ in range(9))) for k in range(60)]
    df = H.docs_frame(spark, rows).repartition(4)
    want = H.ordered(H.line_dedup(rows))
    for leaf_lines, room in ((20, 1000), (10, 12)):
        assert H.ordered(lines.digest(lines.dedup_lines(df, leaf_lines=leaf_lines, room=room)).collect()) == want


def test_line_dedup_of_short_lines(spark):
    rows = [
        (1, "Read more\nthis is the first text\n第3章\n今天天气很好我们去公园\n42"),
        (2, "Read more\nthis is the first text\n\n第3章"),
        (3, "Read  more\nanother text of its own\n第12章\n今天天气很好我们去公园\n43"),
        (4, "this is the first text\nShare"),
        (5, "Read more"),
        (6, "\n \n"),
    ]
    df = H.docs_frame(spark, rows).repartition(3)
    gone = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(df).collect()}
    assert gone[1] == (rows[0][1], 0) and gone[3] == ("another text of its own\n43", 3)
    assert gone[2] == ("", 3) and gone[4] == ("Share", 1) and gone[5] == ("", 1) and gone[6] == (rows[5][1], 0)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, df, "").collect()}
    assert left == {1: rows[0][1], 3: "another text of its own\n43", 4: "Share", 6: rows[5][1]}


def vectors(rng, groups):
    rows, number = [], 0
    for label, size, spread in groups:
        centre = rng.normal(size=16)
        for _ in range(size):
            rows.append((number, [float(x) for x in (centre + spread * rng.normal(size=16)).astype(np.float32)], label))
            number += 1
    return rows


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(6)
    rows = vectors(rng, [(1, 60, 0.05), (1, 40, 0.1), (2, 30, 0.05), (2, 90, 1.0), (3, 1, 0.0)])
    v = rows[0][1]
    n = len(rows)
    rows += [(n + k, v, 1) for k in range(20)] + [(n + 20, [2 * x for x in v], 1), (n + 21, v, 2), (n + 22, v, None), (n + 23, None, 1), (n + 24, [], 1)]
    rows += [(n + 25, [0.0] * 16, 1), (n + 26, [float("nan")] + v[1:], 1), (n + 27, [float("inf")] + v[1:], 1), (n + 28, [None] + v[1:], 1), (n + 29, v[:5], 1)]
    rows += [(n + 30, [-0.0] + [1.0] * 15, 3), (n + 31, [0.0] + [1.0] * 15, 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(5)
    want = H.ordered(H.cosine_classes(rows))
    assert H.ordered(embeddings.near_duplicates(df).collect()) == want
    # Many shards: every vector is searched in all of them.
    assert H.ordered(embeddings.near_duplicates(df, shard_rows=40).collect()) == want
    none = spark.createDataFrame([(None, v, 1), (5, v, 1), (5, v, 1)], df.schema)
    assert H.ordered(embeddings.near_duplicates(none).collect()) == H.ordered([(None, 0, None, True), (5, 1, 5, True), (5, 1, 5, True)])
    assert embeddings.near_duplicates(df.filter("vec_id < 0")).count() == 0


def test_vectors_that_share_an_id_are_separate(spark):
    rng = np.random.default_rng(8)
    v, w = (x.tolist() for x in rng.normal(size=(2, 16)))
    near = [x + 0.001 for x in v]
    rows = [(5, v, 1), (5, w, 1), (6, near, 1), (9, w, 1), (4, [-x for x in v], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    want = H.ordered([(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (9, 1, 5, False), (4, 0, 4, True)])
    for shard_rows in (8192, 2):
        assert H.ordered(embeddings.near_duplicates(df, shard_rows=shard_rows).collect()) == want


def test_graph_recall_is_measured(sf):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=64) + 0.02 * rng.normal(size=(k % 7 + 1, 64)) for k in range(300)])
    x = embeddings.unit(points)
    graph = embeddings.Graph(x)
    graph.audit(0.98, 4, True)
    exact = x @ x.T >= 0.98
    inside = dict(graph.within(x, 0.98, np.arange(len(x))))
    assert all(set(np.flatnonzero(exact[k])) == set(inside[k]) for k in range(len(x)))
    outside = dict(graph.within(x, 0.98))
    found = sum(len(set(outside[k]) & set(np.flatnonzero(exact[k]))) for k in range(len(x)))
    assert found >= 0.99 * exact.sum()
