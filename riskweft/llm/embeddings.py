"""Embedding near-dedup: hierarchical navigable small-world graphs for each shard, verified cosines, connected components.

Vectors are compared only when their labels (and lengths) are equal. Two are linked when their cosine, in double precision, is
at least 0.98.

1. Equal vectors are collapsed by a grouped minimum, with their number; their cosine is 1. A vector that a third of all rows
   share is one row from there on.
2. Each label is cut into shards of about ``SHARD_ROWS`` vectors by a hash, so a hot label has many shards. A task builds the
   graph of one shard and audits it: exact neighbours, computed in blocks, are compared with what a search finds, and beam and
   margin are doubled until none is missing: for all nodes, which enter the graph at themselves, and for every
   ``AUDIT_EVERY``-th node as a stranger, which sets the beam for vectors of other shards. The graph is written with both.
3. Every vector is searched in every shard of its label: a block of ``SHARD_ROWS`` vectors meets one graph in a task. From the
   beam a search walks on through all nodes down to the threshold less the margin, so a group larger than the beam is found
   whole. Cosines are computed in double precision; the links of a block become counts and a spanning forest in the task.
4. Forests are joined into components.

Nulls and ties: vectors that are null, empty, zero or hold a null or non-finite component, and rows without label or id, link
with nothing and are kept; rows that share an id count as separate vectors, and the id is kept; an empty table gives no rows.
Other columns don't matter.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import mixed, written
from riskweft.llm.components import components

THRESHOLD = 0.98
SHARD_ROWS = 8192
AUDIT_EVERY = 1
#: A widened beam looks beyond nodes down to the threshold less this; audits double it.
FIRST_MARGIN = 0.02
#: Neighbours of a node on the upper layers; twice as many on the lowest.
DEGREE, BUILD_BEAM, FIRST_BEAM, FIRST_FAR = 12, 48, 32, 64
#: Nodes of a layer from which the next one is entered.
ENTRIES = 16
#: Vectors that are inserted or searched together.
BATCH = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, free of overflow."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


class Graph:
    """A navigable small-world graph with layers over unit vectors; searches run for many queries at once.

    A node's layer comes from a hash of its number, so the graph doesn't depend on chance. Layers hold arrays of neighbours,
    filled with -1.
    """

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM):
        n = len(vectors)
        self.vectors, self.degree, self.beam, self.far, self.margin = vectors, degree, FIRST_BEAM, FIRST_FAR, FIRST_MARGIN
        draw = (mixed(np.arange(n, dtype=np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        top = (-np.log(np.maximum(draw, 1e-300)) / math.log(degree)).astype(int)
        order = np.lexsort((np.arange(n), -top))  # nodes of high layers first: each layer is complete before it is used
        self.layers: list[np.ndarray] = []
        self.entry = int(order[0]) if n else -1
        for layer in range(int(top.max()) + 1 if n else 0):
            width = 2 * degree if layer == 0 else degree
            self.layers.append(np.full((n, width), -1, np.int32))
        done = np.zeros(n, bool)
        for layer in range(len(self.layers) - 1, -1, -1):
            members = order[top[order] >= layer]
            done[:] = False
            done[members[:1]] = True
            at = 1
            while at < len(members):
                # A batch is no larger than what stands already, so that its nodes have somewhere to go.
                part = members[at : at + min(BATCH, at)]
                starts = self._descend(vectors[part], layer) if layer + 1 < len(self.layers) else np.full((len(part), 1), members[0])
                starts = np.where(done[starts] & (starts >= 0), starts, -1)
                starts[:, 0] = np.where((starts < 0).all(axis=1), members[0], starts[:, 0])
                found, scores = self._search(vectors[part], starts, layer, beam)
                # Nodes of one batch can be neighbours, too.
                near = vectors[part] @ vectors[part].T
                np.fill_diagonal(near, -np.inf)
                own = np.broadcast_to(part, near.shape)
                self._connect(layer, part, np.concatenate([found, own], axis=1), np.concatenate([scores, near], axis=1))
                done[part] = True
                at += len(part)
        self._reverse()

    def _reverse(self) -> None:
        """Who links to each node on the lowest layer: pruning full nodes can leave a node that only links to others."""
        n = len(self.vectors)
        if not n:
            self.sources, self.places = np.zeros(0, np.int64), np.zeros(1, np.int64)
            return
        source, column = np.nonzero(self.layers[0] >= 0)
        target = self.layers[0][source, column]
        self.sources = source[np.argsort(target, kind="stable")]
        self.places = np.concatenate(([0], np.cumsum(np.bincount(target, minlength=n))))

    def _around(self, nodes: np.ndarray) -> np.ndarray:
        """Nodes that the given ones link to, or that link to them."""
        first, count = self.places[nodes], self.places[nodes + 1] - self.places[nodes]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        linked = self.layers[0][nodes]
        return np.unique(np.concatenate([linked[linked >= 0], self.sources[np.repeat(first, count) + inside]]))

    def state(self) -> bytes:
        return pickle.dumps((self.vectors, self.degree, self.beam, self.far, self.margin, self.layers, self.entry))

    @staticmethod
    def restored(state: bytes) -> Graph:
        graph = object.__new__(Graph)
        graph.vectors, graph.degree, graph.beam, graph.far, graph.margin, graph.layers, graph.entry = pickle.loads(state)
        graph._reverse()
        return graph

    def _descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """Walk from the top to the layer above the given one; the nearest nodes there, -1 where there are fewer."""
        at = np.full((len(queries), 1), self.entry)
        for upper in range(len(self.layers) - 1, layer, -1):
            at = self._search(queries, at, upper, ENTRIES)[0]
        return at

    def _search(self, queries: np.ndarray, starts: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam best nodes that a walk meets, best first; -1 with score -inf where there are fewer."""
        links, n, q = self.layers[layer], len(self.vectors), len(queries)
        seen = np.zeros((q, n), bool)
        rows = np.arange(q)
        nodes = np.full((q, beam), -1, np.int64)
        scores = np.full((q, beam), -np.inf)
        spent = np.ones((q, beam), bool)
        r, c = np.nonzero(starts[:, :beam] >= 0)
        nodes[r, c], spent[r, c] = starts[r, c], False
        scores[r, c] = np.einsum("ij,ij->i", queries[r], self.vectors[starts[r, c]])
        seen[r, starts[r, c]] = True
        active = rows
        while len(active):
            # Expand the best node of each beam that has one left.
            best = np.where(spent[active], -np.inf, scores[active]).argmax(axis=1)
            spent[active, best] = True
            new = links[nodes[active, best]].astype(np.int64)
            fresh = (new >= 0) & ~seen[active[:, None], new]
            r, c = np.nonzero(fresh)
            if len(r):
                ids = new[r, c]
                seen[active[r], ids] = True
                gained = np.full(new.shape, -np.inf)
                gained[r, c] = np.einsum("ij,ij->i", queries[active[r]], self.vectors[ids])
                all_scores = np.concatenate([scores[active], gained], axis=1)
                all_nodes = np.concatenate([nodes[active], np.where(fresh, new, -1)], axis=1)
                all_spent = np.concatenate([spent[active], ~fresh], axis=1)
                keep = np.argsort(-all_scores, axis=1, kind="stable")[:, :beam]
                scores[active] = np.take_along_axis(all_scores, keep, 1)
                nodes[active] = np.take_along_axis(all_nodes, keep, 1)
                spent[active] = np.take_along_axis(all_spent, keep, 1)
            active = active[~(spent[active] | (nodes[active] < 0)).all(axis=1)]
        return nodes, scores

    def _connect(self, layer: int, part: np.ndarray, found: np.ndarray, scores: np.ndarray) -> None:
        """Link new nodes to diverse near nodes and back; a full node keeps its diverse best."""
        width = self.layers[layer].shape[1]
        back: dict[int, list[int]] = {}
        for k, node in enumerate(part.tolist()):
            order = np.argsort(-scores[k], kind="stable")[: 3 * width]
            order = order[np.isfinite(scores[k][order])]
            chosen = self._diverse(found[k][order], scores[k][order], self.degree)
            self.layers[layer][node, : len(chosen)] = chosen
            for other in chosen:
                back.setdefault(other, []).append(node)
        for other, new in back.items():
            row = self.layers[layer][other]
            own = np.unique(np.concatenate([row[row >= 0], np.array(new, np.int64)]))
            own = own[own != other]
            if len(own) > width:
                near = self.vectors[own] @ self.vectors[other]
                order = np.argsort(-near, kind="stable")
                own = np.array(self._diverse(own[order], near[order], width))
            row[:] = -1
            row[: len(own)] = own

    def _diverse(self, nodes: np.ndarray, scores: np.ndarray, width: int) -> list[int]:
        """Nodes nearer to the centre than to any node chosen before; then the nearest of the others."""
        if len(nodes) <= width:
            return nodes.tolist()
        between = self.vectors[nodes] @ self.vectors[nodes].T
        chosen: list[int] = []
        for i in range(len(nodes)):
            if len(chosen) == width:
                break
            if not chosen or scores[i] > between[i, chosen].max():
                chosen.append(i)
        rest = [i for i in range(len(nodes)) if i not in set(chosen)][: width - len(chosen)]
        return nodes[sorted(chosen + rest)].tolist()

    def within(self, queries: np.ndarray, threshold: float, own: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """For each query the nodes of cosine >= threshold.

        Queries that are nodes themselves (``own``) enter the lowest layer there, too; others need the wider beam ``far``. The
        beam of a first search is widened without a fixed width: as long as it has nodes down to the threshold less the
        margin, their neighbours are looked at, so a group of any size is walked through once.
        """
        seen = np.zeros(len(self.vectors), bool)
        beam = min(self.far if own is None else self.beam, len(self.vectors))
        for a in range(0, len(queries), BATCH):
            part = queries[a : a + BATCH]
            starts = self._descend(part, 0)
            if own is not None:
                mine = own[a : a + BATCH, None]
                starts = np.concatenate([mine, np.where(starts == mine, -1, starts)], axis=1)
            nodes, scores = self._search(part, starts, 0, beam)
            for k in range(len(part)):
                ahead = nodes[k][scores[k] >= threshold - self.margin]
                hits, met = [nodes[k][scores[k] >= threshold]], [nodes[k][nodes[k] >= 0]]
                seen[met[0]] = True
                while len(ahead):
                    new = self._around(ahead)
                    new = new[~seen[new]]
                    seen[new] = True
                    met.append(new)
                    near = self.vectors[new] @ part[k]
                    hits.append(new[near >= threshold])
                    ahead = new[near >= threshold - self.margin]
                for those in met:
                    seen[those] = False
                yield a + k, np.concatenate(hits)

    def _misses(self, sample: np.ndarray, threshold: float, own: np.ndarray | None) -> bool:
        """Whether a search misses an exact neighbour (computed in blocks) of a sampled node.

        Pairs within rounding of the threshold don't count: a product of matrices may round them to the other side.
        """
        found = dict(self.within(self.vectors[sample], threshold, own))
        for a in range(0, len(sample), BATCH):
            near = self.vectors[sample[a : a + BATCH]] @ self.vectors.T >= threshold + 1e-12
            if any(len(np.setdiff1d(np.flatnonzero(row), found[a + k])) for k, row in enumerate(near)):
                return True
        return False

    def audit(self, threshold: float, every: int, others: bool) -> None:
        """Double beam and margin until no node misses a neighbour, and ``far`` until none does that enters as a stranger.

        The second audit takes each ``every``-th node, and is only of use where vectors of other shards are searched here.
        """
        nodes = np.arange(len(self.vectors))
        while self._misses(nodes, threshold, nodes) and (self.beam < len(nodes) or self.margin < 2):
            self.beam, self.margin = 2 * self.beam, 2 * self.margin
        while others and self._misses(nodes[::every], threshold, None) and self.far < len(nodes):
            self.far *= 2


def _build(threshold: float, every: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        vectors = unit(np.array(group["vector"].to_pylist(), np.float64))
        graph = Graph(vectors)
        graph.audit(threshold, every, group["shards"][0].as_py() > 1)
        ids, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        key = {c: group[c].slice(0, 1) for c in ("label", "dims", "shards", "shard")}
        own = {"graph": graph.state(), "ids": ids.tobytes(), "copies": copies.tobytes()}
        return pa.table({**key, **{c: pa.array([v], pa.binary()) for c, v in own.items()}, "beam": pa.array([graph.beam], pa.int32())})

    return run


def _find(threshold: float):
    """A block of vectors against one graph: counts of linked vectors, and a spanning forest of the links."""

    def run(queries: pa.Table, graphs: pa.Table) -> pa.Table:
        if not queries.num_rows or not graphs.num_rows:
            return pa.table({"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        graph = Graph.restored(graphs["graph"][0].as_py())
        ids, copies = (np.frombuffer(graphs[c][0].as_py(), np.int64) for c in ("ids", "copies"))
        own = queries["node"].to_numpy()
        vectors = unit(np.array(queries["vector"].to_pylist(), np.float64))
        kind, a, b, parent = [], [], [], {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        # The block that the graph was built from, in any order, finds itself in it.
        place = np.argsort(ids, kind="stable")
        at = place[np.minimum(np.searchsorted(ids[place], own), len(ids) - 1)]
        same = bool((ids[at] == own).all()) and len(own) == len(ids)
        for k, nodes in graph.within(vectors, threshold, at if same else None):
            nodes = nodes[ids[nodes] != own[k]]
            if len(nodes):
                kind.append(0)
                a.append(int(own[k]))
                b.append(int(copies[nodes].sum()))
                for other in ids[nodes].tolist():
                    x, y = root(int(own[k])), root(other)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
        for x in list(parent):
            if root(x) != x:
                kind.append(1)
                a.append(x)
                b.append(root(x))
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row for each row of the input."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    component = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size(component) > 0)
        & F.forall(component, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.exists(component, lambda x: x != 0)
    )
    # Zeros of either sign are one value, so that equal vectors have equal keys.
    vector = F.when(F.coalesce(sound, F.lit(False)), F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))))
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"))
    reps = rows.dropna().groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # Rows of one id can hold different vectors, so a vector has a number of its own; numbers follow the ids.
    numbered = reps.orderBy("rep", "label", "vector").withColumn("node", F.monotonically_increasing_id())
    reps = written(numbered.withColumn("dims", F.size("vector")), "vectors")
    sizes = reps.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = reps.join(sizes, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("rep", "vector"), F.col("shards")).cast("int"))
    dealt = written(dealt, "shards")
    graphs = dealt.groupBy("label", "dims", "shards", "shard").applyInArrow(
        _build(threshold, AUDIT_EVERY), "label string, dims int, shards int, shard int, graph binary, ids binary, copies binary, beam int"
    )
    graphs = written(graphs, "graphs")
    blocks = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    queries = dealt.withColumnRenamed("shard", "block").withColumn("shard", blocks).select("label", "dims", "shard", "block", "node", "vector")
    targets = graphs.withColumn("block", blocks).select("label", "dims", "shard", "block", "graph", "ids", "copies")
    key = ["label", "dims", "shard", "block"]
    found = written(queries.groupBy(*key).cogroup(targets.groupBy(*key)).applyInArrow(_find(threshold), "kind int, a bigint, b bigint"), "found")
    labels = components(found.filter("kind = 1"), "a", "b")
    smallest = reps.select(F.col("node").alias("component"), F.col("rep").alias("first"))
    labels = labels.join(smallest, "component").select("node", F.col("first").alias("component"))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("linked"))
    of_rep = (
        reps.join(counts, "node", "left")
        .join(labels, "node", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(of_rep, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
