"""Approximate nearest neighbours by inner product: a hierarchical k-means tree
searched best bin first.

The tree is fitted on at most ``SAMPLE`` vectors (the documented bound); every
vector is then filed under its leaf.  A query walks the tree with a priority
queue: the node whose centre has the largest inner product with it is opened
next, until enough leaves are found, and the leaves are searched exactly.  How
many leaves are visited is calibrated: for a sample of queries the true
neighbours are found by brute force over all vectors, and visits are widened
until ``RECALL`` of them lie in visited leaves.

Equal vectors are searched once: only the ``k + 1`` smallest ids of a vector
can be among a query's ``k`` nearest, and equal queries share one search, so
neither a frequent vector nor a frequent query makes a large leaf.  Large
leaves are cut into chunks by hash, and so are a leaf's queries; each pair of
chunks is one group of bounded size.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, neither as queries nor as candidates; so do vectors
whose length is not the most frequent one.  Null ids take no part.  Rows that
repeat (same id, same vector) count once; an id with several vectors is several
candidates and several queries under one id.  Ties go to the smaller id.  With
few candidates a query gets them all (a walk goes on until its leaves hold
more than twice ``k`` distinct vectors).
Other columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K = 20
SAMPLE = 20_000            # vectors the tree is fitted on, at most
BRANCH = 8
LEAF = 64                  # sampled vectors in a leaf, about
CALIBRATE = 200            # queries whose true neighbours are found, at most
RECALL = 0.97
MEMBERS, QUERIES = 4096, 1024   # rows of a leaf's chunk
FOUND = "query long, vec_id long, score double"


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v): distinct rows of usable vectors, components as floats."""
    v = F.col(column).cast("array<float>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & ok)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].n if sizes else 0)).distinct()


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((centre ** 2).sum(1)[None, :] - 2 * x @ centre.T, axis=1)
        for j in range(k):
            if (own := near == j).any():
                centre[j] = x[own].mean(axis=0)
    return centre, near


class Tree:
    """Centres and children of the nodes; node 0 is the root, leaves have none."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.centres: list[np.ndarray] = [x.mean(axis=0) if len(x) else np.zeros(1)]
        self.children: list[list[int]] = [[]]
        todo = [(0, x)]
        while todo:
            node, own = todo.pop()
            if len(own) <= leaf * 2:
                continue
            centre, near = _means(own, branch, rng)
            parts = [(c, own[near == j]) for j, c in enumerate(centre) if (near == j).any()]
            if len(parts) < 2:
                continue
            for c, part in parts:
                self.centres.append(c)
                self.children.append([])
                self.children[node].append(len(self.children) - 1)
                todo.append((len(self.children) - 1, part))
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.blocks = [np.array([self.centres[c] for c in kids]) if kids else None for kids in self.children]

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at each level."""
        at = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.blocks[node] is None:
                at[rows] = node
                continue
            c = self.blocks[node]
            near = np.argmin((c ** 2).sum(1)[None, :] - 2 * x[rows] @ c.T, axis=1)
            todo += [(kid, rows[near == j]) for j, kid in enumerate(self.children[node]) if (near == j).any()]
        return at

    def visit(self, q: np.ndarray, leaves: int, vectors: int = 0, sizes: dict[int, int] | None = None) -> list[int]:
        """At least ``leaves`` leaves, holding ``vectors`` vectors by their
        ``sizes``, in the order a best-bin-first search opens them."""
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < leaves or held < vectors):
            _, node = heapq.heappop(queue)
            if self.blocks[node] is None:
                found.append(node)
                held += (sizes or {}).get(node, 0)
                continue
            for kid, s in zip(self.children[node], (self.blocks[node] @ q).tolist()):
                heapq.heappush(queue, (-s, kid))
        return found


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), "<f4").reshape(len(data), -1).astype(np.float64) if data else np.zeros((0, 1))


def _nearest(queries: list[int], q: np.ndarray, members: list[int], x: np.ndarray, k: int):
    """Rows (query, member, score) of the ``k`` best members of each query and all that tie."""
    if not queries or not members:
        return [], [], []
    score = q @ x.T
    # products are summed in another order for other shapes; keep what is as good within rounding
    slack = 1e-9 * (np.abs(q) @ np.abs(x).T).max(axis=1)
    least = np.partition(score, len(members) - k, axis=1)[:, len(members) - k] if len(members) > k else np.full(len(q), -np.inf)
    at, to = np.nonzero(score >= (least - slack)[:, None])
    exact = [math.fsum(a) for a in q[at] * x[to]]
    return [queries[i] for i in at.tolist()], [members[j] for j in to.tolist()], exact


def _search_cell(k: int):
    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, members: pa.Table) -> pa.Table:
        a, b, s = _nearest(queries["node"].to_pylist(), _matrix(queries["b"]),
                           members["node"].to_pylist(), _matrix(members["b"]), k)
        return pa.table({"query": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())})
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best vectors of each query vector, and those that tie with the last."""
    w = Window.partitionBy("query").orderBy(F.desc("score"))
    return found.withColumn("r", F.rank().over(w)).where(F.col("r") <= k).drop("r")


class Index:
    """``vectors`` (key, column) filed under the leaves of a fitted tree.

    The tree has about ``sample / leaf`` leaves whatever the table holds, so for
    much larger tables raise ``sample`` (its vectors are the driver's load).
    """

    def __init__(self, vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = K, seed: int = 3,
                 sample: int = SAMPLE, leaf: int = LEAF):
        self.spark, self.k, self.seed = vectors.sparkSession, k, seed
        rows = cut(usable(vectors, key, column), "ann-rows")
        # distinct vectors: only the k + 1 smallest ids of one can be found
        distinct = rows.groupBy("v").agg(F.count("*").alias("copies"))
        self.nodes = cut(distinct.select(F.monotonically_increasing_id().alias("node"), "v", "copies"), "ann-nodes")
        named = rows.join(self.nodes.select("node", "v"), "v").select("node", "id")
        self.ids = cut(named, "ann-ids")
        n = self.nodes.count()
        picked = self.nodes.sample(min(1.0, 1.2 * sample / max(n, 1)), seed=seed).select("v").limit(sample).collect()
        self.tree = Tree(np.array([r.v for r in picked], np.float64).reshape(len(picked), len(picked[0].v) if picked else 1), leaf=leaf)
        self.filed = cut(self.nodes.select("node", "v").mapInArrow(
            self._file(), "node long, leaf long, b binary"), "ann-filed")
        sizes = self.filed.groupBy("leaf").agg(F.count("*").alias("n"), F.ceil(F.count("*") / F.lit(MEMBERS)).alias("chunks"))
        sizes = cut(sizes, "ann-leaves")             # a row for each leaf of the tree
        self.sizes = {r.leaf: r.n for r in sizes.collect()}
        self.chunks = sizes.select("leaf", "chunks")

    def _file(self):
        tree = self.spark.sparkContext.broadcast(self.tree)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = b["v"].values.to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, 1), "f4")
                x = x.astype("<f4")
                yield pa.RecordBatch.from_arrays(
                    [b["node"], pa.array(tree.value.file(x.astype(np.float64)) if len(x) else [], pa.int64()),
                     pa.array([r.tobytes() for r in x], pa.binary())], ["node", "leaf", "b"])
        return run

    def visits(self, queries: DataFrame) -> int:
        """Leaves to visit for ``RECALL``, measured on a sample of ``queries``
        (node, b) whose neighbours are found by brute force."""
        k = self.k
        rows = queries.orderBy(F.xxhash64(F.lit(self.seed), "node")).limit(CALIBRATE).collect()
        if not rows:
            return 1
        nodes, q = [r.node for r in rows], np.array([np.frombuffer(r.b, "<f4") for r in rows]).astype(np.float64)
        sent = self.spark.sparkContext.broadcast((nodes, q))

        def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                nodes, q = sent.value
                a, to, s = _nearest(nodes, q, list(range(b.num_rows)), _matrix(b["b"]), k + 1)
                ids, leaf = b["node"].to_pylist(), b["leaf"].to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array([ids[i] for i in to], pa.int64()), pa.array(s, pa.float64()),
                     pa.array([leaf[i] for i in to], pa.int64())], ["query", "vec_id", "score", "leaf"])

        found = _top(self.filed.mapInArrow(brute, FOUND + ", leaf long"), k + 1).collect()   # CALIBRATE x (k + 1) rows
        order = {n: {leaf: i for i, leaf in enumerate(self.tree.visit(v, len(self.tree.leaves)))} for n, v in zip(nodes, q)}
        places = sorted(order[r["query"]][r.leaf] for r in found)
        return places[min(len(places) - 1, math.ceil(RECALL * len(places)))] + 1 if places else 1

    def search(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score, visited) for the ids of ``queries``
        (id), each among the index's rows; a query is no candidate of its own."""
        k = self.k
        asked = self.ids.join(queries.select("id").distinct(), "id").select("id", "node")
        wanted = cut(asked.select("node").distinct().join(self.filed.select("node", "b"), "node"), "ann-queries")
        visits = self.visits(wanted)
        tree, sizes = self.spark.sparkContext.broadcast(self.tree), self.sizes

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                leaves = [tree.value.visit(q, visits, 2 * k + 1, sizes) for q in _matrix(b["b"])]
                yield pa.RecordBatch.from_arrays([b["node"], b["b"], pa.array(leaves, pa.list_(pa.int64()))],
                                                 ["node", "b", "leaves"])

        opened = cut(wanted.mapInArrow(walk, "node long, b binary, leaves array<long>"), "ann-opened")
        asks = opened.select("node", F.explode("leaves").alias("leaf")).groupBy("leaf").agg(
            F.ceil(F.count("*") / F.lit(QUERIES)).alias("asks"))
        grid = cut(self.chunks.join(asks, "leaf"), "ann-grid")

        def dealt(rows: DataFrame, own: str, other: str, a: str, b: str) -> DataFrame:
            """Rows with their own chunk, repeated for every chunk of the other side."""
            return rows.join(grid, "leaf").select(
                "leaf", "node", "b", F.pmod(F.xxhash64("node"), own).alias(a),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(b)).select("leaf", "m", "a", "node", "b")

        asking = dealt(opened.select("node", "b", F.explode("leaves").alias("leaf")), "asks", "chunks", "a", "m")
        members = dealt(self.filed, "chunks", "asks", "m", "a")
        found = asking.groupBy("leaf", "m", "a").cogroup(members.groupBy("leaf", "m", "a")).applyInArrow(
            _search_cell(k + 1), FOUND)
        best = cut(_top(found, k + 1).select("query", F.col("vec_id").alias("hit"), "score"), "ann-best")

        # from vectors back to ids: the k + 1 smallest ids of each vector that was found
        hits = self.ids.join(best.select(F.col("hit").alias("node")).distinct(), "node", "left_semi")
        first = hits.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("r") <= k + 1)
        wide = best.join(first.select(F.col("node").alias("hit"), F.col("id").alias("vec_id")), "hit").select(
            "query", "vec_id", "score", "hit")
        w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "hit")
        lists = wide.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).groupBy("query").agg(
            F.sort_array(F.collect_list(F.struct("r", "vec_id", "score", "hit"))).alias("list"))
        mine = asked.select("node", F.col("id").alias("query_id")).join(lists, F.col("node") == F.col("query"))
        others = F.slice(F.filter("list", lambda x: (x["vec_id"] != F.col("query_id")) | (x["hit"] != F.col("node"))), 1, k)
        return mine.select("query_id", F.posexplode(others).alias("at", "x")).select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
            F.col("x.score").alias("score"), F.lit(visits).alias("visited"))
