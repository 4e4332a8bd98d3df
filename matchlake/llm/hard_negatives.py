"""Hard negatives: for each anchor and each of its nearest rows of the same label
(positives), the best rows of other labels whose score lies in a window below the
positive's.  The score is the inner product of vectors of whole numbers.

Anchors are grouped by the signs of their first components and cut into blocks;
each block has a minimum spanning tree.  A block meets the rows in slices of
bounded size.  In such a cell the root's score with every row is computed; going
down an edge, a row's score can change by at most the edge's length times the
row's norm, so the parent's score (or its bounds) bounds the child's.  Only rows
whose bounds overlap what is asked for are scored again: for positives, those
that can still be among the best; for negatives, those that can lie in a window
and be among its best.  The best of each cell meet in a ranking by anchor.  The
bounds only rule rows out: the result is that of scoring every row.

Edge cases: rows with a null label, a null vector or a null or non-finite
component take no part, nor do those whose norm reaches 2^31, whose scores could
leave a long.  A shorter vector counts as ending in zeros.  Rows that repeat (id,
label and vector equal) count once; an id with several vectors or labels is
several rows, and several anchors under one id.  An anchor's other rows are those
of another id.  A null id is never an anchor, and comes last among ties.  An anchor
without positives, or a window without rows, gives no rows; an empty table none.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

POSITIVES = 5
NEGATIVES = 5
WINDOW = (80, 100)         # least and greatest negative score, in hundredths of the positive's
SCALE = 256                # a component x is the whole number floor(SCALE * x)
ANCHORS = 256              # anchors of a block, about
SLICE = 4096               # rows of a slice, about

POSITIVE = "block int, pos int, id long, score long"
NEGATIVE = "block int, pos int, nth int, id long, score long"
LAST = np.iinfo(np.int64).max      # stands for a null id in sorting


def usable(vectors: DataFrame, key: str, label: Column, column: str) -> DataFrame:
    """(id, label, v): distinct rows that take part, components as whole numbers."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(fine).select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                                      F.transform(v, lambda x: F.floor(x * SCALE)).alias("v")).where("label IS NOT NULL")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.where(square < 2.0 ** 62).distinct()


def _matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _width(*columns) -> int:
    return max((int(n) for c in columns for n in c.combine_chunks().value_lengths().to_pylist()), default=0)


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``LAST`` for null, and which are null."""
    return column.fill_null(LAST).to_numpy().astype(np.int64), column.is_null().to_numpy().astype(bool)


def spanning_tree(x: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree (Prim): parents come before
    their children; the root's parent is itself."""
    n = len(x)
    x = x.astype(np.float64)
    parent, edge = np.zeros(n, np.int64), np.zeros(n)
    least = np.full(n, np.inf)
    out = np.ones(n, bool)
    order, at = [], 0
    while True:
        order.append(at)
        out[at] = False
        if len(order) == n:
            return order, parent, edge
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        nearer = out & (d < least)
        least[nearer], parent[nearer] = d[nearer], at
        at = int(np.argmin(np.where(out, least, np.inf)))
        edge[at] = least[at]


def _tree(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
    """The block's anchors in tree order: ``up`` is the parent's place, ``edge`` its distance."""
    ids, null = _ids(block["id"])
    block = block.take(pa.array(np.lexsort((block["label"].to_numpy(), ids))))
    order, parent, edge = spanning_tree(_matrix(block["v"], _width(block["v"])))
    place = np.argsort(order)
    return pa.table({"block": pa.array([key[0].as_py()] * len(order), pa.int32()),
                     "pos": pa.array(np.arange(len(order)), pa.int32()),
                     "up": pa.array(place[parent[order]], pa.int32()), "edge": pa.array(edge[order]),
                     **{c: block[c].take(pa.array(order)) for c in ("id", "label", "v")}})


class Cell:
    """A block of anchors, in tree order, and a slice of rows."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        order = pa.array(np.argsort(anchors["pos"].to_numpy()))
        anchors = anchors.take(order)
        self.table = anchors
        width = _width(anchors["v"], rows["v"])
        self.a, self.x = _matrix(anchors["v"], width), _matrix(rows["v"], width)
        self.a_id, _ = _ids(anchors["id"])
        self.id, self.null = _ids(rows["id"])
        self.a_label, self.label = anchors["label"].to_numpy(), rows["label"].to_numpy()
        self.norm = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        longest = np.sqrt((self.a.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
        if longest * self.norm.max(initial=0) < 2.0 ** 52:      # doubles hold such sums of products exactly
            self.a, self.x = self.a.astype(np.float64), self.x.astype(np.float64)

    def scores(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        if 4 * len(rows) > len(self.x):
            return (self.x @ self.a[anchor]).astype(np.int64)[rows]
        return (self.x[rows] @ self.a[anchor]).astype(np.int64)

    def walk(self, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, their scores): of each anchor the rows that
        ``wanted(anchor, lo, hi)`` asks for, knowing bounds of all scores."""
        up, edge = self.table["up"].to_numpy(), self.table["edge"].to_numpy()
        bounds: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(len(self.a)):
            if i == 0:
                lo = hi = self.scores(0, np.arange(len(self.x))).astype(np.float64)
            else:
                lo, hi = bounds[up[i]]
                # a little more than the bound, for rounding
                apart = edge[i] * self.norm * (1 + 1e-9) + 1e-9 * np.maximum(np.abs(lo), np.abs(hi)) + 1
                lo, hi = lo - apart, hi + apart
            rows = np.nonzero(wanted(i, lo, hi))[0]
            s = self.scores(i, rows)
            if i:
                lo[rows] = hi[rows] = s
            bounds.append((lo, hi))
            yield i, rows, s

    def best(self, rows: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
        """Places of the ``k`` best scores, ties by id."""
        if len(rows) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            at = np.nonzero(s >= least)[0]
        else:
            at = np.arange(len(rows))
        return at[np.lexsort((self.id[rows[at]], -s[at]))][:k]


def _kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, or -inf if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -math.inf


def _found(cell: Cell, found: list[tuple], names: tuple[str, ...]) -> pa.Table:
    """Rows (anchor, ..., row of the slice, score) as a table."""
    block = cell.table["block"][0].as_py() if len(cell.a) else 0
    row = np.array([f[-2] for f in found], np.int64)
    columns = {"block": pa.array([block] * len(found), pa.int32())}
    for n, name in enumerate(names):
        columns[name] = pa.array([f[n] for f in found], pa.int32())
    return pa.table(columns | {"id": pa.array(cell.id[row], mask=cell.null[row]) if len(found) else pa.array([], pa.int64()),
                               "score": pa.array([int(f[-1]) for f in found], pa.int64())})


def _positives(k: int):
    def run(key: tuple[pa.Scalar, ...], anchors: pa.Table, rows: pa.Table) -> pa.Table:
        cell, found = Cell(anchors, rows), []

        def wanted(i: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            own = (cell.label == cell.a_label[i]) & ((cell.id != cell.a_id[i]) | cell.null)
            return own & (hi >= _kth(lo[own], k))      # k rows score at least that
        if len(cell.a) and len(cell.x):
            for i, at, s in cell.walk(wanted):
                found += [(i, at[j], s[j]) for j in cell.best(at, s, k).tolist()]
        return _found(cell, found, ("pos",))
    return run


def _negatives(k: int, window: tuple[int, int]):
    low, high = window

    def run(key: tuple[pa.Scalar, ...], anchors: pa.Table, rows: pa.Table) -> pa.Table:
        cell, found = Cell(anchors, rows), []
        limits = cell.table["limits"].to_pylist()

        def wanted(i: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            other = (cell.label != cell.a_label[i]) & ((cell.id != cell.a_id[i]) | cell.null)
            out = np.zeros(len(lo), bool)
            for p in limits[i]:
                slack = 1 + 1e-9 * abs(p)
                bottom, top = low * p / 100 - slack, high * p / 100 + slack
                inside = other & (lo >= bottom + 2 * slack) & (hi <= top - 2 * slack)      # surely in the window
                out |= (hi >= max(bottom, _kth(lo[inside], k))) & (lo <= top)
            return out & other
        if len(cell.a) and len(cell.x):
            for i, at, s in cell.walk(wanted):
                for nth, p in enumerate(limits[i]):
                    # whole bounds of the window, so that no product leaves a long
                    inside = np.nonzero((s >= -(-low * p // 100)) & (s <= high * p // 100))[0]
                    found += [(i, nth, at[inside[j]], s[inside[j]]) for j in cell.best(at[inside], s[inside], k).tolist()]
        return _found(cell, found, ("pos", "nth"))
    return run


def _blocks(anchors: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Anchors with the number of their block, and the number of blocks."""
    n = anchors.count()
    bits = max(0, min(20, round(math.log2(n / size)))) if n else 0
    code = F.lit(0).cast("long")
    for j in range(bits):
        code = code * 2 + F.coalesce((F.get("v", F.lit(j)) > 0).cast("long"), F.lit(0))
    coded = anchors.withColumn("code", code)
    parts = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    coded = coded.join(parts, "code").withColumn("sub", F.pmod(F.xxhash64("id", "label", "v"), "parts"))
    # one row per block: a thousandth of the anchors and less
    numbers = cut(coded.select("code", "sub").distinct().withColumn(
        "block", F.row_number().over(Window.orderBy("code", "sub")) - 1), "anchor-blocks")
    return coded.join(numbers, ["code", "sub"]).select("block", "id", "label", "v"), numbers.count()


def _meet(anchors: DataFrame, rows: DataFrame, blocks: int, slices: int, run, schema: str) -> DataFrame:
    """Each block of anchors with each slice of rows."""
    a = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    x = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return a.groupBy("block", "slice").cogroup(x.groupBy("block", "slice")).applyInArrow(run, schema)


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, block_size: int = ANCHORS, slice_size: int = SLICE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for rows as :func:`usable` gives them; ``is_anchor`` is a condition on ``id``."""
    rows = cut(rows, "negatives-rows")
    slices = max(1, math.ceil(rows.count() / slice_size))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id", "label", "v"), F.lit(slices)))
    blocked, blocks = _blocks(rows.where(is_anchor).drop("slice"), block_size)
    tree = cut(blocked.groupBy("block").applyInArrow(
        _tree, "block int, pos int, up int, edge double, id long, label long, v array<long>"), "anchor-trees")

    best = _top(_meet(tree, rows, max(1, blocks), slices, _positives(positives), POSITIVE), ["block", "pos"], positives)
    best = cut(best, "positives")
    limits = best.groupBy("block", "pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))),
                                                          lambda p: p["score"]).alias("limits"))
    # an anchor without positives stays in its tree
    asked = tree.join(limits, ["block", "pos"], "left").withColumn("limits", F.coalesce("limits", F.array().cast("array<long>")))
    found = _top(_meet(asked, rows, max(1, blocks), slices, _negatives(negatives, window), NEGATIVE),
                 ["block", "pos", "nth"], negatives)
    pairs = tree.select("block", "pos", F.col("id").alias("anchor_id")).join(
        best.select("block", "pos", (F.col("rank") - 1).alias("nth"), F.col("id").alias("positive_id"),
                    F.col("score").alias("positive_score")), ["block", "pos"])
    return found.join(pairs, ["block", "pos", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
