import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, block int, `pos.x` string, id long, score double"


def plain(rows, every=100, k=5):
    """All scores of all anchors, by the definitions."""
    seen = set()
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        seen.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    seen = {r for r in seen if sum(x * x for x in r[2]) < 2 ** 62}
    out = []
    for i, label, v in seen:
        if i is None or i % every:
            continue

        def ranked(some):
            return sorted(((-sum(a * b for a, b in zip(v, w)), math.inf if j is None else j) for j, w in some))
        pos = ranked([(j, w) for j, g, w in seen if g == label and j != i])[:k]
        neg = ranked([(j, w) for j, g, w in seen if g != label and j != i])
        for p, pid in pos:
            fit = [n for n in neg if 80 * -p <= 100 * -n[0] <= 100 * -p][:k]
            out += [(i, None if pid == math.inf else pid, r + 1, None if n == math.inf else n, -p, -s) for r, (s, n) in enumerate(fit)]
    return sorted(out, key=str)


def clustered(seed, n, dim=8, clusters=6, spread=0.1, scale=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) * scale for _ in range(dim)] for _ in range(clusters)]
    return [(i, [x + r.gauss(0, spread) * scale for x in r.choice(centres)], r.randrange(4)) for i in range(n)]


def mine(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "p", 2, 0.5) for r in rows], DDL).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return H.mine(H.usable(df, "vec_id", label, "embedding"), F.col("id") % kw.pop("every", 100) == 0, **kw)


@pytest.mark.parametrize("case", ["plain", "many anchors", "ties", "large", "apart"])
def test_equals_scoring_every_row(spark, case):
    rows, kw = {
        "plain": (clustered(1, 700), {}),
        "many anchors": (clustered(2, 500, clusters=3), {"every": 3, "block_size": 20, "slice_size": 60}),
        "ties": ([(i, v if i % 3 else [1.0] * 8, 1 if i % 5 else 2) for i, v, _ in clustered(3, 400)], {"every": 10}),
        "large": (clustered(4, 300, scale=50_000.0), {"every": 10}),
        "apart": (clustered(5, 400, spread=0.001, clusters=40), {"every": 8, "block_size": 30, "slice_size": 100})}[case]
    got = mine(spark, rows, **dict(kw))
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    want = plain(rows, kw.get("every", 100))
    assert sorted(map(tuple, got.collect()), key=str) == want and want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25, 1.0]
    rows = [(0, v, 0), (0, v, 0), (0, [0.5, 0.25, 1.0], 3), (1, v, 1), (1, v, 1), (2, v, None), (3, None, 1), (4, [0.5, None, 1.0], 1),
            (5, [nan, 0.0, 0.0], 1), (6, [inf, 0.0, 0.0], 1), (7, v, 0), (8, [], 1), (9, [0.5], 1), (10, [0.5, -0.25, 1.0, 9.0], 2),
            (None, v, 1), (None, v, 2), (None, None, None), (11, [1e20, 0.0, 0.0], 1), (12, [-0.5, 0.25, -1.0], 1), (100, [0.0] * 3, 1),
            (200, v, 7), (300, [0.49, -0.25, 1.0], 1), (400, v, 1), (401, [0.45, -0.2, 0.9], 2)]
    got = sorted(map(tuple, mine(spark, rows).collect()), key=str)
    assert got == plain(rows) and got
    assert mine(spark, rows[:2]).collect() == []
    empty = spark.createDataFrame([], DDL)
    assert H.mine(H.usable(empty, "vec_id", F.col("label"), "embedding"), F.col("id") % 100 == 0).collect() == []


def test_spanning_tree():
    x = np.array([[0, 0], [10, 0], [10, 1], [0, 2], [5, 0]])
    order, parent, edge = H.spanning_tree(x)
    assert sorted(order) == list(range(5)) and order[0] == 0 and parent[0] == 0
    assert all(order.index(parent[i]) < order.index(i) for i in order[1:])
    assert sorted(edge.tolist()) == [0, 1, 2, 5, 5]


def test_bounds_spare_scores(monkeypatch):
    """Anchors of few tight groups: most rows are ruled out by their bounds."""
    import pyarrow as pa
    r = np.random.default_rng(1)
    centres = r.normal(0, 256, (8, 16))
    a = np.floor(centres[r.integers(0, 8, 64)] + r.normal(0, 1, (64, 16))).astype(np.int64)
    x = np.floor(centres[r.integers(0, 8, 2000)] + r.normal(0, 1, (2000, 16))).astype(np.int64)
    block = pa.table({"id": pa.array(np.arange(64) * 100), "label": pa.array(np.zeros(64, np.int64)), "v": pa.array(a.tolist(), pa.list_(pa.int64()))})
    tree = H._tree((pa.scalar(0),), block)
    rows = pa.table({"id": pa.array(np.arange(2000) + 10_000), "label": pa.array(np.zeros(2000, np.int64)), "v": pa.array(x.tolist(), pa.list_(pa.int64()))})
    scored = []
    own = H.Cell.scores
    monkeypatch.setattr(H.Cell, "scores", lambda self, i, at: scored.append(len(at)) or own(self, i, at))
    found = H._positives(5)((), tree, rows)
    assert sum(scored) < 0.4 * 64 * 2000
    order = {i: p for i, p in zip(tree["id"].to_pylist(), tree["pos"].to_pylist())}
    s = a @ x.T
    for i in range(64):
        want = sorted((-v, 10_000 + j) for j, v in enumerate(s[i].tolist()))[:5]
        got = sorted((-f["score"], f["id"]) for f in found.to_pylist() if f["pos"] == order[i * 100])
        assert got == want
