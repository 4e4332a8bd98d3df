import math

import numpy as np
import pytest

from matchlake.llm import ann
from tests.conftest import SF_SMALL

VECTORS = "vec_id long, embedding array<float>, label int, node string, leaf string"


def plain(rows, queries, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows)]
    out = {}
    for i, q in rows:
        if i in queries:
            near = sorted(((-math.fsum(q * v), j) for j, v in rows if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def collected(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "n", "l") for i, v in rows], VECTORS).repartition(3)


def test_recall_on_clusters(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + 0.4 * r.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    docs = frame(spark, rows)
    index = ann.Index(docs, k=10)
    ask = docs.where("vec_id % 20 = 0").selectExpr("vec_id AS id")
    found = index.search(ask)
    got, want = collected(found), plain(rows, set(range(0, 3000, 20)), 10)
    assert set(got) == set(want)
    recall = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.93
    assert 0 < found.first().visited < len(index.tree.leaves)
    exact = {(q, a): s for q in want for a, s in want[q]}
    assert all(s == exact[q, a] for q in got for a, s in got[q] if (q, a) in exact)


def test_given_table_reaches_ninety_percent(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    got = collected(ann.Index(docs).search(docs.where("vec_id % 20 = 0").selectExpr("vec_id AS id")))
    want = plain(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_many_equal_vectors_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "MEMBERS", 50)
    monkeypatch.setattr(ann, "QUERIES", 7)
    r = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 900, 3)] + [
        (i, r.normal(size=3).astype(np.float32).tolist()) for i in range(900) if i % 3]
    docs = frame(spark, rows)
    index = ann.Index(docs, k=20)
    monkeypatch.setattr(index, "visits", lambda queries: len(index.tree.leaves))
    got = collected(index.search(docs.selectExpr("vec_id AS id").where("id % 20 = 0")))
    assert got == plain(rows, set(range(0, 900, 20)), 20)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 0.0]), (60, None), (80, [1.0, None]),
            (100, [nan, 1.0]), (120, [inf, 1.0]), (140, []), (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (5, [0.5, 0.5]),
            (20, [0.0, 1.0])]
    docs = frame(spark, rows)
    got = ann.Index(docs).search(docs.where("vec_id % 20 = 0").selectExpr("vec_id AS id"))
    assert [tuple(r)[:4] for r in got.where("query_id = 0").orderBy("rank").collect()] == [
        (0, 1, 20, 1.0), (0, 2, 5, 0.5), (0, 3, 20, 0.0)]
    assert {r.query_id for r in got.collect()} == {0, 20}
    assert ann.Index(docs.where("1 = 0")).search(docs.where("1 = 0").selectExpr("vec_id AS id")).collect() == []


def test_best_bin_first_order():
    r = np.random.default_rng(6)
    x = r.normal(size=(2000, 8))
    tree = ann.Tree(x)
    assert sorted(tree.visit(x[0], 10 ** 9)) == sorted(tree.leaves)
    assert set(tree.file(x).tolist()) <= set(tree.leaves)
    assert tree.visit(x[0], 3) == tree.visit(x[0], 50)[:3]


@pytest.mark.parametrize("n", [0, 1, 5])
def test_tiny_trees(n):
    assert ann.Tree(np.ones((n, 4))).leaves == [0]


def test_a_walk_goes_on_until_it_holds_enough(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(3000, 8))
    tree = ann.Tree(x)
    sizes = dict(zip(*np.unique(tree.file(x), return_counts=True)))
    few = tree.visit(x[0], 1, 500, sizes)
    assert sum(sizes.get(n, 0) for n in few) >= 500 > sum(sizes.get(n, 0) for n in few[:-1])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x[:400])]
    docs = frame(spark, rows)
    index = ann.Index(docs, k=60)
    index.visits = lambda queries: 1
    got = collected(index.search(docs.selectExpr("vec_id AS id").where("id % 40 = 0")))
    assert all(len(v) == 60 for v in got.values()) and len(got) == 10
