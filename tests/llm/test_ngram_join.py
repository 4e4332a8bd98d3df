import random
from collections import defaultdict

import numpy as np
import pytest

from matchlake.llm import ngram_join as N
from matchlake.llm.components import components
from tests.llm.conftest import prose


def plain(rows, threshold=0.8):
    """(class id, links) of each (doc_id, text) by comparing all pairs."""
    def grams(t):
        w = (t or "").encode().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None and (least[find(k)] is None or i < least[find(k)]):
            least[find(k)] = i
    return sorted(((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows)), key=str)


def near_copies():
    r = random.Random(3)
    rows, n = [], 0
    for g in range(6):
        base = prose(150 + 40 * g, 100 + g, 5000).split(" ")
        for c in range(2 + 9 * (g == 0) + g):
            w = list(base)
            for _ in range(c % 5):
                w[r.randrange(len(w))] = f"edit{n}"
            if c == 7:
                w = w[:40] + [f"pad{k}" for k in range(200)]          # shares a passage only
            rows.append((n, " ".join(w)))
            n += 1
        rows.append((n, " ".join(base)))
        rows.append((n + 1, "  ".join(base) + "\n"))
        n += 2
    return rows + [(n + k, prose(60, k, 3000)) for k in range(20)]


@pytest.fixture(scope="module")
def found(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    yield rows, docs
    docs.unpersist()


def test_equals_all_pairs(found):
    rows, docs = found
    got = sorted((tuple(r) for r in N.near_duplicates(docs).collect()), key=str)
    assert got == plain(rows)


def test_blocks_of_a_group_are_all_compared(found, monkeypatch):
    rows, docs = found
    monkeypatch.setattr(N, "BLOCK", 3)
    got = sorted((tuple(r) for r in N.near_duplicates(docs).collect()), key=str)
    assert got == plain(rows)


def test_one_document_of_each_class_stays(found):
    rows, docs = found
    kept = sorted(r.doc_id for r in N.deduplicate(docs).collect())
    assert kept == sorted({c for _, c, _ in plain(rows)})


def test_edge_cases(edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows]
    got = sorted((tuple(r) for r in N.near_duplicates(edge_docs).collect()), key=str)
    want = []
    for (i, c, n), (_, t) in zip([x for x in map(tuple, plain(rows))], sorted(rows, key=str)):
        want.append((i, c, n))
    assert [g for g in got if g[0] not in (1, 2, 3, None)] == [w for w in want if w[0] not in (1, 2, 3, None)]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]
    kept = N.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "None", "7", "9", "10", "11"])
    assert N.near_duplicates(no_docs).collect() == [] and N.deduplicate(no_docs).collect() == []


def classes_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sample, digests = N.sample_of(docs, 0.8)
    return N._classes(docs, sample)[1], digests


def test_the_prefix_follows_the_links_of_the_sample(spark):
    """Nearly equal copies meet by long prefixes, copies near the threshold need short ones."""
    def copies_of(edits, n):
        out = []
        for g in range(12):
            base = prose(400, 500 + g, 9000).split(" ")
            for c in range(n):
                w = list(base)
                for e in range(edits):
                    w[(c * 37 + e * (400 // max(edits, 1))) % 400] = f"w{g}x{c}x{e}"
                out.append((len(out), " ".join(w)))
        return out
    depth, found, links = N.depth_for(*classes_of(spark, copies_of(1, 6)), 0.8, 0.9999)
    assert depth > 6 and links >= N.FEW_LINKS and found[depth] >= 0.9999
    depth, found, links = N.depth_for(*classes_of(spark, copies_of(4, 6)), 0.8, 0.9999)
    assert links >= N.FEW_LINKS and found[depth] >= 0.9999 and (depth == 8 or found[depth + 1] < 0.9999)
    near = depth
    depth, found, links = N.depth_for(*classes_of(spark, copies_of(1, 1)), 0.8, 0.9999)
    assert links == 0 and depth == 6 and near <= 8      # judged by the threshold: 6 is the longest that meets it
    assert N.meets(0.8, 6) >= 0.9999 > N.meets(0.8, 7)
    assert N.depth_for(*classes_of(spark, copies_of(1, 1)), 0.8, 0.9999999)[0] < 6


def test_sampled_links_are_exact():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 300, 250, dtype=np.uint64)) for _ in range(30)] + [np.arange(10, dtype=np.uint64)]
    sample = N.Sample(sets, 0.4)
    for g in [*sets, np.zeros(0, np.uint64), np.array([10 ** 9], np.uint64), np.arange(8, dtype=np.uint64)]:
        got = dict(zip(*sample.links(g)))
        want = {i: len(np.intersect1d(g, s)) / len(np.union1d(g, s)) for i, s in enumerate(sets)} if len(g) else {}
        want = {i: s for i, s in want.items() if s >= 0.4}
        assert got == pytest.approx(want)
    assert N.Sample([], 0.8).links(sets[0]) == ([], [])


def test_signatures_agree_as_often_as_sets():
    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[500:])
    same = np.mean(np.frombuffer(N.signature(a).tobytes(), np.uint8) == np.frombuffer(N.signature(b).tobytes(), np.uint8))
    assert abs(same - 1 / 3) < 0.1


def test_components(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + k) for k in range(1, 80)] + [
        (r.randrange(2000, 2200), r.randrange(2000, 2200)) for _ in range(150)] + [(7, 7), (3, 2), (3, 2)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_repeated_rows_reach_a_block_once(spark, monkeypatch):
    """Of rows that repeat a document (null ids too) one text is compared."""
    verify = N._verify

    def once(threshold):
        run = verify(threshold)

        def checked(key, rows):
            if len(set(rows["node"].to_pylist())) < rows.num_rows:
                raise ValueError("repeated texts in one group")
            return run(key, rows)
        return checked
    monkeypatch.setattr(N, "_verify", once)
    a, b = prose(100, 11), prose(100, 12)
    rows = [(1, a)] * 30 + [(2, a + " end")] + [(None, b)] * 30 + [(3, b + " end"), (None, b + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in N.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, 30)] * 30 + [(2, 1, 30)] + [(None, 3, 31)] * 30 + [(3, 3, 31), (None, 3, 31)], key=str)
