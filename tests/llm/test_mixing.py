from collections import defaultdict

import pytest

from matchlake.llm import mixing


def plain_targets(sizes):
    """Targets by resharing the excess round by round."""
    names = sorted({s for s, _ in sizes if s is not None}) + ([None] if any(s is None for s, _ in sizes) else [])
    total = sum(n for _, n in sizes)
    own = {s: sum(n for t, n in sizes if t == s) for s in names}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    fixed, free = {}, set(names)
    while free:
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w >= 3 * own[s]}
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: 3.0 * own[s] for s in over}
        free -= over
    return fixed


def check(plan, rows):
    sizes = [(s, len((t or "").encode().split())) for _, s, t in rows]
    want = plain_targets(sizes)
    got = plan.collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r["size"] <= 3 * r["size"]
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies + 1e-9 and r.copies <= int(rate) + 1 or r["size"] == 0
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s]
    return got


def test_targets_and_rounding(small_docs):
    rows = [(r.doc_id, r.source, r.text) for r in small_docs.collect()]
    one = check(mixing.mix_plan(small_docs), rows)
    two = mixing.mix_plan(small_docs.repartition(7)).collect()
    assert sorted(one) == sorted(two)                       # reruns agree, whatever the partitions


def test_groups_and_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i * 37 % 90)) for i in range(900)]
    check(mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, source string, text string")), rows)


def test_expected_copies(spark):
    """Over many seeds a document's mean copies come near target / size."""
    rows = [(i, s, "w " * (5 + i)) for i in range(12) for s in ("a", "b")]
    sizes = spark.createDataFrame([(i, s, 5 + i) for i, s, _ in rows], "doc_id long, source string, size long").cache()
    targets = mixing.source_targets(sizes).cache()
    rate = {r.src: r.target / r.source_size for r in targets.collect()}
    sums = defaultdict(int)
    for src, p in ((src, r - int(r)) for src, r in rate.items()):
        for seed in range(400):
            prob = [p] * 12
            held = mixing._duel([float(5 + i) for i in range(12)], prob, mixing._draws(seed, 0, src, 0, 12))
            if held is not None:
                prob[held] = float(prob[held] >= 0.5)
            for i, x in enumerate(prob):
                sums[src, i] += x
        for i in range(12):
            assert abs(sums[src, i] / 400 - p) < 0.12
    sizes.unpersist(), targets.unpersist()


def test_edge_cases(edge_docs, edge_rows, no_docs):
    check(mixing.mix_plan(edge_docs), [(r[0], r[3], r[1]) for r in edge_rows])
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.mix_plan(edge_docs).collect())
    assert mixing.mix_plan(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


def test_sources_without_words(spark):
    """A source of empty texts takes nothing and leaves the others as they are; so does a table of them."""
    none = [(1, "a", None), (2, "a", ""), (3, None, " \t\n"), (4, "c", "")]
    rows = none + [(i, "bd"[i % 2], "w " * (1 + i * 7 % 30)) for i in range(10, 60)]
    schema = "doc_id long, source string, text string"
    check(mixing.mix_plan(spark.createDataFrame(rows, schema)), rows)
    empty = spark.createDataFrame(none, schema)
    got = mixing.mix_plan(empty).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4] and all(r.copies == r.taken == r.target == 0 for r in got)
    assert mixing.mix(empty).collect() == []


def test_thousands_of_equal_rows(spark, monkeypatch):
    """Each source ends within one row of its target, also where one row is most of a source, or its id is null."""
    rows = [(None, "a", "w " * 1000)] * 50 + [(i, "b", "w " * (1 + i % 40)) for i in range(2000)]
    rows += [(7, "c", "x y z")] * 3000 + [(i % 5, "c", "v " * (i % 5)) for i in range(40)] + [(9, None, "q " * 30)] * 70
    schema = "doc_id long, source string, text string"
    docs = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(mixing, "CHUNK", 1000)
    got = check(mixing.mix_plan(docs.repartition(5)), rows)
    again = mixing.mix_plan(docs.repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = defaultdict(int)
    for r in mixing.mix(docs).collect():
        mixed[r.doc_id, r.source, len(r.text.split())] += 1
    want = defaultdict(int)
    for r in got:
        want[r.doc_id, r.source, r["size"]] += r.copies
    assert dict(mixed) == {k: n for k, n in want.items() if n}
