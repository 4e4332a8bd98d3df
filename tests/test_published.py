import uuid

import pytest
from pyspark.sql import functions as F

from matchlake.sources import published as P


@pytest.fixture()
def table(spark, tmpdir_path):
    db = f"p{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    P.create_published(spark, f"{db}.t", "id BIGINT, tags ARRAY<STRING>, month STRING", "month", f"file://{tmpdir_path}/t")
    return f"{db}.t"


def rows(spark, *pairs):
    return spark.createDataFrame([(i, [str(i)], m) for i, m in pairs], "id long, tags array<string>, month string")


def content(spark, name):
    return sorted(((r.id, r.month) for r in spark.table(name).collect()), key=str)


def test_append_and_replace(spark, table):
    assert content(spark, table) == []
    P.append(spark, table, rows(spark, (1, "a"), (2, "b"), (3, None)))
    before = spark.table(table)
    P.append(spark, table, rows(spark, (4, "b"), (5, "c")), load="it's \\ x")
    assert content(spark, table) == sorted([(1, "a"), (2, "b"), (3, None), (4, "b"), (5, "c")], key=str)
    P.replace_parts(spark, table, rows(spark, (9, "b"), (8, None)), ["b", "a", None])
    assert content(spark, table) == sorted([(9, "b"), (8, None), (5, "c")], key=str)
    assert before.count() == 3                      # a frame keeps its version
    assert P.properties(spark, table)["load"] == "it's \\ x"
    assert spark.table(table).schema == spark.table(P.properties(spark, table)["current"]).drop("version").schema
    plan = spark.table(table).where("month = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


@pytest.mark.parametrize("step", ["staged", "registered", "published"])
def test_a_failure_leaves_old_or_new_content(spark, table, monkeypatch, step):
    old = [(i, "abc"[i % 3]) for i in range(9)]
    P.append(spark, table, rows(spark, *old))

    def fail(at):
        if at == step:
            raise RuntimeError(at)
    monkeypatch.setattr(P, "after", fail)
    new = [(i + 100, "abd"[i % 3]) for i in range(9)]
    with pytest.raises(RuntimeError):
        P.replace_parts(spark, table, rows(spark, *new), ["a", "b", "d"])
    monkeypatch.undo()
    now = sorted([*[r for r in old if r[1] == "c"], *new], key=str)
    assert content(spark, table) == (now if step == "published" else sorted(old, key=str))
    P.replace_parts(spark, table, rows(spark, *new), ["a", "b", "d"])     # a repeat ends as if nothing had happened
    assert content(spark, table) == now


def test_old_versions_go(spark, table, tmpdir_path):
    import glob
    for i in range(6):
        P.replace_parts(spark, table, rows(spark, (i, "a")), ["a"])
    assert content(spark, table) == [(5, "a")]
    assert len(glob.glob(f"{tmpdir_path}/t/data/month=a/version=*")) == 3
    assert len(P.properties(spark, table)["versions"].split(",")) == 3


def test_pack():
    sizes = {("a", "1"): 60, ("a", "2"): 50, ("a", "3"): 40, ("a", "4"): 30, ("b", "1"): 10, ("c", "1"): 200, ("c", "2"): 1, ("c", "3"): 2}
    assert P.pack(sizes, 100) == [[("a", "1"), ("a", "3")], [("a", "2"), ("a", "4")], [("c", "3"), ("c", "2")]]


def test_compaction_after_thirty_loads(spark, table, monkeypatch):
    """Folders and files per month stay bounded, rows are unchanged, readers never meet an empty table."""
    want = []
    for load in range(30):
        batch = [(load * 10 + i, "abc"[(load + i) % 3]) for i in range(3)]
        want += batch
        P.append(spark, table, rows(spark, *batch))
        if load % 10 == 9:
            before = spark.table(table)
            seen = []
            monkeypatch.setattr(P, "after", lambda step: seen.append(spark.table(table).count()))
            assert P.compact(spark, table) > 3
            monkeypatch.undo()
            assert set(seen) == {len(want)} and before.count() == len(want)
            assert len(P.parts(spark, table)) == 3
            assert spark.table(table).select(F.input_file_name()).distinct().count() == 3
        assert len(P.parts(spark, table)) <= 3 * 11
    assert content(spark, table) == sorted(want, key=str)
    assert P.compact(spark, table) == 0
