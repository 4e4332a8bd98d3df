import random
import uuid

from pyspark.sql import functions as F

from matchlake.sources import keydict as K
from matchlake.sources import published as P


def dictionary(spark, path):
    db = f"t{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    K.create_dictionary(spark, f"{db}.keys", f"file://{path}")
    return f"{db}.keys"


def test_ids_are_dense_and_stay(spark, tmpdir_path):
    name, r, want = dictionary(spark, tmpdir_path), random.Random(5), {}
    for load in range(4):
        keys = [f"k{r.randrange(400)}" for _ in range(300)] + ["hot"] * 500 + [None]
        new = sorted(set(keys[:-1]) - set(want))
        rows = spark.createDataFrame([(k,) for k in keys], "k STRING").repartition(7)
        assert K.extend(spark, name, F.col("k"), rows, f"load{load}") == len(new)
        assert K.extend(spark, name, F.col("k"), rows, f"load{load}") == 0
        want.update([(k, len(want) + i) for i, k in enumerate(new)])
        assert {x.natural: x.id for x in spark.table(name).collect()} == want


def test_keys_that_collide_are_told_apart(spark, tmpdir_path):
    name = dictionary(spark, tmpdir_path)
    narrow = lambda c: F.length(c).cast("bigint")                       # noqa: E731
    rows = spark.createDataFrame([("ab",), ("cd",), ("x",)], "k STRING")
    K.extend(spark, name, F.col("k"), rows, "one", narrow)
    K.extend(spark, name, F.col("k"), spark.createDataFrame([("ef",), ("ab",)], "k STRING"), "two", narrow)
    assert [tuple(x) for x in K.collisions(spark.table(name)).collect()] == [(2, 3, "ab", "ef")]
    facts = spark.createDataFrame([("ef", 1), ("ab", 2), ("none", 3), (None, 4)], "k STRING, v INT")
    got = {x.v: x.id for x in K.with_ids(facts, F.col("k"), spark.table(name), "id").collect()}
    assert got == {1: 3, 2: 0, 3: None, 4: None}


def test_a_failed_load_leaves_no_ids(spark, tmpdir_path, monkeypatch):
    name = dictionary(spark, tmpdir_path)
    K.extend(spark, name, F.col("k"), spark.createDataFrame([("b",)], "k STRING"), "one")
    rows = spark.createDataFrame([("a",), ("c",)], "k STRING")
    for step in ("staged", "registered"):
        def fail(at, step=step):
            if at == step:
                raise RuntimeError(step)
        monkeypatch.setattr(P, "after", fail)
        try:
            K.extend(spark, name, F.col("k"), rows, "two")
            raise AssertionError
        except RuntimeError:
            pass
        assert [x.natural for x in spark.table(name).collect()] == ["b"]
    monkeypatch.setattr(P, "after", lambda at: None)
    assert K.extend(spark, name, F.col("k"), rows, "two") == 2
    assert sorted((x.id, x.natural) for x in spark.table(name).collect()) == [(0, "b"), (1, "a"), (2, "c")]


def test_nothing_to_number(spark, tmpdir_path):
    name = dictionary(spark, tmpdir_path)
    assert K.extend(spark, name, F.col("k"), spark.createDataFrame([], "k STRING"), "none") == 0
    assert K.collisions(spark.table(name)).count() == 0
