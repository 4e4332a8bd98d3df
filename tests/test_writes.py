import pytest
from pyspark.sql import functions as F

from matchlake.operators import insert_ignore, upsert

T = "k STRING, k2 STRING, v INT, w STRING"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_ignore_semantics(spark):
    target = spark.createDataFrame([("a", "x", 1, "t"), ("b", None, 2, "t")], T)
    batch = spark.createDataFrame(
        [("a", "x", 9, "b"),          # existing key: ignored
         ("c", "x", 3, "first"),      # duplicate in batch: first in load order wins
         ("c", "x", 4, "second"),
         ("b", None, 5, "b")],        # NULL key part never matches: inserted
        T)
    new = insert_ignore(target, batch, ["k", "k2"], order=[F.col("v")])
    assert rows(new) == [("b", None, 5, "b"), ("c", "x", 3, "first")]
    # idempotent: loading the same batch again after the append adds nothing
    after = target.unionByName(new)
    again = insert_ignore(after, batch, ["k", "k2"], order=[F.col("v")])
    assert rows(again) == [("b", None, 5, "b")]  # NULL keys are always new


def test_insert_ignore_by_name_fills_missing(spark):
    target = spark.createDataFrame([("a", "x", 1, "t")], T)
    batch = spark.createDataFrame([("z", "y")], "k2 STRING, k STRING")
    assert rows(insert_ignore(target, batch, ["k", "k2"], order=[F.col("k")])) == [("y", "z", None, None)]


def test_upsert_semantics(spark):
    target = spark.createDataFrame([("a", "x", 1, "keep"), ("b", "x", 2, "keep")], T)
    # batch lacks column w; explicit NULL in v wins; new key appended
    batch = spark.createDataFrame([("a", "x", None), ("c", "x", 3)], "k STRING, k2 STRING, v INT")
    out = upsert(target, batch, ["k", "k2"], [F.col("v")])
    assert rows(out) == [("a", "x", None, "keep"), ("b", "x", 2, "keep"), ("c", "x", 3, None)]
    assert rows(upsert(out, batch, ["k", "k2"], [F.col("v")])) == rows(out)  # idempotent


def test_upsert_last_in_batch_wins(spark):
    target = spark.createDataFrame([("a", "x", 1, "t")], T)
    batch = spark.createDataFrame([("a", "x", 6, "q"), ("a", "x", 5, "p")], T)
    out = upsert(target, batch, ["k", "k2"], order=[F.col("v")])
    assert rows(out) == [("a", "x", 6, "q")]


def test_upsert_null_keys_bypass_join(spark):
    target = spark.createDataFrame([("a", "x", 1, "t"), (None, "x", 2, "t")], T)
    batch = spark.createDataFrame([(None, "x", 3, "b"), ("a", "x", 4, "b")], T)
    out = upsert(target, batch, ["k", "k2"], [F.col("v")])
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted([("a", "x", 4, "b"), (None, "x", 2, "t"), (None, "x", 3, "b")], key=repr)


def test_load_order_is_required(spark):
    batch = spark.createDataFrame([("a", "x", 1, "t"), ("a", "x", 2, "u")], T)
    for write in (insert_ignore, upsert):
        with pytest.raises(ValueError):
            write(batch, batch, ["k", "k2"])


def test_last_wins_whatever_the_partitions(spark):
    target = spark.createDataFrame([], T)
    batch = spark.createDataFrame([("a", "x", i, str(i)) for i in range(50)], T)
    for n in (1, 7):
        assert rows(upsert(target, batch.repartition(n), ["k", "k2"], [F.col("v")])) == [("a", "x", 49, "49")]
        assert rows(insert_ignore(target, batch.repartition(n), ["k", "k2"], [F.col("v")])) == [("a", "x", 0, "0")]


def test_positional_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("c", 3)], "x string, y int")      # other names
    assert rows(upsert(target, batch, ["k"], [F.col("v")], by_name=False)) == [("a", 9), ("b", 2), ("c", 3)]


def test_pruned_load_reads_only_the_batch_months(spark, tmpdir_path):
    """Partitions outside the batch's months hold garbage: reading one would fail."""
    import glob
    rows_ = [(f"k{m:02d}", f"2020{m:02d}") for m in range(1, 13)]
    path = f"{tmpdir_path}/stored"
    spark.createDataFrame(rows_, "k string, month string").repartition("month").write.partitionBy("month").parquet(path)
    for m in (1, 2, 3, 7, 8, 9, 10, 11, 12):
        for f in glob.glob(f"{path}/month=2020{m:02d}/part-*"):
            with open(f, "wb") as out:
                out.write(b"garbage")
    target = spark.read.schema("k string, month string").option("ignoreCorruptFiles", False).parquet(path)
    batch = spark.createDataFrame([("k04", "202004"), ("new", "202006"), ("new", "202005")], "k string, month string")
    new = insert_ignore(target, batch, ["k", "month"], [F.col("k")], prune_on="month")
    assert rows(new) == [("new", "202005"), ("new", "202006")]
    with pytest.raises(Exception):
        insert_ignore(target, batch, ["k", "month"], [F.col("k")]).collect()
