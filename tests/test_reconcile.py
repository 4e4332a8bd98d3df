import itertools
import os

import pytest
from pyspark.sql import types as T

from matchlake.schemas import struct
from matchlake.sources import reconcile as R

KINDS = [T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2),
         T.DecimalType(38, 0), T.StringType(), T.NullType(), T.BooleanType()]


def test_the_order_of_dumps_does_not_change_a_type():
    for kinds in itertools.product(KINDS, repeat=3):
        made = set()
        for order in itertools.permutations(kinds):
            schema, conflicts = R.reconcile({str(i): T.StructType([T.StructField("a", k)]) for i, k in enumerate(order)})
            made.add((schema["a"].dataType.simpleString(), bool(conflicts)))
        assert len(made) == 1, kinds


def test_widening_keeps_every_value():
    assert R.wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert R.wider(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert R.wider(T.LongType(), T.DoubleType()) is None            # 2**53 + 1
    assert R.wider(T.IntegerType(), T.DecimalType(5, 2)) == T.DecimalType(12, 2)
    assert R.wider(T.DecimalType(38, 0), T.DecimalType(38, 2)) is None


def test_parquet_dumps_with_moved_added_and_widened_columns(spark, tmpdir_path):
    def dump(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmpdir_path}/{name}")
        return f"{tmpdir_path}/{name}"
    dumps = {"a": dump("a", [("x", 1, [1])], "`t.g` STRING, n INT, l ARRAY<INT>"),
             "b": dump("b", [(2 ** 40, "y", 7)], "N BIGINT, `t.g` STRING, l INT"),
             "c": dump("c", [("z", None, [3], True)], "`t.g` STRING, n INT, l ARRAY<INT>, more BOOLEAN"),
             "d": dump("d", [("w", 4, None)], "`t.g` STRING, n INT, l ARRAY<INT>"),
             "e": dump("e", [], "`t.g` STRING")}
    rows, conflicts = R.read_dumps(spark, dumps)
    assert rows.schema == struct("`t.g` STRING, n BIGINT, l STRING, more BOOLEAN")
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("w", 4, None, None), ("x", 1, "[1]", None), ("y", 2 ** 40, "7", None), ("z", None, "[3]", True)]
    assert sorted(map(tuple, conflicts.collect())) == [
        ("l", "a", "array<int>"), ("l", "b", "int"), ("l", "c", "array<int>"), ("l", "d", "array<int>")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4        # a and d, of one schema, are one scan


def test_csv_types_come_from_all_values(spark, tmpdir_path):
    texts = {"a.csv": "id,code,n,flag,none\n1,007,3,true,\n2,8,,false,\n", "b.csv": "n,id,code,late\n2.5,3,9,x\n,123456789012,1,y\n",
             "c.csv": "id,code,n,flag,none\n5,1,4,,\n"}
    for name, text in texts.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    rows, conflicts = R.read_dumps(spark, {n: f"{tmpdir_path}/{n}" for n in texts}, "csv")
    assert rows.schema == struct("id BIGINT, code STRING, n DOUBLE, flag BOOLEAN, none STRING, late STRING")
    assert sorted(map(tuple, rows.collect())) == [
        (1, "007", 3.0, True, None, None), (2, "8", None, False, None, None), (3, "9", 2.5, None, None, "x"),
        (5, "1", 4.0, None, None, None), (123456789012, "1", None, None, None, "y")]
    assert sorted(map(tuple, conflicts.collect())) == [("code", "a.csv", "string"), ("code", "b.csv", "int"), ("code", "c.csv", "string")]


def test_what_is_refused(spark):
    with pytest.raises(ValueError, match="no dumps"):
        R.read_dumps(spark, {})
    with pytest.raises(ValueError, match="two columns"):
        R.reconcile({"a": struct("x INT").add("X", T.IntegerType())})
