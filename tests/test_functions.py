import duckdb
import pytest
from pyspark.sql import functions as F

from matchlake.functions import (encode_tag, is_weekend, list_avg, list_key, md5_key,
                                 mirror_cost, month_day_year, parse_battle_time, slots)
from matchlake.functions.arrays import flatten_struct


def test_md5_key_matches_sql_formula(spark):
    vals = ["#ABC", "Customer#000000001", ""]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "t string")
           .select(md5_key("t")).collect()]
    want = [duckdb.execute(f"SELECT CAST('0x' || substr(md5('{v}'), 1, 15) AS BIGINT)").fetchone()[0]
            for v in vals]
    assert got == want
    assert spark.range(1).select(md5_key(F.lit(None).cast("string"))).first()[0] is None


def test_list_key_keeps_nulls_apart(spark):
    df = spark.sql("SELECT array('a', NULL, 'b') AS x, array('a', 'b') AS y, array('b', 'a') AS z")
    r = df.select(list_key("x").alias("x"), list_key("y").alias("y"), list_key("z").alias("z")).first()
    assert len({r.x, r.y, r.z}) == 3


def test_slots_pad_and_cut(spark):
    df = spark.sql("""SELECT array(named_struct('name','a'), named_struct('name','b')) AS short,
                      transform(sequence(1, 9), i -> named_struct('name', cast(i AS string))) AS long""")
    r = df.select(slots("short", "name").alias("s"), slots("long", "name").alias("l")).first()
    assert r.s == ["a", "b"] + [None] * 6
    assert r.l == [str(i) for i in range(1, 9)]


def test_list_avg_ignores_nulls(spark):
    r = spark.sql("SELECT array(2, NULL, 4) a, array(CAST(NULL AS INT)) b").select(
        list_avg("a").alias("a"), list_avg("b").alias("b")).first()
    assert r.a == 3.0 and r.b is None


def test_mirror_cost(spark):
    df = spark.sql("""SELECT array(named_struct('name','Mirror','level',1L,'elixirCost',3,'x',1),
                                   named_struct('name','Knight','level',2L,'elixirCost',3,'x',1)) c""")
    r = df.select(mirror_cost("c").alias("c")).first().c
    assert [tuple(x) for x in r] == [("Mirror", 1, None), ("Knight", 2, 3)]


def test_parse_battle_time_precisions_and_strictness(spark):
    df = spark.createDataFrame([("20231201T101010.000Z",), ("20231201T101010.123456Z",)], "t string")
    got = [r[0] for r in df.select(parse_battle_time("t")).collect()]
    assert got[0].microsecond == 0 and got[1].microsecond == 123456
    bad = spark.createDataFrame([("garbage",)], "t string")
    assert bad.select(parse_battle_time("t", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        bad.select(parse_battle_time("t")).collect()


def test_weekend_and_display(spark):
    df = spark.sql("SELECT explode(array(DATE'2023-12-02', DATE'2023-12-03', DATE'2023-12-04')) d")
    rows = df.select(is_weekend("d").alias("w"), month_day_year("d").alias("m")).collect()
    assert [r.w for r in rows] == ["yes", "yes", "no"]
    assert rows[0].m == "December 2, 2023"


def test_encode_tag(spark):
    assert spark.sql("SELECT '#ABC' t").select(encode_tag("t")).first()[0] == "%23ABC"


def test_flatten_struct(spark):
    df = spark.sql("SELECT 1 a, named_struct('b', 2, 'c', named_struct('d', 3)) s, array(1) l")
    out = flatten_struct(df)
    assert out.columns == ["a", "s_b", "s_c_d", "l"]
    assert tuple(out.first()) == (1, 2, 3, [1])
