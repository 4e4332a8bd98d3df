import random
import uuid

import pytest

from matchlake.sources import buckets as B
from matchlake.sources import published as P
from pyspark.sql import functions as F

DDL = "tag STRING, name STRING, wins INT"


@pytest.fixture()
def table(spark, tmpdir_path):
    db = f"b{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    B.create_growing(spark, f"{db}.t", DDL, f"file://{tmpdir_path}/t", bucket_rows=40)
    return f"{db}.t"


def test_growth_moves_only_the_split_bucket():
    for n in range(1, 70):
        for h in range(300):
            a, b = B.address(h, n), B.address(h, n + 1)
            assert 0 <= a < n and (a == b or (b == n and a == B.address(n, n)))


def test_address_is_the_column(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("tag"))
    for n in (1, 2, 3, 5, 8, 13):
        got = df.select(F.xxhash64("tag").alias("h"), B.bucket_of(["tag"], n).alias("b")).collect()
        assert all(r.b == B.address(r.h, n) for r in got)
        assert {r.b for r in got} == set(range(n))


def test_ten_loads(spark, table):
    """Rows as a dictionary holds them; buckets grow with the table and stay bounded."""
    r, want, nulls, sizes = random.Random(3), {}, [], []
    for load in range(10):
        batch = [(None if r.random() < 0.01 else f"p{r.randrange(60 * (load + 1))}", f"n{load}.{i}", i) for i in range(60)]
        out = B.upsert_growing(spark, table, spark.createDataFrame(batch, DDL), ["tag"], [F.col("wins")])
        new = {}
        for tag, name, wins in batch:
            new[tag] = (name, wins)         # the last of the load
        if None in new:
            nulls.append((None, *new.pop(None)))
        assert out["replaced"] == len(set(new) & set(want))
        want.update(new)
        rows = [tuple(x) for x in spark.table(table).select("tag", "name", "wins").collect()]
        assert sorted(rows, key=str) == sorted([(k, *v) for k, v in want.items()] + nulls, key=str)
        per = {x[0]: x[1] for x in spark.table(table).groupBy(B.BUCKET).count().collect()}
        assert max(per.values()) <= 3 * 40 and set(per) <= set(range(out["buckets"]))
        sizes.append(out["buckets"])
    assert sizes == sorted(sizes) and sizes[-1] >= 6
    assert int(P.properties(spark, table)["rows"]) == len(want) + len(nulls)


def test_a_small_batch_rewrites_few_buckets(spark, table):
    rows = spark.range(2000).select(F.concat(F.lit("p"), "id").alias("tag"), F.lit("x").alias("name"), F.lit(1).alias("wins"))
    first = B.upsert_growing(spark, table, rows, ["tag"], [F.col("wins")])
    assert first == {"replaced": 0, "inserted": 2000, "buckets": 50, "written": 50}
    before = set(P.parts(spark, table))
    out = B.upsert_growing(spark, table, rows.limit(3).withColumn("wins", F.lit(2)), ["tag"], [F.col("wins")])
    assert out["replaced"] == 3 and out["inserted"] == 0 and out["written"] <= 3
    assert len(before - set(P.parts(spark, table))) <= 3
    assert spark.table(table).where("wins = 2").count() == 3 and spark.table(table).count() == 2000


def test_by_position_and_partial_columns(spark, table):
    B.upsert_growing(spark, table, spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, v string, w int"),
                     ["tag"], [F.col("wins")], by_name=False)
    B.upsert_growing(spark, table, spark.createDataFrame([("a", 5, 9)], "tag string, wins int, extra int"), ["tag"], [F.col("extra")])
    assert sorted(tuple(r)[:3] for r in spark.table(table).collect()) == [("a", "x", 5), ("b", "y", 2)]


@pytest.mark.parametrize("step", ["staged", "registered", "published"])
def test_failures(spark, table, monkeypatch, step):
    first = spark.createDataFrame([(f"p{i}", "old", i) for i in range(100)], DDL)
    B.upsert_growing(spark, table, first, ["tag"], [F.col("wins")])
    second = spark.createDataFrame([(f"p{i}", "new", i) for i in range(50, 200)], DDL)
    old = {f"p{i}": "old" for i in range(100)}
    new = {**old, **{f"p{i}": "new" for i in range(50, 200)}}

    def fail(at):
        if at == step:
            raise RuntimeError(at)
    monkeypatch.setattr(P, "after", fail)
    with pytest.raises(RuntimeError):
        B.upsert_growing(spark, table, second, ["tag"], [F.col("wins")])
    monkeypatch.undo()
    assert {r.tag: r["name"] for r in spark.table(table).collect()} == (new if step == "published" else old)
    B.upsert_growing(spark, table, second, ["tag"], [F.col("wins")])
    assert {r.tag: r["name"] for r in spark.table(table).collect()} == new and spark.table(table).count() == 200
