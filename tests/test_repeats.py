"""Rows whose key comes once pass without a shuffle; the others give the same result as before."""

import json
import random

import pytest
from pyspark.sql import functions as F

from matchlake.operators import repeats
from matchlake.operators.writes import dedupe_batch, dedupe_stored
from matchlake.plans import incremental as I
from matchlake.plans import models as M
from matchlake.plans import refresh as RF
from matchlake.plans import registry as Q
from tests.conftest import SF_SMALL


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_log(spark, tmp_path_factory):
    """A stored log with battles that come twice, whole or in part, and players who meet themselves."""
    log = Q.Game(spark, SF_SMALL).log
    n = F.xxhash64("battleTime", "team_tag", "opponent_tag") % 7
    odd = log.unionByName(log.where(n == 1)).unionByName(log.where(n == 2).withColumn("opponent_crowns", F.lit(9).cast("long"))) \
             .unionByName(log.where(n == 3).withColumns({c.replace("team_", "opponent_"): F.col(c) for c in log.columns if c.startswith("team_")})) \
             .unionByName(log.where(n == 4).withColumn("team_tag", F.lit(None).cast("string")))
    path = str(tmp_path_factory.mktemp("log") / "log")
    odd.write.parquet(path)
    return spark.read.schema(log.schema).parquet(path)


def test_stored_facts_are_the_distinct_facts(spark, odd_log, monkeypatch):
    want = bag(M.fct_battle(odd_log))
    assert bag(M.fct_battle_stored(odd_log)) == want
    monkeypatch.setattr(repeats, "BROADCAST_KEYS", 0)       # too many to send to every task
    assert bag(M.fct_battle_stored(odd_log)) == want


def test_facts_of_battles_that_come_once_are_not_shuffled(spark):
    log = Q.Game(spark, SF_SMALL).log.dropDuplicates(["battleTime", "team_tag", "opponent_tag"])
    path = Q.shared_dir(spark, "once")
    log.write.parquet(path)
    once, rest = M.fct_battle_parts(spark.read.schema(log.schema).parquet(path))
    assert rest is None or rest.count() == 0
    assert "hashpartitioning" not in plan(once) and "HashAggregate" not in plan(once)


def test_dedupe_of_a_stored_batch(spark, tmpdir_path):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None, *map(str, range(40))]), r.choice([None, 1, 2]), r.randrange(5), r.random()) for _ in range(300)]
    spark.createDataFrame(rows, "k STRING, k2 INT, v INT, w DOUBLE").write.parquet(f"{tmpdir_path}/b")
    batch = spark.read.parquet(f"{tmpdir_path}/b")
    for keep in ("first", "last"):
        assert bag(dedupe_stored(batch, ["k", "k2"], [F.col("v")], keep)) == bag(dedupe_batch(batch, ["k", "k2"], [F.col("v")], keep))
    with pytest.raises(ValueError):
        dedupe_stored(batch, ["k"], [])
    one = spark.range(100).withColumn("v", F.col("id"))
    assert "Exchange hashpartitioning" not in plan(dedupe_stored(one, ["id"], [F.col("v")]))


def test_battles_of_new_months_meet_no_stored_keys(spark, tmpdir_path):
    """Without a month in common, the load's rows are not joined with the log."""
    db = f"t{Q.uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    store = I.Store(f"{db}.log", f"{db}.facts", f"{db}.dates", f"{db}.decks")
    I.create(spark, store, tmpdir_path, Q.FIXTURE_DECK_CATEGORIES)
    log = Q.Game(spark, SF_SMALL).log
    I.load(spark, store, log.where("battleTime < '1998'"), RF.log_order(), load_id="a")
    new = I.new_battles(spark, store, log.where("battleTime >= '1999'").withColumn(I.MONTH, F.substring("battleTime", 1, 6)), RF.log_order())
    assert "LeftAnti" not in plan(new)
    whole = log.withColumn(I.MONTH, F.substring("battleTime", 1, 6))
    late = I.new_battles(spark, store, whole, RF.log_order())
    assert late.where("battleTime < '1998'").count() == 0
    keys = ["battleTime", "team_tag", "opponent_tag"]
    assert late.count() == log.where("battleTime >= '1998'").dropDuplicates(keys).count()


def test_landed_text_is_compressed(spark):
    import glob
    import os
    base = Q.shared_dir(spark)
    root = base.removeprefix("file:").rpartition("/")[0]
    for query, folder in (("stream_ingest", "stream-*/landing"), ("landed_battles", "landed-battles-*")):
        Q.QUERIES[query](spark, SF_SMALL)
        files = [f for f in glob.glob(f"{root}/{folder}/part-*")]
        assert files and all(os.path.basename(f).endswith(".gz") for f in files)


def test_landed_arrays_do_not_grow_with_the_log(spark, tmpdir_path, monkeypatch):
    """However many battles a task reads, an array has a player's log of them, and none is lost."""
    log = Q.Game(spark, SF_SMALL).log
    log.crossJoin(spark.range(12)).drop("id").coalesce(1).write.parquet(f"{tmpdir_path}/log")
    many = spark.read.schema(log.schema).parquet(f"{tmpdir_path}/log").coalesce(1)
    once = Q.q_landed_battles(spark, SF_SMALL)
    monkeypatch.setattr(Q.Game, "log", property(lambda g: many))
    got = Q.q_landed_battles(spark, SF_SMALL)
    sizes = [r[0] for r in spark.read.text(got.inputFiles()).select(F.json_array_length("value")).collect()]
    assert max(sizes) <= 250 and sum(sizes) == many.count() > 12 * 250
    assert sizes.count(250) >= len(sizes) - len(got.inputFiles())       # only a task's last array is shorter
    assert bag(got) == sorted(bag(once) * 12, key=repr)


def test_battles_are_put_into_arrays_without_a_shuffle(spark):
    docs = spark.range(0, 1003, 1, 2).select(F.when(F.col("id") != 7, F.format_string('{"leagueNumber":%d}', "id")).alias("value"))
    arrays = Q.battle_arrays(docs, 100)
    assert "Exchange" not in plan(arrays) and "Aggregate" not in plan(arrays)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")       # an array goes on over batches
    try:
        found = [[d["leagueNumber"] for d in json.loads(r.value)] for r in arrays.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(x for f in found for x in f) == [x for x in range(1003) if x != 7]
    assert sorted(map(len, found)) == [2] + [100] * 10
    assert Q.battle_arrays(docs.limit(0)).collect() == []
