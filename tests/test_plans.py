"""Plan checks: pruning reaches the scan, no Python in any operator plan."""

import pytest

from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pk_violation_scan_reads_two_columns(spark):
    from matchlake.plans.registry import q_pk_violations
    p = plan(q_pk_violations(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p


def test_orders_filter_pushed_to_scan(spark):
    from matchlake.plans.registry import _stats_pair
    t, _ = _stats_pair(spark, SF_SMALL)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan(t)


@pytest.mark.parametrize("name", ["card_usage_by_rarity", "deck_usage_trend", "fct_battle",
                                  "parse_battle_log", "orphan_facts", "top_players_per_season"])
def test_no_python_udf(spark, name):
    import __spark_entry__ as E
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert bad not in p


def test_lineitem_is_shuffled_without_the_card_names(spark):
    """Cards meet part first; lineitem is joined once, by part key."""
    from matchlake.sources import fixtures as fx
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(fx.battle_log(fx.load_star(spark, SF_SMALL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_partkey" in p
    scan = [x for x in p.split("\n") if "lineitem.parquet" in x]
    assert len(scan) == 1 and "l_extendedprice" not in scan[0]


def scanned(df, table):
    df.collect()
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x and f"game/{table}" in x]


def test_reports_scan_only_their_columns(spark):
    from matchlake.plans import registry as Q
    g = Q.Game(spark, SF_SMALL)
    usage = scanned(Q.R.card_usage(g.fct(), g.deck(), g.card_dim(), "rarity"), "fct_battle")
    assert usage and all("ReadSchema: struct<deck_id:bigint>" in x for x in usage)
    arena = scanned(Q.R.elixir_cost_by_arena(g.fct(), g.deck()), "fct_battle")
    assert arena and all("ReadSchema: struct<player_id:bigint,deck_id:bigint,arena_name:string>" in x for x in arena)
    orphans = scanned(Q.q_orphan_facts(spark, SF_SMALL), "fct_battle")
    assert orphans and all("cards" not in x.split("ReadSchema")[1] for x in orphans)


def test_the_window_reaches_the_fact_scan(spark):
    from matchlake.plans import registry as Q
    scans = scanned(Q._daily(Q.Game(spark, SF_SMALL)), "fct_battle")
    assert scans
    for x in scans:
        assert "battle_month" in x.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert "GreaterThan(date_id,20010503)" in x


def test_only_the_months_of_the_window_are_read(spark, tmpdir_path):
    import glob
    from matchlake.plans import registry as Q
    from matchlake.plans import refresh as RF
    g = Q.Game(spark, SF_SMALL)
    path = f"{tmpdir_path}/facts"
    g.fct().repartition("battle_month").write.partitionBy("battle_month").parquet(path)
    for f in glob.glob(f"{path}/battle_month=*/part-*"):
        if f.split("battle_month=")[1][:6] < "200105":
            with open(f, "wb") as out:
                out.write(b"garbage")
    facts = spark.read.schema(g.fct().schema).parquet(path)
    got = Q.R.deck_usage_daily(facts, g.deck(), g.dates(), as_of=Q.AS_OF)
    assert got.count() == Q._daily(g).count() > 0
    assert RF.BATTLE_MONTH in facts.columns
