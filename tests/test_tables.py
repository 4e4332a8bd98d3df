"""Table-level writes: pruned keyed loads, positional inserts, COPY-style
appends, atomic upsert swaps, refresh idempotence, skewed top-k."""

from pyspark.sql import functions as F

from matchlake import schemas as S
from matchlake.operators import insert_ignore, top_k_per_group
from matchlake.plans import refresh as RF
from matchlake.sources import catalog as C
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pruned_insert_ignore_equals_unpruned(spark):
    from matchlake.plans.registry import Game
    log = RF.with_battle_month(Game(spark, SF_SMALL).log)
    target = log.where(F.col("battleTime") < "20000101")
    batch = log.where(F.col("battleTime") >= "19990101")
    keys = S.PLAYER_BATTLE_LOG_KEY
    a = insert_ignore(target, batch, keys, order=RF.log_order()).select(*keys)
    b = insert_ignore(target, batch, keys, order=RF.log_order(), prune_on=RF.BATTLE_MONTH).select(*keys)
    assert rows(a) == rows(b) and len(rows(a)) > 0


def test_positional_insert_ignore(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 2)], "x string, y int")   # other names
    assert rows(insert_ignore(target, batch, ["k"], [F.col("v")], by_name=False)) == [("b", 2)]


def test_append_parquet_and_upsert_swap(spark, tmpdir_path):
    C.ensure_schemas(spark, "t_stage")
    C.create_table(spark, "t_stage.stats", S.STG_PLAYER_STATS, f"{tmpdir_path}/stats/v1", replace=True)
    src = spark.createDataFrame([("#A", "a", 1, 10, 20, 1, 1, 2, 0)], S.STG_PLAYER_STATS)
    src.write.parquet(f"{tmpdir_path}/copy.parquet")
    C.append_parquet(spark, "t_stage.stats", f"{tmpdir_path}/copy.parquet", S.STG_PLAYER_STATS)
    assert spark.table("t_stage.stats").count() == 1
    batch = spark.createDataFrame([("#A", 5), ("#B", 7)], "tag string, wins int")
    loc = C.upsert_table(spark, "t_stage.stats", batch, ["tag"], [F.col("wins")], base=f"{tmpdir_path}/stats/v2")
    got = {r.tag: (r.name, r.wins) for r in spark.table("t_stage.stats").collect()}
    assert got == {"#A": ("a", 5), "#B": (None, 7)}
    assert loc.endswith("v2")


def test_refresh_daily_is_idempotent(spark, tmpdir_path):
    from matchlake.plans.registry import FIXTURE_DECK_CATEGORIES, Game
    g = Game(spark, SF_SMALL)
    RF.init_warehouse(spark, tmpdir_path, reset=True)
    RF._rebuild(spark, tmpdir_path, RF.CARDS, g.cards)
    first = RF.refresh_daily(spark, tmpdir_path, g.log, g.player_stats(), FIXTURE_DECK_CATEGORIES)
    n_log = spark.table(RF.LOG).count()
    n_fct = first["fct_battle"].count()
    again = RF.refresh_daily(spark, tmpdir_path, g.log, g.player_stats(), FIXTURE_DECK_CATEGORIES)
    assert spark.table(RF.LOG).count() == n_log
    assert again["fct_battle"].count() == n_fct
    assert spark.table(RF.LOG).select(*S.PLAYER_BATTLE_LOG_KEY).distinct().count() == n_log
    assert set(again) >= {"fct_battle", "player_dim", "date_dim", "deck_dim"}


def test_top_k_on_a_hot_group(spark):
    # one group holds most rows; result equals a full sort of that group
    df = spark.range(20000).select((F.when(F.col("id") < 15000, F.lit("hot"))
                                    .otherwise((F.col("id") % 7).cast("string"))).alias("g"),
                                   (F.col("id") * 7919 % 10007).alias("v"))
    got = top_k_per_group(df, ["g"], [F.desc("v"), F.asc("v")], 3, "rn").where(F.col("g") == "hot")
    want = sorted((r.v for r in df.where(F.col("g") == "hot").collect()), reverse=True)[:3]
    assert [r.v for r in got.orderBy("rn").collect()] == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_refresh_all_builds_every_model(spark, tmpdir_path):
    from matchlake.plans.registry import FIXTURE_DECK_CATEGORIES, Game
    g = Game(spark, SF_SMALL)
    out = RF.refresh_all(spark, tmpdir_path, g.log, g.cards, g.player_stats(), g.clan_stats(),
                         FIXTURE_DECK_CATEGORIES, reset=True)
    assert set(out) == {"fct_battle", "player_dim", "date_dim", "deck_dim", "card_dim", "clan_dim"}
    assert out["card_dim"].count() == g.cards.count()
    assert out["clan_dim"].count() == g.clan_stats().count()
    # every fact's date and deck resolve after a full refresh
    fct = out["fct_battle"]
    assert fct.join(out["date_dim"], "date_id", "left_anti").count() == 0
    assert fct.join(out["deck_dim"], "deck_id", "left_anti").count() == 0


def test_refresh_all_with_seasons_and_top_players_in_schemas_of_its_own(spark, tmpdir_path):
    from matchlake.plans.registry import FIXTURE_DECK_CATEGORIES, Game, top_players
    from matchlake.sources import fixtures as fx
    g = Game(spark, SF_SMALL)
    st = g.star
    args = dict(seasons=fx.season_ids(st["orders"]), top_players=top_players(st["orders"], st["customer"], st["nation"]),
                prefix="own_")
    for _ in range(2):          # a second run changes nothing
        out = RF.refresh_all(spark, tmpdir_path, g.log, g.cards, g.player_stats(), g.clan_stats(),
                             FIXTURE_DECK_CATEGORIES, **args)
    assert spark.catalog.tableExists("own_main.fct_battle")
    assert out["stg_seasons"].columns == ["id", "query_url"] and out["stg_seasons"].count() > 0
    top = out["stg_top_players_by_season"]
    assert top.columns == S.names(S.STG_TOP_PLAYERS_BY_SEASON) and top.count() == args["top_players"].count()


def test_a_load_again_changes_no_file(spark, tmpdir_path):
    from matchlake.plans.registry import FIXTURE_DECK_CATEGORIES, Game
    from matchlake.sources import published as P
    g = Game(spark, SF_SMALL)
    n = RF.Names("months_")
    RF.refresh_daily(spark, tmpdir_path, g.log, g.player_stats(), FIXTURE_DECK_CATEGORIES, prefix="months_")
    files = lambda: set(P.parts(spark, n("fct_battle")))
    before, whole = files(), spark.table(n("fct_battle")).count()
    month = g.log.select(F.substring("battleTime", 1, 6).alias("m")).first().m
    again = g.log.where(F.substring("battleTime", 1, 6) == month)
    RF.refresh_daily(spark, tmpdir_path, again, g.player_stats(), FIXTURE_DECK_CATEGORIES, prefix="months_")
    assert spark.table(n("fct_battle")).count() == whole and files() == before


def test_replaced_table_is_swapped_and_old_versions_go(spark, tmpdir_path):
    import os
    for k in range(4):
        RF._rebuild(spark, tmpdir_path, "swapped", spark.range(k + 1))
        assert spark.table("swapped").count() == k + 1
    assert len(os.listdir(f"{tmpdir_path}/swapped")) == 2       # the current and one before
