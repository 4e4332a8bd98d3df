"""Registered queries over tables that are kept up to date load by load.

Each makes its loads from the given tables, in schemas of its own, out of order
and overlapping, and returns what the tables then hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import shared_dir
from ..sources import fixtures as fx
from ..sources import buckets as B
from ..sources import deadletter as D
from ..sources import gate as G
from ..sources import keydict as K
from ..sources import published as P
from ..sources import reconcile as RC
from ..sources import topstate as T
from . import incremental as I
from . import models as M
from . import refresh as RF
from . import reports as R

#: Loads in the order they come: the newest battles, the old ones, then all since 1999 (late and repeated ones).
LOADS = {"newest": "battleTime >= '20010601'", "old": "battleTime < '20000101'", "late": "battleTime >= '19990101'"}
CHANGED_RARITY = "Brand#99"     # a rarity that some cards have until the second load
GROWING_BUCKET_ROWS = 1000      # small, so that the buckets split at the test scale too

_KEPT: dict[tuple[str, str], tuple[I.Store, DataFrame]] = {}


def _database(spark: SparkSession, letter: str) -> str:
    name = f"{letter}{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def kept(spark: SparkSession, sf_dir: str) -> tuple[I.Store, DataFrame]:
    """The tables after all loads, and what each load counted; once per application and directory."""
    from .registry import AS_OF, FIXTURE_DECK_CATEGORIES, Game
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _KEPT:
        g = Game(spark, sf_dir)
        db = _database(spark, "k")
        store = I.Store(f"{db}.log", f"{db}.fct_battle", f"{db}.date_dim", f"{db}.deck_dim")
        I.create(spark, store, shared_dir(spark, "kept"), FIXTURE_DECK_CATEGORIES)
        before = g.cards.withColumn("rarity", F.when(F.col("elixir") % 3 == 0, F.lit(CHANGED_RARITY)).otherwise(F.col("rarity")))
        counts = []
        for i, (load, part) in enumerate(LOADS.items()):
            out = I.load(spark, store, g.log.where(part), RF.log_order(), g.cards if i else before, FIXTURE_DECK_CATEGORIES,
                         AS_OF, load)
            counts += [(load, what, out[what]) for what in ("fetched", "inserted", "ignored")]
        _KEPT[key] = store, spark.createDataFrame(counts, "load_id string, outcome string, n long")
    return _KEPT[key]


def q_incremental_facts(spark, sf_dir):
    from .registry import stable
    return stable(spark.table(kept(spark, sf_dir)[0].facts).drop(I.MONTH))


def q_incremental_deck_dim(spark, sf_dir):
    from .registry import stable
    return stable(I.deck_dim(spark, kept(spark, sf_dir)[0]))


def q_incremental_date_dim(spark, sf_dir):
    from .registry import stable
    return stable(I.date_dim(spark, kept(spark, sf_dir)[0]))


def q_deck_usage_rolling(spark, sf_dir):
    """The usage trend from the kept partials of the window's days."""
    from .registry import AS_OF, stable
    return stable(R.deck_usage_trend(I.rolling_usage(spark, kept(spark, sf_dir)[0], as_of=AS_OF)))


def q_load_counters(spark, sf_dir):
    return kept(spark, sf_dir)[1]


def q_growing_upsert(spark, sf_dir):
    """Player stats upserted in six loads into buckets that grow."""
    from .registry import _stats_pair, stable
    target, batch = _stats_pair(spark, sf_dir)
    name = f"{_database(spark, 'u')}.stats"
    B.create_growing(spark, name, S.STG_PLAYER_STATS, shared_dir(spark, "growing"), GROWING_BUCKET_ROWS)
    loads = [target] + [batch.where(F.pmod(F.xxhash64("tag"), F.lit(5)) == i) for i in range(5)]
    for rows in loads:
        B.upsert_growing(spark, name, rows, S.STATS_KEY, RF.player_order())
    return stable(spark.table(name).drop(B.BUCKET))


def q_gated_load(spark, sf_dir):
    """Facts loaded twice through the gate: each row published or held back, by rule."""
    from .registry import Game
    g = Game(spark, sf_dir)
    db = _database(spark, "g")
    root = shared_dir(spark, "gated")
    P.create_published(spark, f"{db}.facts", f"{S.FCT_BATTLE}, {I.MONTH} STRING, load_id STRING", I.MONTH, f"{root}/facts")
    G.create_quarantine(spark, f"{db}.quarantine", f"{root}/quarantine")
    references = {"player_dim": (M.player_dim(g.player_stats()), "player_id", "player_id"),
                  "deck_dim": (g.deck(), "deck_id", "deck_id"), "date_dim": (g.dates(), "date_id", "date_id")}
    checks = {"crowns": F.col("crowns_earned").between(0, 2)}
    for load, part in {"first": "date_id < '20000101'", "second": "date_id >= '19990101'"}.items():
        G.gated_load(spark, f"{db}.facts", f"{db}.quarantine", g.fct().where(part).withColumn("load_id", F.lit(load)),
                     ["battle_id", "player_id"], [F.col("deck_id"), F.to_json("cards")], checks, references, load)
    row = F.from_json("row", "battle_id STRING, player_id BIGINT")
    return spark.table(f"{db}.facts").select("load_id", "battle_id", "player_id", F.lit(None).cast("string").alias("rule")).unionByName(
        spark.table(f"{db}.quarantine").select("load_id", row.battle_id.alias("battle_id"), row.player_id.alias("player_id"), "rule"))


def q_landed_broken(spark, sf_dir):
    """Player documents of which some are cut off and some have a text where a number
    belongs: read, held back with the reason, and the latter read again once mended."""
    from . import parse
    from .registry import Game
    stats = Game(spark, sf_dir).player_stats()
    whole = F.to_json(F.struct(*[F.col(c) for c in stats.columns]))
    text = (F.when(F.col("expLevel") % 5 == 0, F.left(whole, F.length(whole) - 10))
             .when(F.col("expLevel") % 7 == 0, F.concat(F.left(whole, F.length(whole) - 1), F.lit(', "wins": "many"}')))
             .otherwise(whole))
    base, dead = shared_dir(spark, "landed-broken"), f"{_database(spark, 'd')}.dead"
    stats.select(text.alias("value")).write.text(f"{base}/in")
    D.create_dead_letters(spark, dead, f"{base}/dead")
    good = D.land(spark, f"{base}/in", parse.PLAYER, dead, "landed")
    tag = F.regexp_extract("text", r'"tag":"([^"]*)"', 1)
    held = shared_dir(spark, "landed-broken", "held")
    spark.table(dead).select(tag.alias("tag"), "reason").write.parquet(held)
    mended = D.replay(spark, dead, "landed", parse.PLAYER, F.replace(F.col("text"), F.lit(', "wins": "many"'), F.lit("")))
    return good.select("tag", F.lit("landed").alias("outcome")).unionByName(
        spark.read.schema("tag STRING, reason STRING").parquet(held).select("tag", F.col("reason").alias("outcome"))).unionByName(
        mended.select("tag", F.lit("mended").alias("outcome"))).unionByName(
        spark.table(dead).select(tag.alias("tag"), F.lit("left").alias("outcome")))


def q_kept_top_players(spark, sf_dir):
    """The ten best customers of each month: loaded with scores of which some are too
    high, corrected, and completed by customers that come late."""
    orders = fx.read_table(spark, sf_dir, "orders")
    true = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("grp"), F.col("o_custkey").alias("c")).agg(
        F.sum(F.floor(F.col("o_totalprice") * 100)).alias("score"))
    true = true.select("grp", F.format_string("%012d", "c").alias("member"), "score", "c")
    wrong = true.withColumn("score", F.when(F.col("c") % 4 == 0, F.col("score") * 3).otherwise(F.col("score")))
    db = _database(spark, "t")
    T.create_top(spark, f"{db}.scores", f"{db}.state", shared_dir(spark, "top"))
    for rows in (wrong.where("c % 5 <> 0"), true.where("c % 4 = 0 AND c % 5 <> 0"), true.where("c % 5 = 0")):
        T.load_top(spark, f"{db}.scores", f"{db}.state", rows.drop("c"), [F.col("score")])
    return T.top(spark, f"{db}.state").select(F.col("grp").alias("season_id"), F.col("rank").cast("int").alias("rank"),
                                              F.col("member").cast("long").alias("custkey"), "score")


def _differing_dumps(spark, sf_dir, kind):
    """Player statistics as three dumps: the second has its columns moved and one
    widened, the third one more, another widened and one in conflict."""
    from .registry import Game
    stats, base = Game(spark, sf_dir).player_stats(), shared_dir(spark, f"dumps-{kind}")
    level, wins, trophies = F.col("expLevel") % 3, F.col("wins"), F.col("trophies")
    dumps = {"a": stats.where(level == 0).select("tag", "wins", "trophies"),
             "b": stats.where(level == 1).select((trophies.cast("long") + 10_000_000_000).alias("Trophies"), "tag", "wins"),
             "c": stats.where(level == 2).select("tag", "name", (wins + F.lit(0.5).cast("double")).alias("wins"),
                                                 F.concat(F.lit("t"), trophies.cast("string")).alias("trophies"))}
    for name, rows in dumps.items():
        rows.write.option("header", True).format(kind).save(f"{base}/{name}")
    return RC.read_dumps(spark, {name: f"{base}/{name}" for name in dumps}, kind)[0]


def q_reconciled_parquet(spark, sf_dir):
    """Parquet dumps whose columns differ, as one table."""
    return _differing_dumps(spark, sf_dir, "parquet")


def q_reconciled_csv(spark, sf_dir):
    """CSV dumps whose columns differ, as one table with types from all values."""
    return _differing_dumps(spark, sf_dir, "csv")


def _battle_key():
    return F.concat_ws("|", "battleTime", "team_tag", "opponent_tag")


def q_battle_ids(spark, sf_dir):
    """Dense ids of the battles of three loads that overlap, with their 60-bit hashes."""
    from .registry import Game
    log, name = Game(spark, sf_dir).log, f"{_database(spark, 'n')}.battles"
    K.create_dictionary(spark, name, shared_dir(spark, "battle-ids"))
    for load, part in LOADS.items():
        K.extend(spark, name, _battle_key(), log.where(part), load)
    return K.with_ids(log.select(_battle_key().alias("battle")), F.col("battle"), spark.table(name), "id").join(
        spark.table(name).select("id", "hash", "load"), "id").select("battle", "id", "hash", "load")


QUERIES = {"reconciled_parquet": q_reconciled_parquet, "reconciled_csv": q_reconciled_csv,
           "battle_ids": q_battle_ids, "kept_top_players": q_kept_top_players, "landed_broken": q_landed_broken, "incremental_facts": q_incremental_facts, "incremental_deck_dim": q_incremental_deck_dim,
           "incremental_date_dim": q_incremental_date_dim, "deck_usage_rolling": q_deck_usage_rolling,
           "load_counters": q_load_counters, "growing_upsert": q_growing_upsert, "gated_load": q_gated_load}
