"""Refresh plans: the daily and the monthly (full) warehouse rebuild.

Both run as a sequence of distributed jobs over catalog tables whose data lives
under ``warehouse``.  The battle log, the facts, and the day and deck dimensions
are kept incrementally (:mod:`matchlake.plans.incremental`): a day's load reads
and writes what belongs to the day, and new battles never vanish from inner
joins until the monthly run.  Player and clan stats are upserted into key
buckets that grow with them.  Small catalogues are rebuilt: a new folder is
written and the table then pointed at it.  Readers see the old or the new
content of a table; a failed run can simply be repeated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources import buckets as B
from ..sources import published as P
from ..sources.catalog import create_table, drop_versions, ensure_schemas, insert_ignore_table, replace_table
from . import incremental as I
from . import models as M

LOG = "raw.player_battle_log"
PLAYER_STATS = "staging.stg_player_stats"
CLAN_STATS = "staging.stg_clan_stats"
CARDS = "staging.stg_cards"
SEASONS = "staging.stg_seasons"
TOP_PLAYERS = "staging.stg_top_players_by_season"
BATTLE_MONTH = "battle_month"


class Names:
    """Table names of one warehouse.  ``prefix`` goes before each schema name,
    so that a run has schemas of its own; models then live in ``<prefix>main``."""

    def __init__(self, prefix: str = ""):
        self.prefix = prefix

    def __call__(self, name: str) -> str:
        if not self.prefix:
            return name
        return self.prefix + name if "." in name else f"{self.prefix}main.{name}"


def with_battle_month(log: DataFrame) -> DataFrame:
    """Adds the landing table's partition column: the ``yyyyMM`` prefix of
    the battle time.  It is part of the key, so equal keys share it and a
    keyed load reads only the month(s) its batch touches; months keep the
    partition count modest for multi-year logs."""
    return log.withColumn(BATTLE_MONTH, F.substring(F.col("battleTime"), 1, 6))


def log_order() -> list[Column]:
    """Load order inside a battle batch (first wins): a total order on the content."""
    return [F.to_json(F.col("team_cards")), F.to_json(F.col("opponent_cards"))]


def player_order() -> list[Column]:
    """Load order of player snapshots (last wins): battles only ever increase."""
    return [F.col("battleCount"), F.col("bestTrophies"), F.col("trophies")]


def clan_order() -> list[Column]:
    return [F.col("clanScore"), F.col("members")]


def _loc(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name.replace('.', '/')}/v-{uuid.uuid4().hex[:12]}"


def _rebuild(spark: SparkSession, warehouse: str, name: str, df: DataFrame) -> DataFrame:
    loc = _loc(warehouse, name)
    out = replace_table(spark, name, df, loc)
    drop_versions(spark, loc.rpartition("/")[0], loc)
    return out


def store(names: Names) -> I.Store:
    """The incrementally kept tables of a warehouse."""
    return I.Store(names(LOG), names("fct_battle"), names("date_dim"), names("deck_dim"))


def init_warehouse(spark: SparkSession, warehouse: str, reset: bool = False, prefix: str = "", categories=None) -> None:
    """Create the landing and the model tables (IF NOT EXISTS); ``reset`` drops them first."""
    n = Names(prefix)
    ensure_schemas(spark, prefix + "raw", prefix + "staging", *([prefix + "main"] if prefix else []))
    if reset:
        I.drop(spark, store(n))
        for name in [PLAYER_STATS, CLAN_STATS]:
            P.drop_published(spark, n(name))
        for name in [CARDS, SEASONS, TOP_PLAYERS, "player_dim", "card_dim", "clan_dim"]:
            spark.sql(f"DROP TABLE IF EXISTS {n(name)}")
    I.create(spark, store(n), warehouse, categories)
    for name, ddl in [(PLAYER_STATS, S.STG_PLAYER_STATS), (CLAN_STATS, S.STG_CLAN_STATS)]:
        B.create_growing(spark, n(name), ddl, _loc(warehouse, n(name)))
    for name, ddl in [(CARDS, S.STG_CARDS), (TOP_PLAYERS, S.STG_TOP_PLAYERS_BY_SEASON)]:
        create_table(spark, n(name), ddl, _loc(warehouse, n(name)))


def with_fact_month(fct: DataFrame) -> DataFrame:
    return fct.withColumn(BATTLE_MONTH, F.substring("date_id", 1, 6))


def refresh_daily(spark: SparkSession, warehouse: str, battles: DataFrame,
                  player_stats: DataFrame | None = None, categories=None,
                  reset: bool = False, prefix: str = "", as_of=None, load_id: str | None = None) -> dict[str, DataFrame]:
    """Battle log load, fct_battle, player stats and player_dim (+ log-derived dims)."""
    n = Names(prefix)
    init_warehouse(spark, warehouse, reset, prefix, categories)
    if player_stats is not None:
        B.upsert_growing(spark, n(PLAYER_STATS), player_stats, S.STATS_KEY, player_order())
    kept = store(n)
    cards = spark.table(n(CARDS)) if spark.catalog.tableExists(n(CARDS)) else None
    I.load(spark, kept, battles, log_order(), cards, categories, as_of, load_id)
    out = {"fct_battle": spark.table(kept.facts).drop(BATTLE_MONTH),
           "player_dim": _rebuild(spark, warehouse, n("player_dim"), M.player_dim(spark.table(n(PLAYER_STATS)))),
           "date_dim": I.date_dim(spark, kept)}
    if cards is not None:
        out["deck_dim"] = I.deck_dim(spark, kept)
    return out


def refresh_all(spark: SparkSession, warehouse: str, battles: DataFrame, cards: DataFrame,
                player_stats: DataFrame, clan_stats: DataFrame, categories=None, reset: bool = False,
                seasons: DataFrame | None = None, top_players: DataFrame | None = None,
                prefix: str = "") -> dict[str, DataFrame]:
    """Everything: card catalogue and seasons replaced, top players inserted
    (by position, known ones ignored), clan stats upsert, all models.

    ``seasons`` holds season ids; ``top_players`` the ranking rows of each
    season, best rank first, with the constant ``season_id`` last.
    """
    n = Names(prefix)
    init_warehouse(spark, warehouse, reset, prefix, categories)
    _rebuild(spark, warehouse, n(CARDS), cards)
    B.upsert_growing(spark, n(CLAN_STATS), clan_stats, S.STATS_KEY, clan_order())
    out = refresh_daily(spark, warehouse, battles, player_stats, categories, prefix=prefix)
    if seasons is not None:
        out["stg_seasons"] = _rebuild(spark, warehouse, n(SEASONS), M.season_urls(seasons))
    if top_players is not None:
        insert_ignore_table(spark, n(TOP_PLAYERS), top_players, S.STG_TOP_PLAYERS_KEY,
                            order=[F.col("rank")], by_name=False)
        out["stg_top_players_by_season"] = spark.table(n(TOP_PLAYERS))
    out["card_dim"] = _rebuild(spark, warehouse, n("card_dim"), M.card_dim(spark.table(n(CARDS))))
    out["clan_dim"] = _rebuild(spark, warehouse, n("clan_dim"), M.clan_dim(spark.table(n(CLAN_STATS))))
    return out
