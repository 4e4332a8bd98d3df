"""Table schemas (Spark DDL).  Never inferred on production paths.

Fixed values: column names and types of the landing and warehouse tables;
they must equal the reference data model for results to line up.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---- fixed values: nested element types -------------------------------------
CARD = "STRUCT<name: STRING, level: BIGINT, elixirCost: INT>"
SUPPORT = ("STRUCT<name: STRING, id: BIGINT, level: BIGINT, maxLevel: BIGINT, "
           "rarity: STRING, iconUrls: STRUCT<medium: STRING>>")

# ---- fixed values: landing tables -------------------------------------------
PLAYER_BATTLE_LOG = (
    "type STRING, battleTime STRING, isLadderTournament BOOLEAN, arena_id BIGINT, "
    "arena_name STRING, gameMode_id BIGINT, gameMode_name STRING, deckSelection STRING, "
    "isHostedMatch BOOLEAN, leagueNumber BIGINT, team_tag STRING, opponent_tag STRING, "
    "team_name STRING, opponent_name STRING, team_startingTrophies BIGINT, "
    "opponent_startingTrophies BIGINT, team_trophyChange INT, opponent_trophyChange INT, "
    "team_crowns BIGINT, opponent_crowns BIGINT, team_kingTowerHitPoints BIGINT, "
    "opponent_kingTowerHitPoints BIGINT, team_princessTowersHitPoints ARRAY<BIGINT>, "
    "opponent_princessTowersHitPoints ARRAY<BIGINT>, team_clan_tag STRING, "
    "opponent_clan_tag STRING, team_clan_name STRING, opponent_clan_name STRING, "
    "team_clan_badgeId BIGINT, opponent_clan_badgeId BIGINT, "
    f"team_cards ARRAY<{CARD}>, opponent_cards ARRAY<{CARD}>, "
    f"team_supportCards ARRAY<{SUPPORT}>, opponent_supportCards ARRAY<{SUPPORT}>, "
    "team_globalRank INT, opponent_globalRank INT, team_elixirLeaked DOUBLE, "
    "opponent_elixirLeaked DOUBLE")
PLAYER_BATTLE_LOG_KEY = ["team_tag", "opponent_tag", "battleTime"]

STG_TOP_PLAYERS_BY_SEASON = (
    "tag STRING, name STRING, expLevel BIGINT, tophies BIGINT, rank BIGINT, "
    "clan STRUCT<tag: STRING, name: STRING, badgeId: BIGINT>, season_id STRING")
STG_TOP_PLAYERS_KEY = ["tag", "season_id"]

STG_SEASONS = "id STRING, query_url STRING"

STG_CARDS = (
    "key STRING, name STRING, sc_key STRING, elixir BIGINT, type STRING, rarity STRING, "
    "arena BIGINT, description STRING, id BIGINT, evolved_spells_sc_key STRING, "
    "is_evolved BOOLEAN")

STG_PLAYER_STATS = (
    "tag STRING, name STRING, expLevel INT, trophies INT, bestTrophies INT, wins INT, "
    "losses INT, battleCount INT, threeCrownWins INT")
STG_CLAN_STATS = (
    "tag STRING, name STRING, type STRING, description STRING, clanScore INT, "
    "clanWarTrophies INT, requiredTrophies INT, members INT, location_id BIGINT, "
    "location_name STRING, is_country BOOLEAN")
STATS_KEY = ["tag"]

# ---- fixed values: warehouse tables (UBIGINT keys become BIGINT) -------------
FCT_BATTLE = (
    "battle_id STRING, date_id STRING, player_id BIGINT, deck_id BIGINT, clan_id BIGINT, "
    "battle_type STRING, is_ladder_tournament BOOLEAN, arena_id BIGINT, arena_name STRING, "
    "game_mode_id BIGINT, game_mode_name STRING, deck_selection_method STRING, "
    "is_hosted_match BOOLEAN, league_number BIGINT, starting_trophies BIGINT, "
    "trophy_change INT, crowns_earned BIGINT, king_tower_hit_points BIGINT, "
    f"princess_tower_hit_points ARRAY<BIGINT>, cards ARRAY<{CARD}>, "
    f"support_cards ARRAY<{SUPPORT}>, global_rank INT, elixir_leaked DOUBLE")
PLAYER_DIM = (
    "player_id BIGINT, player_tag STRING, player_name STRING, experience_level INT, "
    "trophy_count INT, best_trophy_count INT, wins INT, losses INT, battle_count INT, "
    "three_crown_wins INT, three_crown_win_percentage DOUBLE, win_loss_ratio DOUBLE")
DECK_DIM = (
    "deck_id BIGINT, cards_list ARRAY<STRING>, common_count BIGINT, rare_count BIGINT, "
    "epic_count BIGINT, legendary_count BIGINT, champion_count BIGINT, troop_count BIGINT, "
    "spell_count BIGINT, building_count BIGINT, average_elixir_cost DOUBLE")
DATE_DIM = (
    "date_id STRING, battle_date DATE, year BIGINT, month BIGINT, month_name STRING, "
    "day BIGINT, day_name STRING, is_weekend STRING, month_day_year STRING")
CLAN_DIM = (
    "clan_id BIGINT, clan_tag STRING, clan_name STRING, clan_type STRING, description STRING, "
    "clan_score INT, clan_war_trophies INT, required_trophies INT, member_count INT, "
    "location_id BIGINT, location_name STRING, is_country BOOLEAN")
CARD_DIM = (
    "card_name STRING, card_id BIGINT, elixir_cost BIGINT, card_type STRING, rarity STRING, "
    "arena_available BIGINT, description STRING, evolved_spells_sc_key STRING, "
    "is_evolved BOOLEAN")

# snapshot tables: (table name, schema) in load order
SNAPSHOT_TABLES = {
    "player_dim": PLAYER_DIM,
    "deck_dim": DECK_DIM,
    "date_dim": DATE_DIM,
    "fct_battle": FCT_BATTLE,
    "clan_dim": CLAN_DIM,
    "card_dim": CARD_DIM,
    "raw.player_battle_log": PLAYER_BATTLE_LOG,
    "staging.stg_top_players_by_season": STG_TOP_PLAYERS_BY_SEASON,
    "staging.stg_seasons": STG_SEASONS,
    "staging.stg_cards": STG_CARDS,
    "staging.stg_player_stats": STG_PLAYER_STATS,
    "staging.stg_clan_stats": STG_CLAN_STATS,
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return [f.name for f in struct(ddl).fields]
