"""API documents -> landing rows, as column expressions over a read schema.

The read schemas declare only the fields that are kept, so every other
payload field is never materialized and any missing field reads as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import first_element_fields, mirror_cost
from ..schemas import CARD, SUPPORT

# ---- fixed values: API document shapes (fields that are read) ---------------
SIDE = (
    "STRUCT<tag: STRING, name: STRING, startingTrophies: BIGINT, trophyChange: INT, "
    "crowns: BIGINT, kingTowerHitPoints: BIGINT, princessTowersHitPoints: ARRAY<BIGINT>, "
    "clan: STRUCT<tag: STRING, name: STRING, badgeId: BIGINT>, "
    f"cards: ARRAY<{CARD}>, supportCards: ARRAY<{SUPPORT}>, globalRank: INT, "
    "elixirLeaked: DOUBLE>")
BATTLE = (
    "type STRING, battleTime STRING, isLadderTournament BOOLEAN, "
    "arena STRUCT<id: BIGINT, name: STRING>, gameMode STRUCT<id: BIGINT, name: STRING>, "
    "deckSelection STRING, isHostedMatch BOOLEAN, leagueNumber BIGINT, "
    f"team ARRAY<{SIDE}>, opponent ARRAY<{SIDE}>")
PLAYER = ("tag STRING, name STRING, expLevel INT, trophies INT, bestTrophies INT, wins INT, "
          "losses INT, battleCount INT, threeCrownWins INT")
PLAYER_LADDER = PLAYER + (", role STRING, currentFavoriteCard STRUCT<name: STRING, id: BIGINT>, "
                          "clan STRUCT<tag: STRING>")
CLAN = ("tag STRING, name STRING, type STRING, description STRING, clanScore INT, "
        "clanWarTrophies INT, requiredTrophies INT, members INT, "
        "location STRUCT<id: BIGINT, name: STRING, isCountry: BOOLEAN>")

# fixed values: payload field names
# per-side output suffix -> path inside the side element
INNER = {
    "tag": "tag", "name": "name", "startingTrophies": "startingTrophies",
    "trophyChange": "trophyChange", "crowns": "crowns",
    "kingTowerHitPoints": "kingTowerHitPoints",
    "princessTowersHitPoints": "princessTowersHitPoints", "clan_tag": "clan.tag",
    "clan_name": "clan.name", "clan_badgeId": "clan.badgeId", "cards": "cards",
    "supportCards": "supportCards", "globalRank": "globalRank", "elixirLeaked": "elixirLeaked",
}


def parse_battle_log(battles: DataFrame) -> DataFrame:
    """Battle documents (``BATTLE`` columns) -> ``raw.player_battle_log`` rows.

    Only the first member of each side is kept (a 2v2 partner is dropped);
    an empty side gives NULLs.  Card structs keep name/level/elixirCost and
    Mirror's cost is NULL.
    """
    outer = [F.col("type"), F.col("battleTime"), F.col("isLadderTournament"),
             F.col("arena.id").alias("arena_id"), F.col("arena.name").alias("arena_name"),
             F.col("gameMode.id").alias("gameMode_id"),
             F.col("gameMode.name").alias("gameMode_name"),
             F.col("deckSelection"), F.col("isHostedMatch"), F.col("leagueNumber")]
    team = dict(zip(INNER, first_element_fields("team", INNER, "team")))
    opp = dict(zip(INNER, first_element_fields("opponent", INNER, "opponent")))
    inner = []
    for k in INNER:
        t, o = team[k], opp[k]
        if k == "cards":
            t = mirror_cost(F.get(F.col("team"), 0).getField("cards")).alias("team_cards")
            o = mirror_cost(F.get(F.col("opponent"), 0).getField("cards")).alias("opponent_cards")
        inner += [t, o]
    return battles.select(*outer, *inner)


def parse_battle_json(text: DataFrame, col: str = "body") -> DataFrame:
    """One JSON battle object per row of a text column -> landing rows."""
    return parse_battle_log(text.select(F.from_json(F.col(col), BATTLE).alias("b")).select("b.*"))


def parse_player(players: DataFrame) -> DataFrame:
    """Player documents -> ``staging.stg_player_stats`` (whitelisted fields)."""
    return players.select("tag", "name", "expLevel", "trophies", "bestTrophies", "wins",
                          "losses", "battleCount", "threeCrownWins")


def parse_player_ladder(players: DataFrame) -> DataFrame:
    """Ladder variant: adds role, favourite card and the clan tag."""
    return players.select("tag", "name", "expLevel", "trophies", "bestTrophies", "wins",
                          "losses", "battleCount", "threeCrownWins", "role",
                          "currentFavoriteCard", F.col("clan.tag").alias("clanTag"))


def parse_clan(clans: DataFrame) -> DataFrame:
    """Clan documents -> ``staging.stg_clan_stats``; missing location -> NULLs."""
    return clans.select("tag", "name", "type", "description", "clanScore", "clanWarTrophies",
                        "requiredTrophies", "members",
                        F.col("location.id").alias("location_id"),
                        F.col("location.name").alias("location_name"),
                        F.col("location.isCountry").alias("is_country"))


def battle_documents(log: DataFrame) -> DataFrame:
    """Inverse of :func:`parse_battle_log`: landing rows -> API battle JSON text
    (one object per row).  Used to exercise the parser over whole tables."""
    def side(prefix: str):
        return F.array(F.struct(
            F.col(f"{prefix}_tag").alias("tag"), F.col(f"{prefix}_name").alias("name"),
            F.col(f"{prefix}_startingTrophies").alias("startingTrophies"),
            F.col(f"{prefix}_trophyChange").alias("trophyChange"),
            F.col(f"{prefix}_crowns").alias("crowns"),
            F.col(f"{prefix}_kingTowerHitPoints").alias("kingTowerHitPoints"),
            F.col(f"{prefix}_princessTowersHitPoints").alias("princessTowersHitPoints"),
            F.struct(F.col(f"{prefix}_clan_tag").alias("tag"),
                     F.col(f"{prefix}_clan_name").alias("name"),
                     F.col(f"{prefix}_clan_badgeId").alias("badgeId")).alias("clan"),
            F.col(f"{prefix}_cards").alias("cards"),
            F.col(f"{prefix}_supportCards").alias("supportCards"),
            F.col(f"{prefix}_globalRank").alias("globalRank"),
            F.col(f"{prefix}_elixirLeaked").alias("elixirLeaked")))
    doc = F.struct(
        F.col("type"), F.col("battleTime"), F.col("isLadderTournament"),
        F.struct(F.col("arena_id").alias("id"), F.col("arena_name").alias("name")).alias("arena"),
        F.struct(F.col("gameMode_id").alias("id"), F.col("gameMode_name").alias("name")).alias("gameMode"),
        F.col("deckSelection"), F.col("isHostedMatch"), F.col("leagueNumber"),
        side("team").alias("team"), side("opponent").alias("opponent"))
    return log.select(F.to_json(doc).alias("body"))
