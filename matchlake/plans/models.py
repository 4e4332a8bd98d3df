"""Star-schema models over the landing tables.

Each model is a function ``(frames) -> DataFrame``; writing it is the
caller's choice (see :mod:`matchlake.plans.refresh`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import list_avg, slots
from ..functions.dates import (day_name, is_weekend, month_day_year, month_name,
                               parse_battle_time, yyyymmdd)
from ..functions.keys import battle_id, list_key, md5_key
from ..operators.repeats import split_repeats
from ..operators.sides import two_sided_unpivot

# fixed values: the game's deck-count categories -> (catalogue column, value)
GAME_DECK_CATEGORIES = {
    "common_count": ("rarity", "Common"),
    "rare_count": ("rarity", "Rare"),
    "epic_count": ("rarity", "Epic"),
    "legendary_count": ("rarity", "Legendary"),
    "champion_count": ("rarity", "Champion"),
    "troop_count": ("type", "Troop"),
    "spell_count": ("type", "Spell"),
    "building_count": ("type", "Building"),
}

# fixed values: the game API's base URL, the season id after which the
# ranking moved to a new endpoint, and the request URL templates
API_BASE = "https://api.clashroyale.com/v1"
SEASON_CUTOVER = "2022-09"
NEW_SEASON_URL = API_BASE + "/locations/global/pathoflegend/%s/rankings/players/"
OLD_SEASON_URL = API_BASE + "/locations/global/seasons/%s/rankings/players/"
BATTLELOG_URL = API_BASE + "/players/%s/battlelog"
PLAYER_URL = API_BASE + "/players/%s"
CLAN_URL = API_BASE + "/clans/%s"

DECK_SIZE = 8

# per-side column suffixes of the battle log -> fact column names
_SIDED = {
    "starting_trophies": "startingTrophies",
    "trophy_change": "trophyChange",
    "crowns_earned": "crowns",
    "king_tower_hit_points": "kingTowerHitPoints",
    "princess_tower_hit_points": "princessTowersHitPoints",
    "cards": "cards",
    "support_cards": "supportCards",
    "global_rank": "globalRank",
    "elixir_leaked": "elixirLeaked",
}


def card_dim(stg_cards: DataFrame) -> DataFrame:
    return stg_cards.select(
        F.col("name").alias("card_name"), F.col("id").alias("card_id"),
        F.col("elixir").alias("elixir_cost"), F.col("type").alias("card_type"),
        F.col("rarity"), F.col("arena").alias("arena_available"), F.col("description"),
        F.col("evolved_spells_sc_key"), F.col("is_evolved"))


def fct_battle(log: DataFrame, key=md5_key, distinct: bool = True) -> DataFrame:
    """One row per (battle, side) -- 23 columns.

    The log is scanned once (two-sided unpivot by explode).  ``distinct``
    gives SQL UNION semantics; pass ``False`` only when the log is known to be
    unique on its key and sides never repeat (saves the full shuffle).
    The battle id hashes (time, team, opponent) in the logged player's order,
    also on the opponent's row.
    """
    bt = F.col("battleTime")
    common = {
        "battle_id": battle_id(bt, "team_tag", "opponent_tag"),
        "date_id": yyyymmdd(F.to_date(parse_battle_time(bt))),
        "battle_type": F.col("type"),
        "is_ladder_tournament": F.col("isLadderTournament"),
        "arena_id": F.col("arena_id"),
        "arena_name": F.col("arena_name"),
        "game_mode_id": F.col("gameMode_id"),
        "game_mode_name": F.replace(F.col("gameMode_name"), F.lit("_"), F.lit(" ")),
        "deck_selection_method": F.col("deckSelection"),
        "is_hosted_match": F.col("isHostedMatch"),
        "league_number": F.col("leagueNumber"),
    }
    sided: dict[str, tuple[Column, Column]] = {
        "player_id": (key(F.col("team_tag")), key(F.col("opponent_tag"))),
        "deck_id": (list_key(slots("team_cards", "name", DECK_SIZE), key),
                    list_key(slots("opponent_cards", "name", DECK_SIZE), key)),
        "clan_id": (key(F.col("team_clan_tag")), key(F.col("opponent_clan_tag"))),
    }
    for out, suffix in _SIDED.items():
        sided[out] = (F.col(f"team_{suffix}"), F.col(f"opponent_{suffix}"))
    order = ["battle_id", "date_id", "player_id", "deck_id", "clan_id", "battle_type",
             "is_ladder_tournament", "arena_id", "arena_name", "game_mode_id", "game_mode_name",
             "deck_selection_method", "is_hosted_match", "league_number", "starting_trophies",
             "trophy_change", "crowns_earned", "king_tower_hit_points",
             "princess_tower_hit_points", "cards", "support_cards", "global_rank",
             "elixir_leaked"]
    rows = two_sided_unpivot(log, common, sided).select(*order)
    # a plain DISTINCT: its partial aggregation collapses copies map-side, so
    # a battle landed many times never gathers whole in one task
    return rows.distinct() if distinct else rows


def fct_battle_parts(log: DataFrame, key=md5_key) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of :func:`fct_battle` from a log that is in files, in two disjoint
    parts: those that need no DISTINCT, in the log's order, and the others (None:
    no such rows).

    Equal fact rows share their battle id and player, so only battles whose id comes
    twice in the log, or which have the same player on both sides, are made
    distinct; the others are neither shuffled nor held in memory.  The ids that
    come twice are looked for now, by hashes of their parts.
    """
    player = key(F.col("team_tag")), key(F.col("opponent_tag"))
    once, rest = split_repeats(log, F.xxhash64(F.concat_ws("", "battleTime", "team_tag", "opponent_tag")),
                               alone=~player[0].eqNullSafe(player[1]))
    return (once if once is None else fct_battle(once, key, distinct=False),
            rest if rest is None else fct_battle(rest, key))


def fct_battle_stored(log: DataFrame, key=md5_key) -> DataFrame:
    """:func:`fct_battle` of a log that is in files, see :func:`fct_battle_parts`."""
    once, rest = fct_battle_parts(log, key)
    return rest if once is None else once if rest is None else once.unionByName(rest)


def date_dim(log: DataFrame) -> DataFrame:
    """Calendar days seen in the log (distinct), keyed by ``yyyyMMdd``."""
    d = log.select(F.to_date(parse_battle_time("battleTime")).alias("battle_date")).distinct()
    return d.select(
        yyyymmdd("battle_date").alias("date_id"),
        F.col("battle_date"),
        F.year("battle_date").cast("bigint").alias("year"),
        F.month("battle_date").cast("bigint").alias("month"),
        month_name("battle_date").alias("month_name"),
        F.dayofmonth("battle_date").cast("bigint").alias("day"),
        day_name("battle_date").alias("day_name"),
        is_weekend("battle_date").alias("is_weekend"),
        month_day_year("battle_date").alias("month_day_year"))


def deck_sides(log: DataFrame) -> DataFrame:
    """One card array per side per battle (``UNION ALL`` of team and opponent)."""
    return log.select(F.explode(F.array(F.col("team_cards"), F.col("opponent_cards"))).alias("deck"))


def deck_dim(log: DataFrame, stg_cards: DataFrame, dedupe: bool = True,
             categories: dict[str, tuple[str, str]] | None = None,
             normalize: bool = False, key=md5_key) -> DataFrame:
    """Deck dimension with category counts and average elixir cost.

    ``dedupe=True`` keeps one row per distinct deck (true counts downstream);
    ``dedupe=False`` keeps one row per side per battle, as the reference model
    does.  ``normalize=True`` sorts card names first, so the key ignores card
    order.  Counts follow ``element IN (catalogue names of the category)``:
    repeated cards count each time, NULL slots and unknown names never count,
    a name listed twice in the catalogue counts once.

    Plan: slots are exploded once and joined to one flag row per card name
    (broadcast when AQE measures it small), then a single aggregation keyed by
    the deck both sums the flags and removes duplicates.  NULL slots never
    reach the join.  Without dedupe, every side is joined to its deck's counts.
    """
    cats = categories or GAME_DECK_CATEGORIES
    sides = deck_lists(log, normalize)
    counted = deck_counts(sides.distinct(), card_flags(stg_cards, cats), cats)
    if not dedupe:
        counted = sides.alias("s").join(counted.alias("c"), F.expr(
            "s.cards_list = c.cards_list AND s.average_elixir_cost <=> c.average_elixir_cost")).select("s.*", *cats)
    return counted.select(
        list_key("cards_list", key).alias("deck_id"), "cards_list",
        *[F.col(out) for out in cats], "average_elixir_cost")


def deck_lists(log: DataFrame, normalize: bool = False) -> DataFrame:
    """Card names in eight slots and average cost of every side of every battle."""
    names = slots(F.col("deck"), "name", DECK_SIZE)
    return deck_sides(log).select(
        (F.array_sort(names) if normalize else names).alias("cards_list"),
        list_avg(slots(F.col("deck"), "elixirCost", DECK_SIZE)).alias("average_elixir_cost"))


def card_flags(stg_cards: DataFrame, categories: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per card name: 1 for each category that one of its catalogue rows is of."""
    return stg_cards.groupBy(F.col("name").alias("__card")).agg(
        *[F.max((F.col(col) == F.lit(val)).cast("int")).alias(out) for out, (col, val) in categories.items()])


def deck_counts(per_deck: DataFrame, flags: DataFrame, categories: dict[str, tuple[str, str]]) -> DataFrame:
    """Distinct decks (``cards_list``, ``average_elixir_cost``) with their category counts."""
    exploded = per_deck.select("cards_list", "average_elixir_cost", F.explode_outer(
        F.filter("cards_list", lambda c: c.isNotNull())).alias("__card"))
    return (exploded.join(flags, "__card", "left")
            .groupBy("cards_list", "average_elixir_cost")
            .agg(*[F.coalesce(F.sum(out), F.lit(0)).cast("bigint").alias(out) for out in categories]))


def player_dim(stats: DataFrame, key=md5_key) -> DataFrame:
    return stats.select(
        key(F.col("tag")).alias("player_id"), F.col("tag").alias("player_tag"),
        F.col("name").alias("player_name"), F.col("expLevel").alias("experience_level"),
        F.col("trophies").alias("trophy_count"), F.col("bestTrophies").alias("best_trophy_count"),
        F.col("wins"), F.col("losses"), F.col("battleCount").alias("battle_count"),
        F.col("threeCrownWins").alias("three_crown_wins"),
        F.try_divide(F.col("threeCrownWins").cast("double"), F.col("wins")).alias("three_crown_win_percentage"),
        F.try_divide(F.col("wins").cast("double"), F.col("losses")).alias("win_loss_ratio"))


def clan_dim(stats: DataFrame, key=md5_key) -> DataFrame:
    return stats.select(
        key(F.col("tag")).alias("clan_id"), F.col("tag").alias("clan_tag"),
        F.col("name").alias("clan_name"), F.col("type").alias("clan_type"),
        F.col("description"), F.col("clanScore").alias("clan_score"),
        F.col("clanWarTrophies").alias("clan_war_trophies"),
        F.col("requiredTrophies").alias("required_trophies"),
        F.col("members").alias("member_count"), F.col("location_id"),
        F.col("location_name"), F.col("is_country"))


def season_urls(seasons: DataFrame, cutover: str = SEASON_CUTOVER) -> DataFrame:
    """``staging.stg_seasons``: distinct season ids with their ranking URL."""
    sid = F.col("id")
    url = F.when(sid > F.lit(cutover), F.format_string(NEW_SEASON_URL, sid)) \
           .otherwise(F.format_string(OLD_SEASON_URL, sid))
    return seasons.select(sid, url.alias("query_url")).distinct()


def ranking_url(query_url: Column | str, limit: int) -> Column:
    """A season's ranking request for its first ``limit`` players."""
    return F.concat(F.col(query_url) if isinstance(query_url, str) else query_url, F.lit(f"?limit={limit}"))


def player_tags(log: DataFrame) -> DataFrame:
    """Distinct tags of both sides (``UNION``); NULL kept as a value."""
    return log.select(F.explode(F.array("team_tag", "opponent_tag")).alias("tag")).distinct()


def clan_tags(log: DataFrame) -> DataFrame:
    """Distinct non-NULL clan tags of both sides."""
    return (log.select(F.explode(F.array("team_clan_tag", "opponent_clan_tag")).alias("tag"))
               .where(F.col("tag").isNotNull()).distinct())
