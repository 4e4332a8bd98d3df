"""Game tables derived from the driver's TPC-H-style star tables.

The reference ingests an HTTP API; its test data here is a set of star
tables.  This module maps them onto the game's landing tables so every
model and report runs over whole tables whose size grows with the scale
factor.  The Oracle SQL in ``oracle/`` states the same mapping in SQL.

* card            one per distinct ``p_name``: cost ``min(p_size)``, type
                  ``min(p_type)``, rarity ``min(p_brand)``
* battle          one per order with lines
* battleTime      ``o_orderdate`` as ``yyyyMMdd'T'HHmmss.SSS'Z'``
* team/opponent   the order's customer / the supplier ``min(l_suppkey)``
* decks           lines with status 'O' (team) / 'F' (opponent) as card
                  structs, sorted on (l_linenumber, name, level, cost); a side
                  without lines has an empty list
* arena           ``'Arena ' || first char of o_orderpriority``, NULL for
                  '4-NOT SPECIFIED'
* deckSelection   'predefined' when ``o_orderstatus = 'P'`` else 'collection'
* clan            the side's nation, NULL for nation 0
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# fixed values of the mapping (ids are offsets into the game's id ranges)
ARENA_ID_BASE = 54000000
GAME_MODE_ID_BASE = 72000000
CLAN_BADGE_BASE = 16000000
SUPPORT_ID_BASE = 159000000
CARD_ID_BASE = 26000000
LOCATION_ID_BASE = 57000000
TROPHY_BASE = 5000
NO_ARENA_PRIORITY = "4-NOT SPECIFIED"


# fixed values: column types of the driver's test tables.  Declaring them
# skips the footer-sampling schema inference job of every read.
STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in STAR_SCHEMAS:
        r = r.schema(STAR_SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stg_cards(part: DataFrame) -> DataFrame:
    """Card catalogue: one row per card name (``staging.stg_cards`` shape)."""
    g = part.groupBy("p_name").agg(
        F.min("p_size").alias("size"), F.min("p_type").alias("ptype"),
        F.min("p_brand").alias("brand"), F.min("p_partkey").alias("pk"),
        F.count(F.lit(1)).alias("n_parts"))
    evolved = F.col("size") > 45
    return g.select(
        F.lower(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))).alias("key"),
        F.col("p_name").alias("name"),
        F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("sc_key"),
        F.col("size").cast("bigint").alias("elixir"),
        F.col("ptype").alias("type"),
        F.col("brand").alias("rarity"),
        F.col("n_parts").cast("bigint").alias("arena"),
        F.concat(F.lit("The "), F.col("p_name"), F.lit(" card.")).alias("description"),
        (F.lit(CARD_ID_BASE) + F.col("pk")).cast("bigint").alias("id"),
        F.when(evolved, F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))),
                                 F.lit("_EVO"))).alias("evolved_spells_sc_key"),
        evolved.alias("is_evolved"))


def card_images(part: DataFrame) -> DataFrame:
    """``raw.card_images_reference``: one image path per card name."""
    return (part.select("p_name").distinct()
                .select(F.col("p_name").alias("card_name"),
                        F.concat(F.lit("/cards/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")),
                                 F.lit(".png")).alias("url")))


def _slot_struct() -> Column:
    return F.struct(F.col("l_linenumber").alias("n"), F.col("name"),
                    F.col("l_quantity").cast("bigint").alias("level"),
                    F.col("elixir").cast("int").alias("elixirCost"))


def _support(nationkey: Column, regionkey: Column, rname: Column) -> Column:
    return F.array(F.struct(
        F.lit("Tower Princess").alias("name"),
        (F.lit(SUPPORT_ID_BASE) + regionkey).cast("bigint").alias("id"),
        (F.lit(11) + regionkey).cast("bigint").alias("level"),
        F.lit(16).cast("bigint").alias("maxLevel"),
        F.lower(rname).alias("rarity"),
        F.struct(F.concat(F.lit("/support/"), F.lower(rname), F.lit(".png")).alias("medium"))
         .alias("iconUrls")))


def battle_log(t: dict[str, DataFrame]) -> DataFrame:
    """``raw.player_battle_log`` (38 columns) built from the star tables.

    Every order with lines is a battle; a side without lines has an empty card
    list.  Cards meet the small part table first, so lineitem is joined once.
    """
    cards = stg_cards(t["part"]).select("name", "elixir")
    parts = t["part"].select("p_partkey", "p_name").join(cards, F.col("p_name") == F.col("name"))
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus") \
        .join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("s", _slot_struct())

    of = lambda status, col: F.when(F.col("l_linestatus") == status, F.col(col))
    strip = lambda a: F.transform(F.array_sort(a), lambda s: F.struct(
        s.getField("name").alias("name"), s.getField("level").alias("level"),
        s.getField("elixirCost").alias("elixirCost")))
    per_order = lines.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("opp_suppkey"),
        F.count_if(F.col("l_linestatus") == "O").alias("n_team"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_opp"),
        F.coalesce(F.sum(of("O", "l_quantity")), F.lit(0)).alias("q_team"),
        F.coalesce(F.sum(of("F", "l_quantity")), F.lit(0)).alias("q_opp"),
        strip(F.collect_list(of("O", "s"))).alias("team_cards"),
        strip(F.collect_list(of("F", "s"))).alias("opponent_cards"))

    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                           "o_orderpriority")
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    s = t["supplier"].select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    cn = places.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
                       F.col("r_regionkey").alias("cr_key"), F.col("r_name").alias("cr_name"))
    sn = places.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"),
                       F.col("r_regionkey").alias("sr_key"), F.col("r_name").alias("sr_name"))

    j = (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("opp_suppkey") == F.col("s_suppkey"))
         .join(cn, F.col("c_nationkey") == F.col("cn_key"))
         .join(sn, F.col("s_nationkey") == F.col("sn_key")))

    prio = F.col("o_orderpriority")
    digit = F.substring(prio, 1, 1)
    has_arena = prio != F.lit(NO_ARENA_PRIORITY)
    team_crowns = F.least(F.col("n_team"), F.lit(3)).cast("bigint")
    opp_crowns = F.least(F.col("n_opp"), F.lit(3)).cast("bigint")
    change = ((team_crowns - opp_crowns) * 10).cast("int")
    team_king = (F.col("q_team").cast("bigint") * 100)
    opp_king = (F.col("q_opp").cast("bigint") * 100)
    c_clan = F.col("c_nationkey") != 0
    s_clan = F.col("s_nationkey") != 0
    urgent = prio == F.lit("1-URGENT")
    return j.select(
        F.when(F.col("o_orderstatus") == "F", F.lit("PvP"))
         .when(F.col("o_orderstatus") == "O", F.lit("pathOfLegend"))
         .otherwise(F.lit("challenge")).alias("type"),
        F.date_format(F.col("o_orderdate"), "yyyyMMdd'T'HHmmss.SSS'Z'").alias("battleTime"),
        urgent.alias("isLadderTournament"),
        F.when(has_arena, F.lit(ARENA_ID_BASE) + digit.cast("bigint")).cast("bigint").alias("arena_id"),
        F.when(has_arena, F.concat(F.lit("Arena "), digit)).alias("arena_name"),
        (F.lit(GAME_MODE_ID_BASE) + F.col("c_nationkey")).cast("bigint").alias("gameMode_id"),
        F.concat(F.lit("Ladder_"), F.col("c_mktsegment")).alias("gameMode_name"),
        F.when(F.col("o_orderstatus") == "P", F.lit("predefined"))
         .otherwise(F.lit("collection")).alias("deckSelection"),
        (prio == F.lit("5-LOW")).alias("isHostedMatch"),
        digit.cast("bigint").alias("leagueNumber"),
        F.col("c_name").alias("team_tag"),
        F.col("s_name").alias("opponent_tag"),
        F.concat(F.lit("Player "), F.col("c_custkey").cast("string")).alias("team_name"),
        F.concat(F.lit("Player S"), F.col("s_suppkey").cast("string")).alias("opponent_name"),
        (F.floor(F.col("c_acctbal")).cast("bigint") + TROPHY_BASE).alias("team_startingTrophies"),
        (F.floor(F.col("s_acctbal")).cast("bigint") + TROPHY_BASE).alias("opponent_startingTrophies"),
        change.alias("team_trophyChange"),
        (-change).cast("int").alias("opponent_trophyChange"),
        team_crowns.alias("team_crowns"),
        opp_crowns.alias("opponent_crowns"),
        team_king.alias("team_kingTowerHitPoints"),
        opp_king.alias("opponent_kingTowerHitPoints"),
        F.array((F.col("n_team") * 1000).cast("bigint"), F.col("q_team").cast("bigint") * 10)
         .alias("team_princessTowersHitPoints"),
        F.array((F.col("n_opp") * 1000).cast("bigint"), F.col("q_opp").cast("bigint") * 10)
         .alias("opponent_princessTowersHitPoints"),
        F.when(c_clan, F.concat(F.lit("#C"), F.col("c_nationkey").cast("string"))).alias("team_clan_tag"),
        F.when(s_clan, F.concat(F.lit("#C"), F.col("s_nationkey").cast("string"))).alias("opponent_clan_tag"),
        F.when(c_clan, F.col("cn_name")).alias("team_clan_name"),
        F.when(s_clan, F.col("sn_name")).alias("opponent_clan_name"),
        F.when(c_clan, F.lit(CLAN_BADGE_BASE) + F.col("c_nationkey")).cast("bigint").alias("team_clan_badgeId"),
        F.when(s_clan, F.lit(CLAN_BADGE_BASE) + F.col("s_nationkey")).cast("bigint").alias("opponent_clan_badgeId"),
        F.col("team_cards"),
        F.col("opponent_cards"),
        _support(F.col("c_nationkey"), F.col("cr_key"), F.col("cr_name")).alias("team_supportCards"),
        _support(F.col("s_nationkey"), F.col("sr_key"), F.col("sr_name")).alias("opponent_supportCards"),
        F.when(urgent, F.col("c_custkey").cast("int")).alias("team_globalRank"),
        F.when(urgent, F.col("s_suppkey").cast("int")).alias("opponent_globalRank"),
        (F.col("c_acctbal") / F.lit(1000.0)).alias("team_elixirLeaked"),
        (F.col("s_acctbal") / F.lit(1000.0)).alias("opponent_elixirLeaked"),
    )


def player_stats(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """``staging.stg_player_stats``: one row per customer (orders as battles)."""
    per = orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("w"),
        F.count_if(F.col("o_orderstatus") == "O").alias("l"),
        F.count(F.lit(1)).alias("b"),
        F.count_if((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).alias("t"))
    j = customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    b = F.coalesce(F.col("b"), F.lit(0))
    return j.select(
        F.col("c_name").alias("tag"),
        F.concat(F.lit("Player "), F.col("c_custkey").cast("string")).alias("name"),
        (F.col("c_nationkey") + 30).cast("int").alias("expLevel"),
        (F.floor(F.col("c_acctbal")).cast("int") + TROPHY_BASE).alias("trophies"),
        (b * 100 + TROPHY_BASE).cast("int").alias("bestTrophies"),
        F.coalesce(F.col("w"), F.lit(0)).cast("int").alias("wins"),
        F.coalesce(F.col("l"), F.lit(0)).cast("int").alias("losses"),
        b.cast("int").alias("battleCount"),
        F.coalesce(F.col("t"), F.lit(0)).cast("int").alias("threeCrownWins"))


def clan_stats(nation: DataFrame, region: DataFrame, customer: DataFrame) -> DataFrame:
    """``staging.stg_clan_stats``: one clan per nation other than nation 0."""
    members = customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("m"), F.sum(F.floor(F.col("c_acctbal"))).alias("score"))
    j = (nation.where(F.col("n_nationkey") != 0)
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
         .join(members, F.col("n_nationkey") == F.col("c_nationkey"), "left"))
    return j.select(
        F.concat(F.lit("#C"), F.col("n_nationkey").cast("string")).alias("tag"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_regionkey") % 2 == 0, F.lit("open")).otherwise(F.lit("inviteOnly")).alias("type"),
        F.concat(F.lit("Clan of "), F.col("n_name")).alias("description"),
        F.coalesce(F.col("score"), F.lit(0)).cast("int").alias("clanScore"),
        (F.col("n_nationkey") * 100).cast("int").alias("clanWarTrophies"),
        (F.col("n_regionkey") * 1000 + TROPHY_BASE).cast("int").alias("requiredTrophies"),
        F.coalesce(F.col("m"), F.lit(0)).cast("int").alias("members"),
        (F.lit(LOCATION_ID_BASE) + F.col("r_regionkey")).cast("bigint").alias("location_id"),
        F.col("r_name").alias("location_name"),
        (F.col("n_regionkey") != 0).alias("is_country"))


def season_ids(orders: DataFrame) -> DataFrame:
    """Seasons as API items: one ``id`` (``yyyy-MM``) per order month."""
    return orders.select(F.date_format(F.col("o_orderdate"), "yyyy-MM").alias("id")).distinct()


def load_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in STAR_TABLES}
