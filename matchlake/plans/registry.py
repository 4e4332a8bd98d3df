"""Registered queries: each reads one scale-factor directory of the driver's
tables and returns a DataFrame.  ``__spark_entry__.queries()`` exposes them.

Results pass through :func:`stable` so that they compare across engines:
nested values become JSON text, dates ISO text, doubles are rounded to 6
decimals.  The library functions themselves return the native types.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, MapType, StructType

from ..session import CODEC, shared_dir, small_splits
from ..sources import fixtures as fx
from . import models as M
from . import refresh as RF
from . import reports as R

# fixed parameters of the registered queries
AS_OF = _dt.date(2001, 8, 1)          # newest order date in the test data
# the test data's categories are brands and part types, not game rarities
FIXTURE_DECK_CATEGORIES = {
    "common_count": ("rarity", "Brand#1"),
    "rare_count": ("rarity", "Brand#10"),
    "epic_count": ("rarity", "Brand#11"),
    "legendary_count": ("rarity", "Brand#12"),
    "champion_count": ("rarity", "Brand#13"),
    "troop_count": ("type", "SMALL"),
    "spell_count": ("type", "MEDIUM"),
    "building_count": ("type", "LARGE"),
}


def stable(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, StructType, MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, DoubleType):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


#: Tables written by this application: (application, sf_dir, name) -> (path, schema).
_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Game:
    """The game's tables and models for one scale-factor dir.

    ``landed=True`` reads the battle log, the facts and the deck dimension from
    Parquet in the shared folder, as production reports read stored tables.
    They are written once per application and directory, by the first query
    that needs them; reports then scan only the columns they name.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, landed: bool = True):
        self.spark, self.sf_dir, self.landed = spark, sf_dir, landed
        self.star = fx.load_star(spark, sf_dir)
        self._cards = None

    def written(self, name: str, make, partition_by: str | None = None):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            df, path = make(), shared_dir(self.spark, "game", name)
            out = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
            out.parquet(path, compression=CODEC)
            _WRITTEN[key] = path, df.schema
        path, schema = _WRITTEN[key]
        return self.spark.read.schema(schema).parquet(path)

    @property
    def log(self):
        if not self.landed:
            return fx.battle_log(self.star)
        return self.written("battle_log", lambda: fx.battle_log(self.star))

    @property
    def cards(self):
        if self._cards is None:
            self._cards = fx.stg_cards(self.star["part"])
        return self._cards

    def fct(self):
        """Facts, made distinct when written and partitioned by month."""
        return self.written("fct_battle", lambda: RF.with_fact_month(M.fct_battle_stored(self.log)), RF.BATTLE_MONTH)

    def deck_model(self, dedupe=True, normalize=False):
        return M.deck_dim(self.log, self.cards, dedupe=dedupe,
                          categories=FIXTURE_DECK_CATEGORIES, normalize=normalize)

    def deck(self):
        return self.written("deck_dim", self.deck_model)

    def dates(self):
        return M.date_dim(self.log)

    def card_dim(self):
        return M.card_dim(self.cards)

    def player_stats(self):
        return fx.player_stats(self.star["customer"], self.star["orders"])

    def clan_stats(self):
        return fx.clan_stats(self.star["nation"], self.star["region"], self.star["customer"])


# ---- reports -----------------------------------------------------------------

def q_card_usage_by_rarity(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.card_usage(g.fct(), g.deck(), g.card_dim(), "rarity"))


def q_card_usage_by_type(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.card_usage(g.fct(), g.deck(), g.card_dim(), "card_type"))


def q_card_usage_fanout(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.card_usage(g.fct(), g.deck_model(dedupe=False), g.card_dim(), "rarity"))


def q_card_usage_by_cost(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.card_usage_by_cost(g.fct(), g.deck(), g.card_dim()))


def q_elixir_cost_by_arena(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.elixir_cost_by_arena(g.fct(), g.deck()))


def _daily(g, exclude="predefined", ordered=True):
    return R.deck_usage_daily(g.fct(), g.deck(), g.dates(), as_of=AS_OF,
                              exclude_selection=exclude, ordered=ordered)


def q_deck_usage_daily(spark, sf_dir):
    return stable(_daily(Game(spark, sf_dir)))


def q_deck_usage_inclusive(spark, sf_dir):
    return stable(_daily(Game(spark, sf_dir), exclude=None))


def q_deck_usage_pivot(spark, sf_dir):
    return stable(R.deck_usage_pivot(_daily(Game(spark, sf_dir), ordered=False), R.window_days(AS_OF)))


def q_deck_usage_trend(spark, sf_dir):
    return stable(R.deck_usage_trend(_daily(Game(spark, sf_dir), ordered=False)))


def q_card_info(spark, sf_dir):
    g = Game(spark, sf_dir)
    return stable(R.card_info(g.card_dim(), fx.card_images(g.star["part"])))


# ---- models ------------------------------------------------------------------

def q_fct_battle(spark, sf_dir):
    return stable(M.fct_battle_stored(Game(spark, sf_dir).log))


def q_date_dim(spark, sf_dir):
    return stable(Game(spark, sf_dir).dates())


def q_deck_dim(spark, sf_dir):
    return stable(Game(spark, sf_dir).deck_model())


def q_deck_dim_as_written(spark, sf_dir):
    return stable(Game(spark, sf_dir).deck_model(dedupe=False))


def q_deck_dim_unordered(spark, sf_dir):
    return stable(Game(spark, sf_dir).deck_model(normalize=True))


def q_player_dim(spark, sf_dir):
    return stable(M.player_dim(Game(spark, sf_dir).player_stats()))


def q_clan_dim(spark, sf_dir):
    return stable(M.clan_dim(Game(spark, sf_dir).clan_stats()))


def q_card_dim(spark, sf_dir):
    return stable(Game(spark, sf_dir).card_dim())


def q_participant_tags(spark, sf_dir):
    return stable(M.player_tags(Game(spark, sf_dir).log))


def q_clan_tags(spark, sf_dir):
    return stable(M.clan_tags(Game(spark, sf_dir).log))


def q_season_urls(spark, sf_dir):
    star = fx.load_star(spark, sf_dir)
    return stable(M.season_urls(fx.season_ids(star["orders"])))


QUERIES = {
    "card_usage_by_rarity": q_card_usage_by_rarity,
    "card_usage_by_type": q_card_usage_by_type,
    "card_usage_fanout": q_card_usage_fanout,
    "card_usage_by_cost": q_card_usage_by_cost,
    "elixir_cost_by_arena": q_elixir_cost_by_arena,
    "deck_usage_daily": q_deck_usage_daily,
    "deck_usage_inclusive": q_deck_usage_inclusive,
    "deck_usage_pivot": q_deck_usage_pivot,
    "deck_usage_trend": q_deck_usage_trend,
    "card_info": q_card_info,
    "fct_battle": q_fct_battle,
    "date_dim": q_date_dim,
    "deck_dim": q_deck_dim,
    "deck_dim_as_written": q_deck_dim_as_written,
    "deck_dim_unordered": q_deck_dim_unordered,
    "player_dim": q_player_dim,
    "clan_dim": q_clan_dim,
    "card_dim": q_card_dim,
    "participant_tags": q_participant_tags,
    "clan_tags": q_clan_tags,
    "season_urls": q_season_urls,
}


# ---- ingest, keyed writes, quality -------------------------------------------
from ..functions.text import encode_tag, format_url  # noqa: E402
from ..operators.quality import check_violations, key_violations, orphan_facts  # noqa: E402
from ..operators.topk import top_k_per_group  # noqa: E402
from ..operators.writes import insert_ignore, upsert  # noqa: E402
from ..functions.arrays import flatten_struct  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources import json as JS  # noqa: E402
from ..sources.catalog import export_snapshot, import_snapshot, table_counts  # noqa: E402
from .. import schemas as S  # noqa: E402
from . import parse as P  # noqa: E402

BATTLELOG_URL, PLAYER_URL = M.BATTLELOG_URL, M.PLAYER_URL   # tag already percent-encoded
SPLIT_OLD = "20000101"     # landing batches: battles before / from these days
SPLIT_NEW = "19990101"
STATS_BEFORE = _dt.date(2000, 1, 1)
ACTIVE_FROM = _dt.date(2001, 1, 1)


def top_players(orders, customer, nation, k: int = 10):
    """``staging.stg_top_players_by_season``: top k customers per month."""
    per = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("season_id"),
                         F.col("o_custkey")).agg(
        F.sum(F.floor(F.col("o_totalprice") * 100)).alias("score"),
        F.count(F.lit(1)).alias("n"))
    ranked = top_k_per_group(per, ["season_id"], [F.desc("score"), F.asc("o_custkey")], k, "rank")
    j = ranked.join(customer, F.col("o_custkey") == F.col("c_custkey")) \
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    has = F.col("c_nationkey") != 0
    return j.select(
        F.col("c_name").alias("tag"),
        F.concat(F.lit("Player "), F.col("c_custkey").cast("string")).alias("name"),
        (F.col("c_nationkey") + 30).cast("bigint").alias("expLevel"),
        (F.col("n") * 10 + fx.TROPHY_BASE).cast("bigint").alias("tophies"),
        F.col("rank").cast("bigint").alias("rank"),
        F.struct(F.when(has, F.concat(F.lit("#C"), F.col("c_nationkey").cast("string"))).alias("tag"),
                 F.when(has, F.col("n_name")).alias("name"),
                 F.when(has, F.lit(fx.CLAN_BADGE_BASE) + F.col("c_nationkey")).cast("bigint")
                  .alias("badgeId")).alias("clan"),
        F.col("season_id"))


def q_top_players_per_season(spark, sf_dir):
    st = fx.load_star(spark, sf_dir)
    return stable(top_players(st["orders"], st["customer"], st["nation"]))


def q_insert_ignore_log(spark, sf_dir):
    log = RF.with_battle_month(Game(spark, sf_dir).log)
    stored = shared_dir(spark, "stored-log")
    log.where(F.col("battleTime") < SPLIT_OLD).hint("rebalance", RF.BATTLE_MONTH).write.partitionBy(RF.BATTLE_MONTH).parquet(stored)
    target = spark.read.schema(log.schema).parquet(stored)
    batch = log.where(F.col("battleTime") >= SPLIT_NEW)
    new = insert_ignore(target, batch, S.PLAYER_BATTLE_LOG_KEY, order=RF.log_order(),
                        prune_on=RF.BATTLE_MONTH, stored=True)
    return stable(target.unionByName(new).drop(RF.BATTLE_MONTH))


def _stats_pair(spark, sf_dir):
    st = fx.load_star(spark, sf_dir)
    o, c = st["orders"], st["customer"]
    target = fx.player_stats(c, o.where(F.col("o_orderdate") < F.lit(STATS_BEFORE)))
    active = o.where(F.col("o_orderdate") >= F.lit(ACTIVE_FROM)).select(F.col("o_custkey").alias("k"))
    batch = fx.player_stats(c.join(active, F.col("c_custkey") == F.col("k"), "left_semi"), o)
    return target, batch


def q_upsert_stats(spark, sf_dir):
    target, batch = _stats_pair(spark, sf_dir)
    return stable(upsert(target, batch, S.STATS_KEY, RF.player_order()))


def q_upsert_partial_columns(spark, sf_dir):
    target, batch = _stats_pair(spark, sf_dir)
    part = batch.select("tag", "wins", "losses", "battleCount",
                        F.lit(None).cast("int").alias("threeCrownWins"))
    return stable(upsert(target, part, S.STATS_KEY, [F.col("battleCount")]))


def q_pk_violations(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem")
    return stable(key_violations(li, ["l_orderkey", "l_linenumber"]))


def q_check_violations(spark, sf_dir):
    pd_ = M.player_dim(Game(spark, sf_dir).player_stats())
    return stable(check_violations(
        pd_, {"current_trophies_not_larger_than_best_trophies":
              F.col("trophy_count") <= F.col("best_trophy_count")},
        ["player_tag", "trophy_count", "best_trophy_count"]))


def q_orphan_facts(spark, sf_dir):
    g = Game(spark, sf_dir)
    dims = {"player_dim": (M.player_dim(g.player_stats()), "player_id", "player_id"),
            "clan_dim": (M.clan_dim(g.clan_stats()), "clan_id", "clan_id"),
            "deck_dim": (g.deck(), "deck_id", "deck_id"),
            "date_dim": (g.dates(), "date_id", "date_id")}
    return stable(orphan_facts(g.fct(), dims, ["battle_id", "player_id"]))


def q_flatten_struct(spark, sf_dir):
    ev = fx.read_table(spark, sf_dir, "events")
    nested = ev.select("event_id", F.from_json("props", "k INT").alias("props"),
                       F.struct("user_id", F.struct("event_type", "value").alias("what")).alias("who"))
    return stable(flatten_struct(nested))


def landed_responses(events):
    """Events as landed API responses: (key, status, body)."""
    et = F.col("event_type")
    status = F.when(et == "error", F.lit(500)).when(et == "signup", F.lit(404)).otherwise(F.lit(200))
    body = (F.when((et == "click") & (F.col("value") < 50), F.lit("[]"))
             .when((et == "purchase") & (F.col("value") < 20), F.lit(""))
             .otherwise(F.col("props")))
    return events.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("key"),
                         status.alias("status"), body.alias("body"))


def q_response_routing(spark, sf_dir):
    ev = fx.read_table(spark, sf_dir, "events")
    return stable(JS.outcome_counts(JS.route_responses(landed_responses(ev))))


def q_request_urls(spark, sf_dir):
    c = fx.read_table(spark, sf_dir, "customer")
    enc = encode_tag("c_name")
    return stable(c.select(F.col("c_name").alias("tag"), enc.alias("encoded_tag"),
                           format_url(BATTLELOG_URL, enc).alias("battlelog_url"),
                           format_url(PLAYER_URL, enc).alias("player_url")))


def dump_file_names(orders):
    return orders.select(F.concat(F.lit("battles_"), F.date_format("o_orderdate", "MMddyyyy"),
                                  F.lit("_WL_tagged.csv")).alias("file_name")).distinct()


def q_filename_date_range(spark, sf_dir):
    o = fx.read_table(spark, sf_dir, "orders")
    return stable(FS.date_range_label(dump_file_names(o)))


def ladder_frame(log):
    """Ladder dump rows with dotted column names (``winner.tag``, ``loser.tag``)."""
    team_won = F.col("team_crowns") >= F.col("opponent_crowns")
    return log.select(
        F.when(team_won, F.col("team_tag")).otherwise(F.col("opponent_tag")).alias("winner.tag"),
        F.when(team_won, F.col("opponent_tag")).otherwise(F.col("team_tag")).alias("loser.tag"),
        F.col("battleTime"))


def ladder_tags(ladder):
    """Distinct player tags of winners and losers (D9 ladder variant), one scan."""
    return ladder.select(F.explode(F.array(F.col("`winner.tag`"), F.col("`loser.tag`")))
                         .alias("player_tag")).distinct()


def q_dotted_columns(spark, sf_dir):
    return stable(ladder_tags(ladder_frame(Game(spark, sf_dir).log)))


def q_parse_battle_log(spark, sf_dir):
    docs = P.battle_documents(Game(spark, sf_dir).log)
    return stable(P.parse_battle_json(docs))


def q_parse_players(spark, sf_dir):
    ps = Game(spark, sf_dir).player_stats()
    doc = F.to_json(F.struct(*[F.col(c) for c in ps.columns],
                             F.lit("member").alias("role"),
                             F.struct(F.lit(54000001).alias("id"), F.lit("Arena 1").alias("name")).alias("arena")))
    parsed = ps.select(doc.alias("body")).select(F.from_json("body", P.PLAYER).alias("p")).select("p.*")
    return stable(P.parse_player(parsed))


def q_parse_clans(spark, sf_dir):
    cs = Game(spark, sf_dir).clan_stats()
    doc = F.to_json(F.struct(
        *[F.col(c) for c in ["tag", "name", "type", "description", "clanScore", "clanWarTrophies",
                             "requiredTrophies", "members"]],
        F.lit(16000001).alias("badgeId"),
        F.struct(F.col("location_id").alias("id"), F.col("location_name").alias("name"),
                 F.col("is_country").alias("isCountry")).alias("location")))
    parsed = cs.select(doc.alias("body")).select(F.from_json("body", P.CLAN).alias("c")).select("c.*")
    return stable(P.parse_clan(parsed))


def q_csv_to_parquet(spark, sf_dir):
    log = Game(spark, sf_dir).log
    base = shared_dir(spark, "ladder")
    # one dump folder per month, in files of the size AQE advises
    ladder = ladder_frame(log).withColumn("dump", F.substring("battleTime", 1, 6))
    ladder.hint("rebalance", "dump").write.mode("overwrite").partitionBy("dump") \
          .option("header", True).csv(base + "/csv")
    out = FS.csv_to_parquet(spark, base + "/csv", base + "/parquet",
                            schema="`winner.tag` STRING, `loser.tag` STRING, battleTime STRING",
                            suffix=".csv")
    return stable(out.select("`winner.tag`", "`loser.tag`", "battleTime"))


def q_stream_ingest(spark, sf_dir):
    log = Game(spark, sf_dir).log
    base = shared_dir(spark, "stream")
    log.write.mode("overwrite").option("compression", "gzip").json(base + "/landing")
    from ..streaming.ingest import stream_insert_ignore
    stream_insert_ignore(spark, base + "/landing", base + "/table", base + "/checkpoint", order=RF.log_order())
    return stable(spark.read.schema(S.PLAYER_BATTLE_LOG).parquet(base + "/table").drop(RF.BATTLE_MONTH))


_REFRESHED: dict[tuple[str, str], dict] = {}


def _refreshed(spark, sf_dir):
    """All tables of one monthly refresh, run once per application and directory
    in schemas of its own."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REFRESHED:
        g = Game(spark, sf_dir)
        st = g.star
        _REFRESHED[key] = RF.refresh_all(
            spark, shared_dir(spark, "warehouse"), g.log, g.cards, g.player_stats(), g.clan_stats(),
            FIXTURE_DECK_CATEGORIES, seasons=fx.season_ids(st["orders"]),
            top_players=top_players(st["orders"], st["customer"], st["nation"]),
            prefix=f"r{uuid.uuid4().hex[:8]}_")
    return _REFRESHED[key]


def q_refresh_daily(spark, sf_dir):
    """Facts after the battles came in two daily loads that overlap by a year."""
    g = Game(spark, sf_dir)
    wh, prefix = shared_dir(spark, "warehouse"), f"d{uuid.uuid4().hex[:8]}_"
    RF.init_warehouse(spark, wh, prefix=prefix)
    RF._rebuild(spark, wh, RF.Names(prefix)(RF.CARDS), g.cards)
    for part in (F.col("battleTime") < SPLIT_OLD, F.col("battleTime") >= SPLIT_NEW):
        out = RF.refresh_daily(spark, wh, g.log.where(part), g.player_stats(), FIXTURE_DECK_CATEGORIES, prefix=prefix)
    return stable(out["fct_battle"])


def _refreshed_query(name):
    def q(spark, sf_dir):
        return stable(_refreshed(spark, sf_dir)[name])
    return q


_SNAPSHOTS: dict[tuple[str, str], dict] = {}


def _snapshot(spark, sf_dir):
    """Every table exported to files and imported again, in schemas of its own;
    once per application and directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SNAPSHOTS:
        _SNAPSHOTS[key] = _make_snapshot(spark, sf_dir)
    return _SNAPSHOTS[key]


def _make_snapshot(spark, sf_dir):
    g = Game(spark, sf_dir)
    st = g.star
    frames = {
        "player_dim": M.player_dim(g.player_stats()), "deck_dim": g.deck(),
        "date_dim": g.dates(), "fct_battle": g.fct().drop(RF.BATTLE_MONTH), "clan_dim": M.clan_dim(g.clan_stats()),
        "card_dim": g.card_dim(), "raw.player_battle_log": g.log,
        "staging.stg_top_players_by_season": top_players(st["orders"], st["customer"], st["nation"]),
        "staging.stg_seasons": M.season_urls(fx.season_ids(st["orders"])),
        "staging.stg_cards": g.cards, "staging.stg_player_stats": g.player_stats(),
        "staging.stg_clan_stats": g.clan_stats()}
    base = shared_dir(spark, "snapshot")
    export_snapshot(frames, base + "/files")
    return import_snapshot(spark, base + "/files", base + "/tables", prefix=f"s{uuid.uuid4().hex[:8]}_")


def q_snapshot_roundtrip(spark, sf_dir):
    return table_counts(_snapshot(spark, sf_dir))


def _snapshot_query(table):
    def q(spark, sf_dir):
        return stable(_snapshot(spark, sf_dir)[table])
    return q


QUERIES.update({
    "top_players_per_season": q_top_players_per_season,
    "insert_ignore_log": q_insert_ignore_log,
    "upsert_stats": q_upsert_stats,
    "upsert_partial_columns": q_upsert_partial_columns,
    "pk_violations": q_pk_violations,
    "check_violations": q_check_violations,
    "orphan_facts": q_orphan_facts,
    "flatten_struct": q_flatten_struct,
    "response_routing": q_response_routing,
    "request_urls": q_request_urls,
    "filename_date_range": q_filename_date_range,
    "dotted_columns": q_dotted_columns,
    "parse_battle_log": q_parse_battle_log,
    "parse_players": q_parse_players,
    "parse_clans": q_parse_clans,
    "csv_to_parquet": q_csv_to_parquet,
    "stream_ingest": q_stream_ingest,
    "refresh_daily": q_refresh_daily,
    "refresh_player_dim": _refreshed_query("player_dim"),
    "refresh_date_dim": _refreshed_query("date_dim"),
    "refresh_deck_dim": _refreshed_query("deck_dim"),
    "refresh_card_dim": _refreshed_query("card_dim"),
    "refresh_clan_dim": _refreshed_query("clan_dim"),
    "refresh_season_urls": _refreshed_query("stg_seasons"),
    "refresh_top_players_per_season": _refreshed_query("stg_top_players_by_season"),
    "snapshot_facts": _snapshot_query("fct_battle"),
    "snapshot_top_players": _snapshot_query("staging.stg_top_players_by_season"),
    "snapshot_player_dim": _snapshot_query("player_dim"),
    "snapshot_deck_dim": _snapshot_query("deck_dim"),
    "snapshot_date_dim": _snapshot_query("date_dim"),
    "snapshot_clan_dim": _snapshot_query("clan_dim"),
    "snapshot_card_dim": _snapshot_query("card_dim"),
    "snapshot_log": _snapshot_query("raw.player_battle_log"),
    "snapshot_seasons": _snapshot_query("staging.stg_seasons"),
    "snapshot_cards": _snapshot_query("staging.stg_cards"),
    "snapshot_player_stats": _snapshot_query("staging.stg_player_stats"),
    "snapshot_clan_stats": _snapshot_query("staging.stg_clan_stats"),
    "snapshot_roundtrip": q_snapshot_roundtrip,
})


# ---- ordering helpers (O3, O6, A6) -------------------------------------------
from pyspark.sql import Window  # noqa: E402


def q_arena_order(spark, sf_dir):
    """Arenas seen in battles with their dashboard position (O6): the fixed
    category list first, anything unlisted after it."""
    log = Game(spark, sf_dir).log
    arenas = log.where(F.col("arena_name").isNotNull()).select("arena_name").distinct()
    return stable(arenas.select("arena_name", R.category_rank(F.col("arena_name"), R.ARENA_ORDER)
                                .cast("int").alias("arena_rank")))


def q_season_order(spark, sf_dir):
    """Distinct seasons with their position in season order (A6/O3).  The
    ranking window sees one row per season (bounded by the months covered),
    after a distributed distinct."""
    seasons = fx.season_ids(fx.read_table(spark, sf_dir, "orders"))
    w = Window.orderBy("id")
    return stable(seasons.select("id", F.row_number().over(w).cast("int").alias("season_rank")))


QUERIES.update({"arena_order": q_arena_order, "season_order": q_season_order})


def q_first_side_fields(spark, sf_dir):
    """First member of each side, nested fields flattened with a side prefix
    (F25, P7), read back from API battle documents of the whole log."""
    from ..functions.arrays import first_element_fields
    docs = P.battle_documents(Game(spark, sf_dir).log)
    parsed = docs.select(F.from_json("body", P.BATTLE).alias("b")).select("b.*")
    fields = {"tag": "tag", "clan_tag": "clan.tag", "clan_badgeId": "clan.badgeId", "crowns": "crowns"}
    return stable(parsed.select(*first_element_fields("team", fields, "team"),
                                *first_element_fields("opponent", fields, "opponent")))


QUERIES["first_side_fields"] = q_first_side_fields


# ---- landed files, keys, small projections -----------------------------------
def q_fct_battle_keys(spark, sf_dir):
    return Game(spark, sf_dir).fct().select("battle_id", "player_id", "deck_id", "clan_id")


def q_exclude_star(spark, sf_dir):
    part = fx.read_table(spark, sf_dir, "part")
    return stable(part.withColumn("doubled", F.col("p_retailprice") * 2).drop("p_retailprice"))


def q_literal_season(spark, sf_dir):
    return stable(fx.read_table(spark, sf_dir, "part").withColumn("season_id", F.lit("2022-10")))


def q_request_rankings(spark, sf_dir):
    seasons = M.season_urls(fx.season_ids(fx.read_table(spark, sf_dir, "orders")))
    return seasons.select("id", M.ranking_url("query_url", 10).alias("ranking_url"))


def q_request_clans(spark, sf_dir):
    tags = M.clan_tags(Game(spark, sf_dir).log)
    return tags.select("tag", format_url(M.CLAN_URL, encode_tag("tag")).alias("clan_url"))


def q_landed_seasons(spark, sf_dir):
    """Season ids written as ``{"items": [...]}`` documents and read back."""
    o = fx.read_table(spark, sf_dir, "orders").select((F.col("o_orderdate") + F.expr("INTERVAL 22 YEAR")).alias("d"))
    ids = o.select(F.date_format("d", "yyyy-MM").alias("id"), F.year("d").alias("y")).distinct()
    path = shared_dir(spark, "landed-seasons")
    ids.groupBy("y").agg(F.collect_list(F.struct("id")).alias("items")).select(
        F.to_json(F.struct("items")).alias("value")).write.text(path)
    return stable(M.season_urls(JS.read_items(spark, path, "id STRING", multi_line=False)))


def landed_battle_documents(log):
    """The log as API documents with the oddities of real ones: league 1 has a
    second team member, 2 no opponent, 3 no clan field, 4 a Mirror."""
    league = F.col("leagueNumber")
    body = P.battle_documents(log.withColumns({
        "team_cards": F.when(league == 4, F.transform("team_cards", lambda c, i: c.withField(
            "name", F.when(i == 0, F.lit("Mirror")).otherwise(c["name"])))).otherwise(F.col("team_cards")),
        **{c: F.when(league != 3, F.col(c)) for c in ("team_clan_tag", "team_clan_name", "team_clan_badgeId")}}))
    doc = F.from_json("body", P.BATTLE)
    return body.select(doc.alias("b")).select(F.to_json(F.struct(
        *[F.col(f"b.{c}").alias(c) for c in ("type", "battleTime", "isLadderTournament", "arena", "gameMode",
                                             "deckSelection", "isHostedMatch", "leagueNumber")],
        F.when(F.col("b.leagueNumber") == 1, F.concat("b.team", "b.opponent")).otherwise(F.col("b.team")).alias("team"),
        F.when(F.col("b.leagueNumber") == 2, F.slice("b.opponent", 1, 0)).otherwise(F.col("b.opponent")).alias("opponent"),
    )).alias("value"))


#: Battles in a landed array at most, as a player's log has.
BATTLES_PER_ARRAY = 250


def battle_arrays(docs, size: int = BATTLES_PER_ARRAY):
    """Battle documents -> JSON arrays of ``size`` documents, the last of a task with
    the rest.  A task passes its rows on array by array: nothing is shuffled, and it
    holds one Arrow batch and the array it fills, however many battles it reads."""
    def arrays(batches):
        import pyarrow as pa

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array([f"[{','.join(x)}]" for x in found], pa.string())], ["value"])

        held = []
        for batch in batches:
            held += batch.column(0).drop_null().to_pylist()
            full = len(held) - len(held) % size
            yield rows([held[i:i + size] for i in range(0, full, size)])
            held = held[full:]
        if held:
            yield rows([held])
    return docs.select("value").mapInArrow(arrays, "value string")


def q_landed_battles(spark, sf_dir):
    """Battle arrays as an API lands them, written to files and read back."""
    path = shared_dir(spark, "landed-battles")
    docs = landed_battle_documents(Game(spark, sf_dir).log)
    # a gzip file is one task when it is read again: it holds a small split of the log
    with small_splits(spark):
        battle_arrays(docs).write.option("compression", "gzip").text(path)
    return stable(P.parse_battle_log(JS.read_array(spark, path, P.BATTLE, multi_line=False)))


def q_landed_players(spark, sf_dir):
    """Player documents, one object each, with missing fields; ladder variant (S3)."""
    g = Game(spark, sf_dir)
    ps = g.player_stats().join(g.star["customer"].select(F.col("c_name").alias("tag"), "c_nationkey"), "tag")
    doc = F.to_json(F.struct(
        *[F.col(c) for c in S.names(S.STG_PLAYER_STATS)], F.lit("x").alias("unknownField"),
        F.when(F.col("expLevel") % 2 == 0, F.lit("member")).alias("role"),
        F.when(F.col("expLevel") % 3 == 0, F.struct(
            F.concat(F.lit("Card "), F.col("expLevel").cast("string")).alias("name"),
            (F.lit(26000000).cast("bigint") + F.col("expLevel")).alias("id"))).alias("currentFavoriteCard"),
        F.when(F.col("c_nationkey") != 0, F.struct(
            F.concat(F.lit("#C"), F.col("c_nationkey").cast("string")).alias("tag"))).alias("clan")))
    path = shared_dir(spark, "landed-players")
    ps.select(doc.alias("value")).write.text(path)
    return stable(P.parse_player_ladder(JS.read_object(spark, path, P.PLAYER_LADDER, multi_line=False)))


def _rename_parts(spark, folder: str, suffix: str) -> None:
    """``folder/dump=NAME/part-...`` to ``folder/NAME<suffix>``; further files of a
    month go to folders of their own, ``folder/2/NAME<suffix>`` and on."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in store.listStatus(path(folder)):
        name = d.getPath().getName()
        if name.startswith("dump="):
            files = sorted((f.getPath() for f in store.listStatus(d.getPath()) if f.getPath().getName().startswith("part-")),
                           key=lambda f: f.getName())
            for n, f in enumerate(files, 1):
                home = folder if n == 1 else f"{folder}/{n}"
                store.mkdirs(path(home))
                if not store.rename(f, path(home, name[5:] + suffix)):
                    raise OSError(f"cannot move {f}")
            store.delete(d.getPath(), True)


def q_landed_ladder(spark, sf_dir):
    """Monthly CSV dumps with dates in their names -> Parquet -> one table named
    by its range of dates (S6, S7, K8, K11, D11, F27)."""
    base = shared_dir(spark, "dumps")
    month = F.concat(F.lit("x"), F.substring("battleTime", 5, 2), F.lit("01"), F.substring("battleTime", 1, 4), F.lit("y"))
    rows = ladder_frame(Game(spark, sf_dir).log).withColumn("dump", month).drop("battleTime")
    rows.repartition("dump").write.partitionBy("dump").option("header", True).csv(base + "/csv")
    _rename_parts(spark, base + "/csv", "_" + FS.LADDER_SUFFIX)
    rows.limit(1).drop("dump").write.option("header", True).csv(base + "/csv/notes.csv")    # not a dump: skipped
    out = FS.csv_to_parquet(spark, base + "/csv", base + "/parquet")
    label = FS.date_range_label(out.select(F.col("source_file").alias("file_name")).distinct())
    table = ladder_table(spark, base + "/parquet", base + "/table", schema_name=f"l{uuid.uuid4().hex[:8]}_raw",
                         names=out.select(F.col("source_file").alias("file_name")).distinct())
    assert table.split(".")[1] == label.first()["table_name"]
    return stable(spark.table(table).select("`winner.tag`", "`loser.tag`", "source_file",
                                            F.lit(table.split(".")[1]).alias("table_name")))


def q_ladder_tags(spark, sf_dir):
    """Player tags of all dumps of a folder, read by its ``*.parquet`` names, with
    SQL over the frame (S7, S10, D9)."""
    log, base = Game(spark, sf_dir).log, shared_dir(spark, "ladder-files")
    for name, part in {"old": F.col("battleTime") < SPLIT_OLD, "new": F.col("battleTime") >= SPLIT_OLD}.items():
        ladder_frame(log.where(part)).write.parquet(f"{base}/{name}.parquet")
    ladder_frame(log.limit(1)).select(F.lit("not a dump").alias("winner.tag"), F.lit("x").alias("loser.tag"), "battleTime") \
        .write.parquet(f"{base}/other.files")
    return sql_over(spark, "SELECT `winner.tag` AS player_tag FROM {df} UNION SELECT `loser.tag` FROM {df}",
                    df=FS.read_parquet_dir(spark, base, "`winner.tag` STRING, `loser.tag` STRING, battleTime STRING"))


def q_copied_players(spark, sf_dir):
    """A Parquet file copied into a table twice: appended by name, content kept."""
    stats = Game(spark, sf_dir).player_stats()
    base, schema = shared_dir(spark, "copy"), f"c{uuid.uuid4().hex[:8]}"
    stats.select(*reversed(stats.columns)).write.parquet(base + "/stats.parquet")
    ensure_schemas(spark, schema)
    create_table(spark, f"{schema}.stats", S.STG_PLAYER_STATS, base + "/table")
    for _ in range(2):
        append_parquet(spark, f"{schema}.stats", base + "/stats.parquet", S.STG_PLAYER_STATS)
    return stable(spark.table(f"{schema}.stats"))


def q_doubled_keys(spark, sf_dir):
    """A batch with every key twice and some NULL keys: insert-or-ignore keeps the
    first load, upsert (by position) the last; NULL keys never match (W2, K4-K7)."""
    stats = Game(spark, sf_dir).player_stats()
    tag = F.when(F.col("expLevel") != 40, F.col("tag"))
    batch = stats.select(tag.alias("a"), F.explode(F.array(F.lit(1), F.lit(2))).alias("c"), "wins").select(
        "a", F.concat(F.lit("load "), F.col("c").cast("string")).alias("b"), (F.col("wins") + F.col("c")).alias("w"),
        F.col("c").alias("at"))
    empty = spark.createDataFrame([], "tag STRING, name STRING, wins INT, fetch INT")
    key = F.when(F.col("tag").isNotNull(), F.col("wins"))
    first = insert_ignore(empty, batch, ["tag"], order=[F.col("fetch")], by_name=False)
    last = upsert(empty, batch, ["tag"], order=[F.col("fetch")], by_name=False)
    return first.select("tag", F.col("name").alias("kept_first")).alias("f").join(
        last.select("tag", F.col("name").alias("kept_last"), key.alias("last_wins")).alias("l"),
        F.expr("f.tag <=> l.tag")).select("f.tag", "kept_first", "kept_last", "last_wins")


from ..sources.catalog import append_parquet, create_table, ensure_schemas, ladder_table, sql_over  # noqa: E402

QUERIES.update({
    "fct_battle_keys": q_fct_battle_keys, "exclude_star": q_exclude_star, "literal_season": q_literal_season,
    "request_rankings": q_request_rankings, "request_clans": q_request_clans, "landed_seasons": q_landed_seasons,
    "landed_battles": q_landed_battles, "landed_players": q_landed_players, "landed_ladder": q_landed_ladder,
    "ladder_tags": q_ladder_tags, "copied_players": q_copied_players, "doubled_keys": q_doubled_keys})

# ---- tables kept up to date load by load -------------------------------------
from .kept import QUERIES as _KEPT_QUERIES  # noqa: E402

QUERIES.update(_KEPT_QUERIES)
