"""A warehouse whose daily load costs as much as the day, not the log (L1).

The log, the facts and the dimensions that come from the log are published
tables (:mod:`matchlake.sources.published`).  A load

* finds its new battles by an anti join against the stored keys of its own span
  of battle times;
* appends their facts: an insert-or-ignore load cannot change older ones;
* appends days that ``date_dim`` lacks (D2);
* appends decks that ``deck_dim`` lacks, known by an anti join on the stored deck
  keys of the touched buckets (D3);
* merges its battles per (day, deck) into the partials of those days (A2).

A changed catalogue is a change of card flags.  Decks to be counted anew are
found through an inverted index, card -> decks, so a changed card touches the
decks that hold it and no battle.

Every step can be repeated.  Appends carry the load's id, and a table that has it
already is passed over; the log is published last, so that a load that failed
half way finds the same new battles again.  Loads come one after another; a
``load_id`` stands for the same battles whenever it is repeated.

Battles with a NULL key part never match stored ones, so each load keeps them in
the log; their facts may equal stored ones, which are looked up in their months.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import yyyymmdd
from ..functions.keys import list_key
from ..operators.writes import dedupe_stored, insert_ignore
from ..session import CODEC, shared_dir, small_splits
from ..sources import buckets as B
from ..sources import published as P
from . import models as M
from . import reports as R

MONTH = "battle_month"
LOAD = "last_load"
#: Parts of the card index; a card's decks are in one part, in as many files as loads brought them.
CARD_PARTS = 32
PREDEFINED = "predefined"


class Store:
    """Names of the tables of one incrementally kept warehouse."""

    def __init__(self, log: str, facts: str, dates: str, decks: str):
        self.log, self.facts, self.dates, self.decks = log, facts, dates, decks
        self.index, self.flags, self.usage = decks + "_card_index", decks + "_card_flags", decks + "_usage_days"

    def all(self) -> list[str]:
        return [self.log, self.facts, self.dates, self.decks, self.index, self.flags, self.usage]


def create(spark: SparkSession, store: Store, root: str, categories: dict | None = None,
           deck_rows: int = B.BUCKET_ROWS) -> None:
    """CREATE TABLE IF NOT EXISTS of every table."""
    cats = categories or M.GAME_DECK_CATEGORIES
    for name, ddl, part in [
            (store.log, f"{S.PLAYER_BATTLE_LOG}, {MONTH} STRING", MONTH), (store.facts, f"{S.FCT_BATTLE}, {MONTH} STRING", MONTH),
            (store.dates, S.DATE_DIM, "year"), (store.index, "card STRING, deck_row STRING, card_part INT", "card_part"),
            (store.flags, f"`__card` STRING, {', '.join(f'{c} INT' for c in cats)}, part STRING", "part"),
            (store.usage, "deck_id BIGINT, usage BIGINT, date_id STRING", "date_id")]:
        P.create_published(spark, name, ddl, part, f"{root.rstrip('/')}/{name.replace('.', '/')}/{uuid.uuid4().hex[:8]}")
    B.create_growing(spark, store.decks, f"{S.DECK_DIM}, deck_row STRING",
                     f"{root.rstrip('/')}/{store.decks.replace('.', '/')}/{uuid.uuid4().hex[:8]}", deck_rows)


def drop(spark: SparkSession, store: Store) -> None:
    for name in store.all():
        P.drop_published(spark, name)


def _missing(spark: SparkSession, name: str, load_id: str) -> bool:
    return P.properties(spark, name).get(LOAD) != load_id


def _null_key() -> Column:
    out = F.lit(False)
    for k in S.PLAYER_BATTLE_LOG_KEY:
        out = out | F.col(k).isNull()
    return out


def staged_rows(spark: SparkSession, name: str, tag: str) -> DataFrame:
    """Rows of a stage that is not published yet."""
    props = P.properties(spark, name)
    schema = spark.table(props["current"]).schema
    folders = [f"{props['root']}/data/{props['part']}={p}/{P.VERSION}={v}" for p, v in P.staged_parts(spark, tag, props)]
    if not folders:
        return spark.createDataFrame([], schema).drop(P.VERSION)
    return spark.read.schema(schema).option("basePath", f"{props['root']}/data").parquet(*folders).drop(P.VERSION)


def stored_keys(spark: SparkSession, store: Store, landed: DataFrame) -> DataFrame:
    """Stored battles of the batch's span of battle times: months by partition,
    days by the statistics of their files (a load's files hold its own days)."""
    first, last = landed.agg(F.min("battleTime"), F.max("battleTime")).first()
    log = spark.table(store.log)
    if first is None:
        return log.where(F.lit(False))
    return log.where(F.col(MONTH).between(first[:6], last[:6]) & F.col("battleTime").between(first, last))


def new_battles(spark: SparkSession, store: Store, landed: DataFrame, order: list[Column]) -> DataFrame:
    """Battles of the batch that the log lacks; only those of months that the log has meet its keys."""
    there = {p for p, _ in P.parts(spark, store.log)}
    months = [m for (m,) in landed.select(MONTH).distinct().collect() if m in there]
    one = dedupe_stored(landed, S.PLAYER_BATTLE_LOG_KEY, order)
    if not months:
        return one
    known = F.coalesce(F.col(MONTH).isin(months), F.lit(False))
    held = stored_keys(spark, store, landed.where(known)).where(F.col(MONTH).isin(months))
    return one.where(~known).unionByName(insert_ignore(held, one.where(known), S.PLAYER_BATTLE_LOG_KEY, unique=True))


def _clustered(rows: DataFrame, part: str, order: str) -> DataFrame:
    """Rows of a part together, in files of the size AQE advises, ordered for row group statistics."""
    return rows.hint("rebalance", part).sortWithinPartitions(order)


def _in_log_order(facts: DataFrame) -> DataFrame:
    """Facts of staged battles without a shuffle: the stage's files hold a month each,
    so a task has few months to write."""
    return facts.sortWithinPartitions(MONTH, "date_id")


def _new_facts(spark: SparkSession, store: Store, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts to append, ordered for writing; (date_id, deck_id, battle_id) that the day partials have not counted)."""
    def month(fct: DataFrame) -> DataFrame:
        return fct.withColumn(MONTH, F.substring("date_id", 1, 6))

    def uses(fct: DataFrame) -> DataFrame:
        return fct.where(F.col("deck_selection_method") != PREDEFINED).select("date_id", "deck_id", "battle_id").distinct()

    once, rest = (f if f is None else month(f) for f in M.fct_battle_parts(delta.where(~_null_key()).drop(MONTH)))
    sorted_ = [f for f in (once if once is None else _in_log_order(once),
                           rest if rest is None else _clustered(rest, MONTH, "date_id")) if f is not None]
    new = reduce(DataFrame.unionByName, sorted_)
    new_uses = uses(reduce(DataFrame.unionByName, [f for f in (once, rest) if f is not None]))
    odd = delta.where(_null_key())
    months = [r[0] for r in odd.select(F.substring("battleTime", 1, 6)).distinct().collect()]
    if months:
        own = month(M.fct_battle(odd.drop(MONTH)))
        there = spark.table(store.facts).where(F.col(MONTH).isin([m for m in months if m is not None]) | F.col(MONTH).isNull()) \
                     .join(own.select("battle_id").distinct(), "battle_id", "left_semi").select(*own.columns)
        new = new.unionByName(_clustered(own.subtract(there), MONTH, "date_id"))
        new_uses = new_uses.unionByName(uses(own).subtract(uses(there)))
    return new, new_uses


def _deck_row() -> Column:
    """A key of a deck dimension row that is never NULL."""
    return F.md5(F.to_json(F.struct("cards_list", "average_elixir_cost"), {"ignoreNullFields": "false"}))


def _flagged(decks: DataFrame, flags: DataFrame, cats: dict) -> DataFrame:
    return M.deck_counts(decks, flags, cats).withColumns({"deck_id": list_key("cards_list"), "deck_row": _deck_row()})


def add_decks(spark: SparkSession, store: Store, delta: DataFrame, cats: dict, load_id: str) -> int:
    """Decks of new battles that the dimension lacks; returns how many."""
    seen = M.deck_lists(delta).distinct().withColumn("deck_row", _deck_row())
    buckets = int(P.properties(spark, store.decks)["buckets"])
    touched = [r[0] for r in seen.select(B.bucket_of(["deck_row"], buckets)).distinct().collect()]
    stored = spark.table(store.decks).where(F.col(B.BUCKET).isin(touched)).select("deck_row")
    folder = shared_dir(spark, "incremental", "decks")
    seen.join(stored, "deck_row", "left_anti").write.parquet(folder)
    new = spark.read.schema(seen.schema).parquet(folder)
    n = new.count()
    # the index first: decks that are stored already would not be found new again
    if n and _missing(spark, store.index, load_id):
        cards = new.select(F.explode(F.array_distinct("cards_list")).alias("card"), "deck_row").where("card IS NOT NULL")
        cards = cards.withColumn("card_part", F.pmod(F.xxhash64("card"), F.lit(CARD_PARTS)).cast("int"))
        P.append(spark, store.index, _clustered(cards, "card_part", "card"), **{LOAD: load_id})
    if n:
        flags = spark.table(store.flags).drop("part")
        B.upsert_growing(spark, store.decks, _flagged(new.drop("deck_row"), flags, cats), ["deck_row"], [F.lit(1)])
    return n


def change_cards(spark: SparkSession, store: Store, cards: DataFrame, categories: dict | None = None) -> int:
    """Count the decks of changed cards anew; returns how many rows that were."""
    cats = categories or M.GAME_DECK_CATEGORIES
    old = spark.table(store.flags).drop("part")
    new = M.card_flags(cards, cats)
    folder = shared_dir(spark, "incremental", "flags")
    new.write.parquet(folder)
    new = spark.read.schema(new.schema).parquet(folder)
    # a card that is gone and one without any flag count the same
    def flags(side: str) -> Column:
        return F.struct(*[F.coalesce(F.col(f"{side}.{c}"), F.lit(0)).alias(c) for c in cats])
    changed = old.alias("o").join(new.alias("n"), F.col("o.__card") == F.col("n.__card"), "full_outer").where(
        flags("o") != flags("n")).select(F.coalesce("o.__card", "n.__card").alias("card")).where("card IS NOT NULL")
    in_parts = [r[0] for r in changed.select(F.pmod(F.xxhash64("card"), F.lit(CARD_PARTS)).cast("int")).distinct().collect()]
    n = 0
    if in_parts:
        held = spark.table(store.index).where(F.col("card_part").isin(in_parts)).join(changed, "card", "left_semi")
        buckets = int(P.properties(spark, store.decks)["buckets"])
        folder = shared_dir(spark, "incremental", "changed-decks")
        held.select("deck_row").distinct().write.parquet(folder)
        rows = spark.read.schema("deck_row STRING").parquet(folder)
        touched = [r[0] for r in rows.select(B.bucket_of(["deck_row"], buckets)).distinct().collect()]
        decks = spark.table(store.decks).where(F.col(B.BUCKET).isin(touched)).join(rows, "deck_row", "left_semi")
        out = B.upsert_growing(spark, store.decks, _flagged(
            decks.select("cards_list", "average_elixir_cost"), new, cats), ["deck_row"], [F.lit(1)])
        n = out["replaced"]
        P.replace_parts(spark, store.flags, new.withColumn("part", F.lit("all")), ["all"])
    return n


def add_usage(spark: SparkSession, store: Store, uses: DataFrame, as_of, load_id: str, days: int = R.TREND_DAYS) -> None:
    """Merge new battles per (day, deck) into the stored days of the window; days
    that have left it go.  Only the partials of the load's own days are read."""
    if not _missing(spark, store.usage, load_id):
        return
    since = (_dt.date.fromisoformat(str(as_of)) - _dt.timedelta(days=days)).strftime("%Y%m%d")
    delta = uses.where(F.col("date_id") > since).groupBy("date_id", "deck_id").agg(F.count(F.lit(1)).alias("usage"))
    folder = shared_dir(spark, "incremental", "usage")
    delta.write.parquet(folder)
    delta = spark.read.schema(delta.schema).parquet(folder)
    touched = [r[0] for r in delta.select("date_id").distinct().collect()]      # days of the window
    left = [p for p, _ in P.parts(spark, store.usage) if p <= since]
    if not touched and not left:
        return
    merged = spark.table(store.usage).where(F.col("date_id").isin(touched)).unionByName(delta) \
                  .groupBy("date_id", "deck_id").agg(F.sum("usage").alias("usage"))
    P.replace_parts(spark, store.usage, merged.hint("rebalance", "date_id"), [*touched, *left], **{LOAD: load_id})


def load(spark: SparkSession, store: Store, battles: DataFrame, order: list[Column], cards: DataFrame | None = None,
         categories: dict | None = None, as_of=None, load_id: str | None = None) -> dict[str, int]:
    """One load of battles; returns counts of what was fetched, inserted and ignored,
    and of new decks (zeros if the log has the load already)."""
    cats = categories or M.GAME_DECK_CATEGORIES
    load_id = load_id or uuid.uuid4().hex
    if cards is not None:
        change_cards(spark, store, cards, cats)
    if not _missing(spark, store.log, load_id):
        return {"fetched": 0, "inserted": 0, "ignored": 0, "decks": 0}
    folder = shared_dir(spark, "incremental", "landed")
    counts = Observation(), Observation()       # counted while the rows are written, without another pass (A11)
    battles.observe(counts[0], F.count(F.lit(1)).alias("n")).write.parquet(folder, compression=CODEC)
    landed = spark.read.schema(battles.schema).parquet(folder).withColumn(MONTH, F.substring("battleTime", 1, 6))
    new = new_battles(spark, store, landed, order)
    tag = P.stage(spark, store.log, _clustered(new, MONTH, "battleTime").observe(counts[1], F.count(F.lit(1)).alias("n")))
    delta = staged_rows(spark, store.log, tag)
    fetched, inserted = (c.get["n"] for c in counts)
    decks = 0
    if inserted:
        days = M.date_dim(delta)
        known = spark.table(store.dates).select(F.col("date_id").alias("known"))
        if _missing(spark, store.dates, load_id):
            P.append(spark, store.dates, days.join(known, F.expr("date_id <=> known"), "left_anti"), **{LOAD: load_id})
        decks = add_decks(spark, store, delta, cats, load_id)
        if _missing(spark, store.facts, load_id):
            facts, uses = _new_facts(spark, store, delta)
            if as_of is not None:
                add_usage(spark, store, uses, as_of, load_id)
            with small_splits(spark):
                P.append(spark, store.facts, facts, **{LOAD: load_id})
    P.publish(spark, store.log, tag, **{LOAD: load_id})
    return {"fetched": fetched, "inserted": inserted, "ignored": fetched - inserted, "decks": decks}


def deck_dim(spark: SparkSession, store: Store) -> DataFrame:
    return spark.table(store.decks).select(*S.names(S.DECK_DIM))


def date_dim(spark: SparkSession, store: Store) -> DataFrame:
    return spark.table(store.dates).select(*S.names(S.DATE_DIM))


def rolling_usage(spark: SparkSession, store: Store, days: int = R.TREND_DAYS, as_of=None) -> DataFrame:
    """``battle_date, cards_list, usage`` of the window from the day partials alone."""
    since = yyyymmdd(F.date_sub(R._as_of(as_of), days))
    used = spark.table(store.usage).where(F.col("date_id") > since)
    lists = deck_dim(spark, store).select("deck_id", "cards_list").distinct()
    dated = used.join(date_dim(spark, store).select("date_id", "battle_date"), "date_id")
    return dated.join(lists, "deck_id").groupBy("battle_date", "cards_list").agg(F.sum("usage").alias("usage"))
