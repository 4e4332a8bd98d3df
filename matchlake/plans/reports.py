"""Dashboard reports (R1-R5) as lazy DataFrame plans.

Scale notes:
* Card usage multiplies fact rows by deck rows per deck key.  We never join
  fact rows to exploded cards: facts are first counted per deck (partial
  aggregation, so a deck used in a third of all battles costs one counter
  per map task), deck rows are counted per (deck, list), and only these
  counts meet -- exact, also when the deck dimension is not deduplicated
  (where the naive join is quadratic in a deck's popularity).
* Every join partner is pre-aggregated or distinct on its join key, so AQE
  can split any skewed partition of the other side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# fixed values: arena display order on the dashboard; unlisted arenas last
ARENA_ORDER = [f"Arena {i}" for i in range(1, 24)] + ["Legendary Arena", "Clan League"]

CARD_GROUPINGS = ("rarity", "card_type")
TREND_DAYS = 90


def card_usage_counts(fct: DataFrame, deck: DataFrame) -> DataFrame:
    """``card, deck_appearances`` = rows of fct JOIN (deck_dim x UNNEST(cards_list))."""
    f = fct.groupBy("deck_id").agg(F.count(F.lit(1)).alias("__nf"))
    d = deck.groupBy("deck_id", "cards_list").agg(F.count(F.lit(1)).alias("__nd"))
    pairs = f.join(d, "deck_id").select(
        (F.col("__nf") * F.col("__nd")).alias("__w"), F.explode("cards_list").alias("card"))
    return pairs.groupBy("card").agg(F.sum("__w").cast("bigint").alias("deck_appearances"))


def card_usage(fct: DataFrame, deck: DataFrame, card_dim: DataFrame,
               by: str = "rarity") -> DataFrame:
    """Card appearances in battle decks with one card attribute (R2)."""
    if by not in CARD_GROUPINGS:
        raise ValueError(f"by must be one of {CARD_GROUPINGS}, got {by!r}")
    counts = card_usage_counts(fct, deck)
    out = counts.join(card_dim.select("card_name", by), F.col("card") == F.col("card_name")) \
                .select("card", "deck_appearances", by)
    return out.orderBy(F.desc("deck_appearances"), F.asc("card"))


def card_usage_by_cost(fct: DataFrame, deck: DataFrame, card_dim: DataFrame) -> DataFrame:
    """Card appearances with the card's elixir cost."""
    counts = card_usage_counts(fct, deck)
    return counts.join(card_dim.select("card_name", "elixir_cost"),
                       F.col("card") == F.col("card_name")) \
                 .select("card", "deck_appearances", "elixir_cost")


def category_rank(col: Column, order: list[str]) -> Column:
    """Position in a fixed category list; unlisted values sort last."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), col)
    return F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos)


def elixir_cost_by_arena(fct: DataFrame, deck: DataFrame) -> DataFrame:
    """Average deck cost per arena over distinct (player, deck, arena, cost).

    Both join sides are made distinct on their own columns first; the join
    of two distinct inputs on ``deck_id`` is then already distinct, so the
    wide 4-column DISTINCT of the SQL form is not needed.  Because of that
    DISTINCT, ``fct`` may also be the fact rows before their own DISTINCT.
    """
    f = fct.where(F.col("arena_name").isNotNull()) \
           .select("player_id", "deck_id", "arena_name").distinct()
    d = deck.select("deck_id", "average_elixir_cost").distinct()
    rows = f.join(d, "deck_id")
    out = rows.groupBy("arena_name").agg(F.avg("average_elixir_cost").alias("average_elixir_cost"))
    return out.orderBy(category_rank(F.col("arena_name"), ARENA_ORDER), F.col("arena_name"))


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of


def deck_usage_daily(fct: DataFrame, deck: DataFrame, dates: DataFrame,
                     days: int = TREND_DAYS, as_of=None,
                     exclude_selection: str | None = "predefined", ordered: bool = True) -> DataFrame:
    """``battle_date, cards_list, usage``: battles per day per deck.

    Counts a battle once per deck even if both sides used it.  A NULL deck
    selection is dropped like SQL ``<>`` drops it; ``exclude_selection=None``
    keeps every selection method.  The DISTINCT over (battle, day, deck)
    absorbs copies, so ``fct`` may be the fact rows before their DISTINCT.  A
    deck's key stands for its list until battles are counted: no card array goes
    through the DISTINCT, and the lists meet one row per day and deck.

    The window also stands on the facts' own day key (and on their month, if
    they are partitioned by ``battle_month``), so it reaches the scan.
    """
    since = F.date_format(F.date_sub(_as_of(as_of), days), "yyyyMMdd")
    f = fct.where(F.col("date_id") > since)
    if "battle_month" in fct.columns:
        f = f.where(F.col("battle_month") >= F.substring(since, 1, 6))
    if exclude_selection is not None:
        f = f.where(F.col("deck_selection_method") != F.lit(exclude_selection))
    f = f.select("battle_id", "deck_id", "date_id").distinct()
    dd = dates.where(F.col("battle_date") > F.date_sub(_as_of(as_of), days)) \
              .select("date_id", "battle_date")
    dk = deck.select("deck_id", "cards_list").distinct()
    used = f.groupBy("date_id", "deck_id").agg(F.count(F.lit(1)).alias("usage"))
    out = used.join(dd, "date_id").join(dk, "deck_id").select("battle_date", "cards_list", "usage")
    return out.orderBy(F.asc("battle_date"), F.desc("usage")) if ordered else out


def window_days(as_of: _dt.date, days: int = TREND_DAYS) -> list[_dt.date]:
    """The days of a window that ends at ``as_of``."""
    return [as_of - _dt.timedelta(days=k) for k in range(days - 1, -1, -1)]


def deck_usage_pivot(daily: DataFrame, dates: list | None = None) -> DataFrame:
    """One column per day (``yyyy-MM-dd``), SUM(usage), missing -> 0.

    With ``dates`` given (e.g. :func:`window_days`) those are the columns, and
    a day without battles is a column of zeros.  Otherwise the observed days
    are, at most as many as the window has.
    """
    if dates is None:
        # materialize once in the shared checkpoint folder: the day list and
        # the pivot then read it instead of recomputing the whole plan
        ensure_checkpoint_dir(daily.sparkSession)
        daily = daily.checkpoint(eager=True)
        dates = [r[0] for r in daily.select("battle_date").distinct().orderBy("battle_date").collect()]
    vals = [str(d) for d in dates]
    p = daily.withColumn("__d", F.col("battle_date").cast("string")) \
             .groupBy("cards_list").pivot("__d", vals).agg(F.sum("usage"))
    return p.select("cards_list", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(v)
                                    for v in vals])


def deck_usage_trend(daily: DataFrame) -> DataFrame:
    """``cards_list, concatenated, total_usage``.

    The same rows as pivot-then-row-array, without a pivot whose width grows
    with the day count: the window's day list is a scalar subquery (bounded by
    the window length), each deck's (day, usage) pairs are bounded by it too.
    Both read the same exchange; nothing runs while the plan is built.
    """
    day_list = daily.select(F.array_sort(F.collect_set("battle_date")).alias("d")).scalar()
    per = daily.groupBy("cards_list").agg(
        F.map_from_entries(F.collect_list(F.struct("battle_date", "usage"))).alias("__m"))
    conc = F.transform("__days", lambda d: F.coalesce(F.col("__m")[d], F.lit(0).cast("bigint")))
    out = per.withColumn("__days", day_list).select("cards_list", conc.alias("concatenated")) \
             .withColumn("total_usage",
                         F.aggregate("concatenated", F.lit(0).cast("bigint"), lambda a, x: a + x))
    return out.orderBy(F.desc("total_usage"), F.asc(F.to_json("cards_list")))


def card_info(card_dim: DataFrame, images: DataFrame) -> DataFrame:
    """Card catalogue with image, hiding internal columns."""
    j = card_dim.join(images, "card_name")
    return j.select("card_name", "elixir_cost", "card_type", "rarity", "arena_available",
                    "description", "url")
