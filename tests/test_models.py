"""Edge fixtures (hand-written rows): the driver's tables hold no NULLs."""

from pyspark.sql import functions as F

from matchlake import schemas as S
from matchlake.plans import models as M
from matchlake.plans import reports as R

CATS = {"common_count": ("rarity", "Common"), "troop_count": ("type", "Troop")}


def card(name, cost=3, level=11):
    return {"name": name, "level": level, "elixirCost": cost}


def log_rows(spark, rows):
    """rows: dicts with a few log fields; everything else NULL."""
    fields = S.names(S.PLAYER_BATTLE_LOG)
    full = [tuple(r.get(f) for f in fields) for r in rows]
    return spark.createDataFrame(full, S.PLAYER_BATTLE_LOG)


def catalogue(spark):
    return spark.createDataFrame(
        [("k", "Knight", "K", 3, "Troop", "Common", 1, "", 1, None, False),
         ("a", "Arrows", "A", 3, "Spell", "Common", 1, "", 2, None, False),
         ("a2", "Arrows", "A", 3, "Spell", "Common", 1, "", 3, None, False),   # name twice
         ("g", "Golem", "G", 8, "Troop", "Epic", 1, "", 4, None, False)], S.STG_CARDS)


def base(**kw):
    r = {"battleTime": "20231202T101010.000Z", "team_tag": "#A", "opponent_tag": "#B",
         "deckSelection": "collection", "arena_name": "Arena 1",
         "team_cards": [card("Knight")], "opponent_cards": [card("Golem", 8)]}
    r.update(kw)
    return r


def test_deck_counts_and_padding(spark):
    deck = [card("Knight"), card("Knight"), card("Arrows"), card("Unknown", None), card("Golem", 8)]
    log = log_rows(spark, [base(team_cards=deck),
                           base(opponent_cards=[card(str(i)) for i in range(9)])])
    d = M.deck_dim(log, catalogue(spark), categories=CATS).collect()
    by = {tuple(r.cards_list): r for r in d}
    r = by[("Knight", "Knight", "Arrows", "Unknown", "Golem", None, None, None)]
    assert r.common_count == 3          # Knight twice + Arrows once (catalogue dup ignored)
    assert r.troop_count == 3           # Knight twice + Golem
    assert r.average_elixir_cost == (3 + 3 + 3 + 8) / 4
    assert ("0", "1", "2", "3", "4", "5", "6", "7") in by   # cut to 8
    assert len(d) == 4  # team decks differ, opponent decks Golem / 0..7


def test_deck_dim_as_written_keeps_multiplicity(spark):
    log = log_rows(spark, [base(), base(battleTime="20231203T101010.000Z")])
    assert M.deck_dim(log, catalogue(spark), dedupe=False, categories=CATS).count() == 4
    assert M.deck_dim(log, catalogue(spark), dedupe=True, categories=CATS).count() == 2


def test_fct_battle_null_clan_and_one_scan(spark):
    log = log_rows(spark, [base(team_clan_tag="#C1"), base()])  # identical second row
    f = M.fct_battle(log)
    rows = f.collect()
    assert len(rows) == 3          # UNION removes the duplicated opponent row
    assert {r.clan_id is None for r in rows} == {True, False}
    plan = M.fct_battle(log)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan") == 1 and "Union" not in plan


def test_date_dim(spark):
    log = log_rows(spark, [base(), base(battleTime="20231204T000000.123456Z"), base()])
    d = {r.date_id: r for r in M.date_dim(log).collect()}
    assert set(d) == {"20231202", "20231204"}
    assert d["20231202"].is_weekend == "yes" and d["20231204"].is_weekend == "no"
    assert d["20231202"].day_name == "Saturday" and d["20231202"].month_name == "December"


def test_player_dim_ratios(spark):
    stats = spark.createDataFrame([("#A", "a", 1, 10, 5, 0, 0, 0, 0), ("#B", "b", 1, 1, 5, 4, 2, 6, 2)],
                                  S.STG_PLAYER_STATS)
    r = {x.player_tag: x for x in M.player_dim(stats).collect()}
    assert r["#A"].win_loss_ratio is None and r["#A"].three_crown_win_percentage is None
    assert r["#B"].win_loss_ratio == 2.0 and r["#B"].three_crown_win_percentage == 0.5


def test_season_urls_cutover(spark):
    s = spark.createDataFrame([("2022-09",), ("2022-10",), ("2022-10",)], "id string")
    r = {x.id: x.query_url for x in M.season_urls(s).collect()}
    assert "/seasons/2022-09/" in r["2022-09"] and "/pathoflegend/2022-10/" in r["2022-10"]


def test_card_usage_equals_brute_force_join(spark):
    from tests.conftest import SF_SMALL
    from matchlake.plans.registry import Game
    g = Game(spark, SF_SMALL)
    fct, deck = g.fct(), g.deck_model(dedupe=False)
    fast = {r.card: r.deck_appearances for r in R.card_usage_counts(fct, deck).collect()}
    brute = (fct.join(deck.select("deck_id", F.explode("cards_list").alias("card")), "deck_id")
                .groupBy("card").count().collect())
    assert fast == {r.card: r["count"] for r in brute}


def test_trend_matches_pivot(spark):
    from tests.conftest import SF_SMALL
    from matchlake.plans.registry import AS_OF, Game
    g = Game(spark, SF_SMALL)
    daily = R.deck_usage_daily(g.fct(), g.deck(), g.dates(), as_of=AS_OF).cache()
    piv = R.deck_usage_pivot(daily)
    cols = piv.columns[1:]
    a = {tuple(r.cards_list): [r[c] for c in cols] for r in piv.collect()}
    b = {tuple(r.cards_list): list(r.concatenated) for r in R.deck_usage_trend(daily).collect()}
    assert a == b and len(a) > 0


def test_distinct_reports_accept_raw_fact_rows(spark):
    from tests.conftest import SF_SMALL
    from matchlake.plans.registry import AS_OF, Game
    g = Game(spark, SF_SMALL)
    raw = M.fct_battle(g.log, distinct=False)
    doubled = raw.unionByName(raw)      # every fact row copied
    for f in (lambda fct: R.elixir_cost_by_arena(fct, g.deck()),
              lambda fct: R.deck_usage_daily(fct, g.deck(), g.dates(), as_of=AS_OF)):
        def norm(r):  # averages may differ in the last bits with summation order
            return tuple(str(round(v, 9)) if isinstance(v, float) else str(v) for v in r)
        a = sorted(norm(r) for r in f(g.fct()).collect())
        b = sorted(norm(r) for r in f(doubled).collect())
        assert a == b and len(a) > 0
