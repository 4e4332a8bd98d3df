"""Oracle SQL: the same queries written independently as DuckDB SQL over the
driver's pre-registered views.  Comparison formatting mirrors
``matchlake.plans.registry.stable``: nested values as ``to_json`` text, dates
as ISO text, doubles rounded to 6 decimals.
"""

from __future__ import annotations

import datetime

# fixed value: base of the game API's URLs
API_BASE = "https://api.clashroyale.com/v1"


def key(x: str) -> str:
    """60-bit BIGINT from the first 15 hex digits of md5 (NULL stays NULL)."""
    return f"CAST('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15) AS BIGINT)"


def deck8(arr: str) -> str:
    return "[" + ", ".join(f"{arr}[{i}].name" for i in range(1, 9)) + "]"


def cost8(arr: str) -> str:
    return "[" + ", ".join(f"{arr}[{i}].elixirCost" for i in range(1, 9)) + "]"


def slot_list(status: str) -> str:
    return (
        "coalesce(list_transform(list_sort(list({'n': l_linenumber, 'name': name, "
        "'level': CAST(l_quantity AS BIGINT), 'elixirCost': CAST(elixir AS INTEGER)}) "
        f"FILTER (WHERE l_linestatus = '{status}')), "
        "lambda s: {'name': s.name, 'level': s.level, 'elixirCost': s.elixirCost}), [])")


def support(nk: str, rk: str, rn: str) -> str:
    return ("[{'name': 'Tower Princess', "
            f"'id': CAST(159000000 + {rk} AS BIGINT), 'level': CAST(11 + {rk} AS BIGINT), "
            f"'maxLevel': CAST(16 AS BIGINT), 'rarity': lower({rn}), "
            f"'iconUrls': {{'medium': '/support/' || lower({rn}) || '.png'}}}}]")


CTE = {}

CTE["cards"] = """cards AS (
  SELECT lower(replace(p_name, ' ', '-')) AS "key", p_name AS name,
         upper(replace(p_name, ' ', '_')) AS sc_key,
         CAST(min(p_size) AS BIGINT) AS elixir, min(p_type) AS "type", min(p_brand) AS rarity,
         CAST(count(*) AS BIGINT) AS arena, 'The ' || p_name || ' card.' AS description,
         CAST(26000000 + min(p_partkey) AS BIGINT) AS id,
         CASE WHEN min(p_size) > 45 THEN upper(replace(p_name, ' ', '_')) || '_EVO' END AS evolved_spells_sc_key,
         min(p_size) > 45 AS is_evolved
  FROM part GROUP BY p_name)"""

CTE["lines"] = """lines AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_linestatus, c.name, c.elixir
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN cards c ON p.p_name = c.name)"""

CTE["per_order"] = f"""per_order AS (
  SELECT l_orderkey, min(l_suppkey) AS opp_suppkey,
    count(*) FILTER (WHERE l_linestatus = 'O') AS n_team,
    count(*) FILTER (WHERE l_linestatus = 'F') AS n_opp,
    coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS q_team,
    coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS q_opp,
    {slot_list('O')} AS team_cards,
    {slot_list('F')} AS opponent_cards
  FROM lines GROUP BY l_orderkey)"""

_arena = "o.o_orderpriority <> '4-NOT SPECIFIED'"
_digit = "substr(o.o_orderpriority, 1, 1)"
_chg = "(least(po.n_team, 3) - least(po.n_opp, 3)) * 10"
CTE["log"] = f"""log AS (
  SELECT
    CASE o.o_orderstatus WHEN 'F' THEN 'PvP' WHEN 'O' THEN 'pathOfLegend' ELSE 'challenge' END AS "type",
    strftime(o.o_orderdate, '%Y%m%dT%H%M%S.%gZ') AS battleTime,
    o.o_orderpriority = '1-URGENT' AS isLadderTournament,
    CASE WHEN {_arena} THEN CAST(54000000 + CAST({_digit} AS BIGINT) AS BIGINT) END AS arena_id,
    CASE WHEN {_arena} THEN 'Arena ' || {_digit} END AS arena_name,
    CAST(72000000 + c.c_nationkey AS BIGINT) AS gameMode_id,
    'Ladder_' || c.c_mktsegment AS gameMode_name,
    CASE WHEN o.o_orderstatus = 'P' THEN 'predefined' ELSE 'collection' END AS deckSelection,
    o.o_orderpriority = '5-LOW' AS isHostedMatch,
    CAST({_digit} AS BIGINT) AS leagueNumber,
    c.c_name AS team_tag, s.s_name AS opponent_tag,
    'Player ' || CAST(c.c_custkey AS VARCHAR) AS team_name,
    'Player S' || CAST(s.s_suppkey AS VARCHAR) AS opponent_name,
    CAST(floor(c.c_acctbal) AS BIGINT) + 5000 AS team_startingTrophies,
    CAST(floor(s.s_acctbal) AS BIGINT) + 5000 AS opponent_startingTrophies,
    CAST({_chg} AS INTEGER) AS team_trophyChange,
    CAST(-({_chg}) AS INTEGER) AS opponent_trophyChange,
    CAST(least(po.n_team, 3) AS BIGINT) AS team_crowns,
    CAST(least(po.n_opp, 3) AS BIGINT) AS opponent_crowns,
    CAST(po.q_team AS BIGINT) * 100 AS team_kingTowerHitPoints,
    CAST(po.q_opp AS BIGINT) * 100 AS opponent_kingTowerHitPoints,
    [CAST(po.n_team * 1000 AS BIGINT), CAST(po.q_team AS BIGINT) * 10] AS team_princessTowersHitPoints,
    [CAST(po.n_opp * 1000 AS BIGINT), CAST(po.q_opp AS BIGINT) * 10] AS opponent_princessTowersHitPoints,
    CASE WHEN c.c_nationkey <> 0 THEN '#C' || CAST(c.c_nationkey AS VARCHAR) END AS team_clan_tag,
    CASE WHEN s.s_nationkey <> 0 THEN '#C' || CAST(s.s_nationkey AS VARCHAR) END AS opponent_clan_tag,
    CASE WHEN c.c_nationkey <> 0 THEN cn.n_name END AS team_clan_name,
    CASE WHEN s.s_nationkey <> 0 THEN sn.n_name END AS opponent_clan_name,
    CASE WHEN c.c_nationkey <> 0 THEN CAST(16000000 + c.c_nationkey AS BIGINT) END AS team_clan_badgeId,
    CASE WHEN s.s_nationkey <> 0 THEN CAST(16000000 + s.s_nationkey AS BIGINT) END AS opponent_clan_badgeId,
    po.team_cards, po.opponent_cards,
    {support('c.c_nationkey', 'cr.r_regionkey', 'cr.r_name')} AS team_supportCards,
    {support('s.s_nationkey', 'sr.r_regionkey', 'sr.r_name')} AS opponent_supportCards,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN CAST(c.c_custkey AS INTEGER) END AS team_globalRank,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN CAST(s.s_suppkey AS INTEGER) END AS opponent_globalRank,
    c.c_acctbal / 1000.0 AS team_elixirLeaked,
    s.s_acctbal / 1000.0 AS opponent_elixirLeaked
  FROM per_order po
  JOIN orders o ON po.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON po.opp_suppkey = s.s_suppkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey)"""


# per-side fields of the log, in the facts' order
_SIDE = {"tag": "tag", "clan_tag": "clan_tag", "starting_trophies": "startingTrophies", "trophy_change": "trophyChange",
         "crowns_earned": "crowns", "king_tower_hit_points": "kingTowerHitPoints",
         "princess_tower_hit_points": "princessTowersHitPoints", "cards": "cards", "support_cards": "supportCards",
         "global_rank": "globalRank", "elixir_leaked": "elixirLeaked"}


def _side(side: str) -> str:
    return "{" + ", ".join(f"'{k}': {side}_{v}" for k, v in _SIDE.items()) + "}"


# a battle's two sides as two rows, then keys and names
CTE["sides"] = f"""sides AS (
  SELECT "type", battleTime, team_tag, opponent_tag, isLadderTournament, arena_id, arena_name, gameMode_id,
         gameMode_name, deckSelection, isHostedMatch, leagueNumber,
         unnest([{_side('team')}, {_side('opponent')}]) AS s
  FROM log)"""
CTE["fct"] = f"""fct AS (
  SELECT DISTINCT md5(battleTime || coalesce(team_tag, '') || coalesce(opponent_tag, '')) AS battle_id,
    substr(battleTime, 1, 8) AS date_id, {key('s.tag')} AS player_id,
    {key('to_json(' + deck8('s.cards') + ')')} AS deck_id, {key('s.clan_tag')} AS clan_id,
    "type" AS battle_type, isLadderTournament AS is_ladder_tournament, arena_id, arena_name,
    gameMode_id AS game_mode_id, array_to_string(string_split(gameMode_name, '_'), ' ') AS game_mode_name,
    deckSelection AS deck_selection_method, isHostedMatch AS is_hosted_match, leagueNumber AS league_number,
    {", ".join(f"s.{k} AS {k}" for k in list(_SIDE)[2:])}
  FROM sides)"""

CTE["date_dim"] = """date_dim AS (
  SELECT strftime(battle_date, '%Y%m%d') AS date_id, battle_date, "year", "month", month_name,
         "day", day_name, is_weekend, month_day_year
  FROM (SELECT DISTINCT
      CAST(date_trunc('day', t) AS DATE) AS battle_date,
      CAST(year(t) AS BIGINT) AS "year", CAST(month(t) AS BIGINT) AS "month",
      monthname(t) AS month_name, CAST(day(t) AS BIGINT) AS "day", dayname(t) AS day_name,
      CASE WHEN dayname(t) IN ('Saturday', 'Sunday') THEN 'yes' ELSE 'no' END AS is_weekend,
      strftime(t, '%B %-d, %Y') AS month_day_year
    FROM (SELECT strptime(battleTime, '%Y%m%dT%H%M%S.%fZ') AS t FROM log)))"""

# fixed categories of the test data (brands and part types)
FIXTURE_CATS = [
    ("common_count", "rarity", "Brand#1"),
    ("rare_count", "rarity", "Brand#10"),
    ("epic_count", "rarity", "Brand#11"),
    ("legendary_count", "rarity", "Brand#12"),
    ("champion_count", "rarity", "Brand#13"),
    ("troop_count", "type", "SMALL"),
    ("spell_count", "type", "MEDIUM"),
    ("building_count", "type", "LARGE"),
]


def deck_dim_cte(name: str = "deck_dim", dedupe: bool = True, normalize: bool = False) -> str:
    """Every deck's cards meet one row of flags per card name; sides meet their deck's sums."""
    flags = ", ".join(f"max(CASE WHEN \"{col}\" = '{val}' THEN 1 ELSE 0 END) AS {out}" for out, col, val in FIXTURE_CATS)
    sums = ", ".join(f"CAST(coalesce(sum(f.{out}), 0) AS BIGINT) AS {out}" for out, _, _ in FIXTURE_CATS)
    outs = ", ".join(f"c.{out}" for out, _, _ in FIXTURE_CATS)
    lst = deck8("s.cards")
    if normalize:
        lst = f"list_sort({lst}, 'ASC', 'NULLS LAST')"
    rows = "SELECT DISTINCT cards_list, cost FROM all_decks" if dedupe else "SELECT cards_list, cost FROM all_decks"
    return f"""all_decks AS (
  SELECT {lst} AS cards_list, list_avg({cost8('s.cards')}) AS cost FROM sides),
flags AS (SELECT name, {flags} FROM cards GROUP BY name),
deck_cards AS (SELECT d, unnest(d) AS card FROM (SELECT DISTINCT cards_list AS d FROM all_decks)),
deck_sums AS (SELECT d, {sums} FROM deck_cards LEFT JOIN flags f ON f.name = card GROUP BY d),
{name} AS (
  SELECT {key('to_json(cards_list)')} AS deck_id, cards_list, {outs}, cost AS average_elixir_cost
  FROM ({rows}) r JOIN deck_sums c ON c.d = r.cards_list)"""


CTE["card_dim"] = """card_dim AS (
  SELECT name AS card_name, id AS card_id, elixir AS elixir_cost, "type" AS card_type, rarity,
         arena AS arena_available, description, evolved_spells_sc_key, is_evolved
  FROM cards)"""

CTE["player_stats"] = """player_stats AS (
  SELECT c.c_name AS tag, 'Player ' || CAST(c.c_custkey AS VARCHAR) AS name,
    CAST(c.c_nationkey + 30 AS INTEGER) AS expLevel,
    CAST(floor(c.c_acctbal) AS INTEGER) + 5000 AS trophies,
    CAST(coalesce(p.b, 0) * 100 + 5000 AS INTEGER) AS bestTrophies,
    CAST(coalesce(p.w, 0) AS INTEGER) AS wins, CAST(coalesce(p.l, 0) AS INTEGER) AS losses,
    CAST(coalesce(p.b, 0) AS INTEGER) AS battleCount, CAST(coalesce(p.t, 0) AS INTEGER) AS threeCrownWins
  FROM customer c LEFT JOIN (
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS w,
      count(*) FILTER (WHERE o_orderstatus = 'O') AS l, count(*) AS b,
      count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS t
    FROM orders GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey)"""

CTE["clan_stats"] = """clan_stats AS (
  SELECT '#C' || CAST(n.n_nationkey AS VARCHAR) AS tag, n.n_name AS name,
    CASE WHEN n.n_regionkey % 2 = 0 THEN 'open' ELSE 'inviteOnly' END AS "type",
    'Clan of ' || n.n_name AS description,
    CAST(coalesce(m.score, 0) AS INTEGER) AS clanScore,
    CAST(n.n_nationkey * 100 AS INTEGER) AS clanWarTrophies,
    CAST(n.n_regionkey * 1000 + 5000 AS INTEGER) AS requiredTrophies,
    CAST(coalesce(m.m, 0) AS INTEGER) AS members,
    CAST(57000000 + r.r_regionkey AS BIGINT) AS location_id, r.r_name AS location_name,
    n.n_regionkey <> 0 AS is_country
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS m, sum(floor(c_acctbal)) AS score
             FROM customer GROUP BY c_nationkey) m ON n.n_nationkey = m.c_nationkey
  WHERE n.n_nationkey <> 0)"""

CTE["images"] = """images AS (
  SELECT DISTINCT p_name AS card_name, '/cards/' || replace(p_name, ' ', '-') || '.png' AS url FROM part)"""

BASE = ["cards", "lines", "per_order", "log", "sides"]


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    parts = [CTE[n] for n in names] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n" + body


def _usage_counts(deck: str = "deck_dim") -> str:
    """Facts per deck times the deck's rows, summed over its cards."""
    return f"""per_deck AS (SELECT deck_id, count(*) AS facts FROM fct GROUP BY deck_id),
weighted AS (SELECT unnest(cards_list) AS card, facts FROM {deck} JOIN per_deck USING (deck_id)),
card_appearances AS (SELECT card, sum(facts) AS deck_appearances FROM weighted GROUP BY card)"""


def card_usage(by: str, dedupe: bool = True) -> str:
    return with_ctes(BASE + ["fct", "card_dim"], f"""
SELECT a.card, CAST(a.deck_appearances AS BIGINT) AS deck_appearances, card_dim.{by}
FROM card_appearances a JOIN card_dim ON a.card = card_dim.card_name""",
                     [deck_dim_cte(dedupe=dedupe), _usage_counts()])


AS_OF = "DATE '2001-08-01'"


def daily(exclude: bool = True) -> str:
    """Battles of the window, each once per deck; a deck's key stands for its list."""
    cond = "AND deck_selection_method <> 'predefined'" if exclude else ""
    return f"""window_facts AS (
  SELECT DISTINCT battle_id, strptime(date_id, '%Y%m%d')::DATE AS battle_date, deck_id FROM fct
  WHERE date_id > strftime({AS_OF} - INTERVAL 90 DAY, '%Y%m%d') {cond}),
lists AS (SELECT DISTINCT deck_id, cards_list FROM deck_dim),
daily AS (SELECT battle_date, cards_list, count(DISTINCT battle_id) AS usage
  FROM window_facts JOIN lists USING (deck_id) GROUP BY ALL)"""


def _daily_query(exclude: bool) -> str:
    return with_ctes(BASE + ["fct", "date_dim"], """
SELECT strftime(battle_date, '%Y-%m-%d') AS battle_date, to_json(cards_list) AS cards_list,
       CAST(usage AS BIGINT) AS usage
FROM daily""", [deck_dim_cte(), daily(exclude)])


def _r6(x: str) -> str:
    return f"round({x}, 6)"


SQL: dict[str, str] = {}
SQL["card_usage_by_rarity"] = card_usage("rarity")
SQL["card_usage_by_type"] = card_usage("card_type")
SQL["card_usage_fanout"] = card_usage("rarity", dedupe=False)
SQL["card_usage_by_cost"] = card_usage("elixir_cost")
SQL["elixir_cost_by_arena"] = with_ctes(BASE + ["fct"], f"""
, seen AS (SELECT DISTINCT arena_name, player_id, deck_id FROM fct WHERE arena_name IS NOT NULL),
prices AS (SELECT DISTINCT deck_id, average_elixir_cost FROM deck_dim)
SELECT arena_name, {_r6('avg(average_elixir_cost)')} AS average_elixir_cost
FROM seen JOIN prices USING (deck_id) GROUP BY arena_name""", [deck_dim_cte(dedupe=False)])
SQL["deck_usage_daily"] = _daily_query(True)
SQL["deck_usage_inclusive"] = _daily_query(False)
_days = [str(datetime.date(2001, 8, 1) - datetime.timedelta(days=k)) for k in range(89, -1, -1)]
_columns = ",\n".join(f"CAST(sum(CASE WHEN battle_date = DATE '{d}' THEN usage ELSE 0 END) AS BIGINT) AS \"{d}\"" for d in _days)
SQL["deck_usage_pivot"] = with_ctes(BASE + ["fct"], f"""
SELECT to_json(cards_list) AS cards_list,
{_columns}
FROM daily GROUP BY daily.cards_list""", [deck_dim_cte(), daily(True)])
_TREND = """
, days AS (SELECT DISTINCT battle_date FROM daily),
grid AS (
  SELECT k.cards_list, d.battle_date, COALESCE(x.usage, 0) AS usage
  FROM (SELECT DISTINCT cards_list FROM daily) k CROSS JOIN days d
  LEFT JOIN daily x ON x.cards_list = k.cards_list AND x.battle_date = d.battle_date)
SELECT to_json(cards_list) AS cards_list,
       to_json(list(CAST(usage AS BIGINT) ORDER BY battle_date)) AS concatenated,
       CAST(SUM(usage) AS BIGINT) AS total_usage
FROM grid GROUP BY cards_list"""
SQL["deck_usage_trend"] = with_ctes(BASE + ["fct", "date_dim"], _TREND, [deck_dim_cte(), daily(True)])
SQL["card_info"] = with_ctes(["cards", "card_dim", "images"], """
SELECT card_name, elixir_cost, card_type, rarity, arena_available, description, url
FROM card_dim JOIN images USING (card_name)""")

SQL["fct_battle"] = with_ctes(BASE + ["fct"], f"""
SELECT battle_id, date_id, player_id, deck_id, clan_id, battle_type, is_ladder_tournament, arena_id,
  arena_name, game_mode_id, game_mode_name, deck_selection_method, is_hosted_match, league_number,
  starting_trophies, trophy_change, crowns_earned, king_tower_hit_points,
  to_json(princess_tower_hit_points) AS princess_tower_hit_points, to_json(cards) AS cards,
  to_json(support_cards) AS support_cards, global_rank, {_r6('elixir_leaked')} AS elixir_leaked
FROM fct""")
SQL["date_dim"] = with_ctes(BASE + ["date_dim"], """
SELECT date_id, strftime(battle_date, '%Y-%m-%d') AS battle_date, "year", "month", month_name, "day",
       day_name, is_weekend, month_day_year
FROM date_dim""")
_deck_out = """
SELECT deck_id, to_json(cards_list) AS cards_list, common_count, rare_count, epic_count,
  legendary_count, champion_count, troop_count, spell_count, building_count,
  round(average_elixir_cost, 6) AS average_elixir_cost
FROM deck_dim"""
SQL["deck_dim"] = with_ctes(BASE, _deck_out, [deck_dim_cte()])
SQL["deck_dim_as_written"] = with_ctes(BASE, _deck_out, [deck_dim_cte(dedupe=False)])
SQL["deck_dim_unordered"] = with_ctes(BASE, _deck_out, [deck_dim_cte(normalize=True)])
SQL["player_dim"] = with_ctes(["player_stats"], f"""
SELECT {key('tag')} AS player_id, tag AS player_tag, name AS player_name,
  expLevel AS experience_level, trophies AS trophy_count, bestTrophies AS best_trophy_count,
  wins, losses, battleCount AS battle_count, threeCrownWins AS three_crown_wins,
  {_r6('threeCrownWins / nullif(wins, 0)')} AS three_crown_win_percentage,
  {_r6('wins / nullif(losses, 0)')} AS win_loss_ratio
FROM player_stats""")
SQL["clan_dim"] = with_ctes(["clan_stats"], f"""
SELECT {key('tag')} AS clan_id, tag AS clan_tag, name AS clan_name, "type" AS clan_type,
  description, clanScore AS clan_score, clanWarTrophies AS clan_war_trophies,
  requiredTrophies AS required_trophies, members AS member_count, location_id, location_name,
  is_country
FROM clan_stats""")
SQL["card_dim"] = with_ctes(["cards", "card_dim"], "\nSELECT * FROM card_dim")
SQL["participant_tags"] = with_ctes(BASE, """
SELECT DISTINCT team_tag AS tag FROM log
UNION
SELECT DISTINCT opponent_tag AS tag FROM log""")
SQL["clan_tags"] = with_ctes(BASE, """
SELECT DISTINCT team_clan_tag AS tag FROM log WHERE team_clan_tag IS NOT NULL
UNION
SELECT DISTINCT opponent_clan_tag AS tag FROM log WHERE opponent_clan_tag IS NOT NULL""")
SQL["season_urls"] = f"""
WITH seasons AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS id FROM orders)
SELECT DISTINCT id,
  CASE WHEN id > '2022-09'
       THEN '{API_BASE}/locations/global/pathoflegend/' || id || '/rankings/players/'
       ELSE '{API_BASE}/locations/global/seasons/' || id || '/rankings/players/' END
  AS query_url
FROM seasons"""


# ---- ingest, keyed writes, quality -------------------------------------------
LOG_COLS = [
    "type", "battleTime", "isLadderTournament", "arena_id", "arena_name", "gameMode_id",
    "gameMode_name", "deckSelection", "isHostedMatch", "leagueNumber", "team_tag", "opponent_tag",
    "team_name", "opponent_name", "team_startingTrophies", "opponent_startingTrophies",
    "team_trophyChange", "opponent_trophyChange", "team_crowns", "opponent_crowns",
    "team_kingTowerHitPoints", "opponent_kingTowerHitPoints", "team_princessTowersHitPoints",
    "opponent_princessTowersHitPoints", "team_clan_tag", "opponent_clan_tag", "team_clan_name",
    "opponent_clan_name", "team_clan_badgeId", "opponent_clan_badgeId", "team_cards",
    "opponent_cards", "team_supportCards", "opponent_supportCards", "team_globalRank",
    "opponent_globalRank", "team_elixirLeaked", "opponent_elixirLeaked"]
_NESTED = {"team_princessTowersHitPoints", "opponent_princessTowersHitPoints", "team_cards",
           "opponent_cards", "team_supportCards", "opponent_supportCards"}
_DOUBLE = {"team_elixirLeaked", "opponent_elixirLeaked"}


def log_out(src: str) -> str:
    cols = []
    for c in LOG_COLS:
        q = f'"{c}"'
        if c in _NESTED:
            cols.append(f"to_json({q}) AS {q}")
        elif c in _DOUBLE:
            cols.append(f"round({q}, 6) AS {q}")
        else:
            cols.append(q)
    return f"SELECT {', '.join(cols)} FROM {src}"


_LOG_KEY = "team_tag, opponent_tag, battleTime"
_LOG_ORDER = "to_json(team_cards), to_json(opponent_cards)"


def player_stats_cte(name: str, order_where: str = "TRUE", cust_where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT c.c_name AS tag, 'Player ' || CAST(c.c_custkey AS VARCHAR) AS name,
    CAST(c.c_nationkey + 30 AS INTEGER) AS expLevel,
    CAST(floor(c.c_acctbal) AS INTEGER) + 5000 AS trophies,
    CAST(coalesce(p.b, 0) * 100 + 5000 AS INTEGER) AS bestTrophies,
    CAST(coalesce(p.w, 0) AS INTEGER) AS wins, CAST(coalesce(p.l, 0) AS INTEGER) AS losses,
    CAST(coalesce(p.b, 0) AS INTEGER) AS battleCount, CAST(coalesce(p.t, 0) AS INTEGER) AS threeCrownWins
  FROM customer c LEFT JOIN (
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS w,
      count(*) FILTER (WHERE o_orderstatus = 'O') AS l, count(*) AS b,
      count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS t
    FROM orders WHERE {order_where} GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey
  WHERE {cust_where})"""


_STATS_T = player_stats_cte("t", "o_orderdate < DATE '2000-01-01'")
_STATS_B = player_stats_cte(
    "b", "TRUE", "c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01')")

SQL["top_players_per_season"] = """
WITH per AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS season_id, o_custkey,
         sum(floor(o_totalprice * 100)) AS score, count(*) AS n
  FROM orders GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY season_id ORDER BY score DESC, o_custkey ASC) AS rank
  FROM per)
SELECT c.c_name AS tag, 'Player ' || CAST(c.c_custkey AS VARCHAR) AS name,
  CAST(c.c_nationkey + 30 AS BIGINT) AS expLevel, CAST(r.n * 10 + 5000 AS BIGINT) AS tophies,
  CAST(r.rank AS BIGINT) AS rank,
  to_json({'tag': CASE WHEN c.c_nationkey <> 0 THEN '#C' || CAST(c.c_nationkey AS VARCHAR) END,
           'name': CASE WHEN c.c_nationkey <> 0 THEN n.n_name END,
           'badgeId': CASE WHEN c.c_nationkey <> 0 THEN CAST(16000000 + c.c_nationkey AS BIGINT) END}) AS clan,
  r.season_id
FROM ranked r JOIN customer c ON r.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE r.rank <= 10"""

SQL["insert_ignore_log"] = with_ctes(BASE, log_out("(SELECT * FROM tgt UNION ALL SELECT * FROM new)"), [
    "tgt AS (SELECT * FROM log WHERE battleTime < '20000101')",
    "b AS (SELECT * FROM log WHERE battleTime >= '19990101')",
    f"""bd AS (SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {_LOG_KEY} ORDER BY {_LOG_ORDER}) AS rn FROM b)
    WHERE rn = 1)""",
    """new AS (SELECT * FROM bd WHERE NOT EXISTS (
      SELECT 1 FROM tgt WHERE tgt.team_tag = bd.team_tag AND tgt.opponent_tag = bd.opponent_tag
        AND tgt.battleTime = bd.battleTime))"""])

SQL["upsert_stats"] = f"""
WITH {_STATS_T}, {_STATS_B}
SELECT * FROM b
UNION ALL
SELECT * FROM t WHERE tag NOT IN (SELECT tag FROM b)"""

SQL["upsert_partial_columns"] = f"""
WITH {_STATS_T}, {_STATS_B}
SELECT t.tag, t.name, t.expLevel, t.trophies, t.bestTrophies, b.wins, b.losses, b.battleCount,
       CAST(NULL AS INTEGER) AS threeCrownWins
FROM t JOIN b ON t.tag = b.tag
UNION ALL
SELECT * FROM t WHERE tag NOT IN (SELECT tag FROM b)
UNION ALL
SELECT b.tag, NULL, NULL, NULL, NULL, b.wins, b.losses, b.battleCount, NULL
FROM b WHERE tag NOT IN (SELECT tag FROM t)"""

SQL["pk_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n,
  CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS reason
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"""

SQL["check_violations"] = with_ctes(["player_stats"], """
SELECT tag AS player_tag, trophies AS trophy_count, bestTrophies AS best_trophy_count,
       'current_trophies_not_larger_than_best_trophies' AS check_name
FROM player_stats WHERE NOT coalesce(trophies <= bestTrophies, TRUE)""")

SQL["orphan_facts"] = with_ctes(BASE + ["fct", "date_dim", "player_stats", "clan_stats"], f"""
SELECT battle_id, player_id, 'player_dim' AS dimension FROM fct
WHERE player_id IS NOT NULL AND player_id NOT IN (SELECT {key('tag')} FROM player_stats)
UNION ALL
SELECT battle_id, player_id, 'clan_dim' FROM fct
WHERE clan_id IS NOT NULL AND clan_id NOT IN (SELECT {key('tag')} FROM clan_stats)
UNION ALL
SELECT battle_id, player_id, 'deck_dim' FROM fct
WHERE deck_id IS NOT NULL AND deck_id NOT IN (SELECT deck_id FROM deck_dim)
UNION ALL
SELECT battle_id, player_id, 'date_dim' FROM fct
WHERE date_id IS NOT NULL AND date_id NOT IN (SELECT date_id FROM date_dim)""", [deck_dim_cte()])

SQL["flatten_struct"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k, user_id AS who_user_id,
       event_type AS who_what_event_type, round(value, 6) AS who_what_value
FROM events"""

SQL["response_routing"] = """
WITH r AS (
  SELECT CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS status,
         CASE WHEN event_type = 'click' AND value < 50 THEN '[]'
              WHEN event_type = 'purchase' AND value < 20 THEN ''
              ELSE props END AS body
  FROM events)
SELECT CASE WHEN status = 200 AND NOT (body IS NULL OR trim(body) IN ('', '[]', '{}', 'null')) THEN 'ok'
            WHEN status = 200 THEN 'empty' WHEN status = 404 THEN 'missing' ELSE 'error' END AS outcome,
       count(*) AS n
FROM r GROUP BY 1"""

SQL["request_urls"] = f"""
SELECT c_name AS tag, replace(c_name, '#', '%23') AS encoded_tag,
  '{API_BASE}/players/' || replace(c_name, '#', '%23') || '/battlelog' AS battlelog_url,
  '{API_BASE}/players/' || replace(c_name, '#', '%23') AS player_url
FROM customer"""

SQL["filename_date_range"] = """
WITH names AS (SELECT DISTINCT 'battles_' || strftime(o_orderdate, '%m%d%Y') || '_WL_tagged.csv' AS file_name
               FROM orders),
d AS (SELECT CAST(strptime(run, '%m%d%Y') AS DATE) AS d
      FROM (SELECT unnest(regexp_extract_all(file_name, '(\\d+)', 1)) AS run FROM names))
SELECT 'raw_battles_' || strftime(min(d), '%m%d%Y') || '_' || strftime(max(d), '%m%d%Y') AS table_name,
       strftime(min(d), '%Y-%m-%d') AS min_date, strftime(max(d), '%Y-%m-%d') AS max_date
FROM d"""

_LADDER = """ladder AS (
  SELECT CASE WHEN team_crowns >= opponent_crowns THEN team_tag ELSE opponent_tag END AS "winner.tag",
         CASE WHEN team_crowns >= opponent_crowns THEN opponent_tag ELSE team_tag END AS "loser.tag",
         battleTime
  FROM log)"""

SQL["dotted_columns"] = with_ctes(BASE, """
SELECT DISTINCT "winner.tag" AS player_tag FROM ladder
UNION
SELECT DISTINCT "loser.tag" AS player_tag FROM ladder""", [_LADDER])

SQL["parse_battle_log"] = with_ctes(BASE, log_out("log"))
SQL["parse_players"] = with_ctes(["player_stats"], "\nSELECT * FROM player_stats")
SQL["parse_clans"] = with_ctes(["clan_stats"], "\nSELECT * FROM clan_stats")
SQL["csv_to_parquet"] = with_ctes(BASE, '\nSELECT "winner.tag", "loser.tag", battleTime FROM ladder',
                                  [_LADDER])

_fct_cols = """battle_id, date_id, player_id, deck_id, clan_id, battle_type, is_ladder_tournament, arena_id,
  arena_name, game_mode_id, game_mode_name, deck_selection_method, is_hosted_match, league_number,
  starting_trophies, trophy_change, crowns_earned, king_tower_hit_points,
  to_json(princess_tower_hit_points) AS princess_tower_hit_points, to_json(cards) AS cards,
  to_json(support_cards) AS support_cards, global_rank, round(elixir_leaked, 6) AS elixir_leaked"""
_dedup_log = f"""log AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {_LOG_KEY} ORDER BY {_LOG_ORDER}) AS rn FROM log0)
  WHERE rn = 1)"""
_LOADED = [CTE["log"].replace("log AS (", "log0 AS (", 1), _dedup_log, CTE["sides"]]
_RAW = ["cards", "lines", "per_order"]
SQL["refresh_daily"] = with_ctes(_RAW, f"\nSELECT {_fct_cols} FROM fct", [*_LOADED, CTE["fct"]])
SQL["stream_ingest"] = with_ctes(_RAW, "\n" + log_out("log"), _LOADED)
SQL["refresh_deck_dim"] = with_ctes(_RAW, _deck_out, [*_LOADED, deck_dim_cte()])
for _name in ("player_dim", "date_dim", "card_dim", "clan_dim", "season_urls", "top_players_per_season"):
    SQL[f"refresh_{_name}"] = SQL[_name]

_TOP = SQL["top_players_per_season"].strip()
SQL["snapshot_roundtrip"] = with_ctes(
    BASE + ["fct", "date_dim", "card_dim", "player_stats", "clan_stats"], """
SELECT 'player_dim' AS table_name, count(*) AS n_rows FROM player_stats
UNION ALL SELECT 'deck_dim', count(*) FROM deck_dim
UNION ALL SELECT 'date_dim', count(*) FROM date_dim
UNION ALL SELECT 'fct_battle', count(*) FROM fct
UNION ALL SELECT 'clan_dim', count(*) FROM clan_stats
UNION ALL SELECT 'card_dim', count(*) FROM card_dim
UNION ALL SELECT 'raw.player_battle_log', count(*) FROM log
UNION ALL SELECT 'staging.stg_top_players_by_season', count(*) FROM top_players
UNION ALL SELECT 'staging.stg_seasons', count(DISTINCT strftime(o_orderdate, '%Y-%m')) FROM orders
UNION ALL SELECT 'staging.stg_cards', count(*) FROM cards
UNION ALL SELECT 'staging.stg_player_stats', count(*) FROM player_stats
UNION ALL SELECT 'staging.stg_clan_stats', count(*) FROM clan_stats""",
    [deck_dim_cte(), "top_players AS (" + _TOP.replace("\n", " ") + ")"])

_ARENAS = ", ".join([f"'Arena {i}'" for i in range(1, 24)] + ["'Legendary Arena'", "'Clan League'"])
SQL["arena_order"] = with_ctes(BASE, f"""
SELECT arena_name,
  CAST(CASE WHEN list_position([{_ARENAS}], arena_name) IS NULL THEN 26
            ELSE list_position([{_ARENAS}], arena_name) END AS INTEGER) AS arena_rank
FROM (SELECT DISTINCT arena_name FROM log WHERE arena_name IS NOT NULL)""")
SQL["season_order"] = """
SELECT id, CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS season_rank
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS id FROM orders)"""
SQL["first_side_fields"] = with_ctes(BASE, """
SELECT team_tag, team_clan_tag, team_clan_badgeId, team_crowns,
       opponent_tag, opponent_clan_tag, opponent_clan_badgeId, opponent_crowns
FROM log""")

# ---- landed files, keys, small projections -----------------------------------
SQL["snapshot_facts"] = SQL["fct_battle"]
SQL["snapshot_top_players"] = SQL["top_players_per_season"]
SQL["fct_battle_keys"] = with_ctes(BASE + ["fct"], """
SELECT battle_id, player_id, deck_id, clan_id FROM fct""")
SQL["exclude_star"] = "SELECT * EXCLUDE (p_retailprice), p_retailprice * 2 AS doubled FROM part"
SQL["literal_season"] = "SELECT *, '2022-10' AS season_id FROM part"
SQL["request_rankings"] = f"""
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS id,
  '{API_BASE}/locations/global/seasons/' || strftime(o_orderdate, '%Y-%m') || '/rankings/players/?limit=10' AS ranking_url
FROM orders"""
SQL["request_clans"] = with_ctes(BASE, f"""
SELECT DISTINCT tag, '{API_BASE}/clans/' || replace(tag, '#', '%23') AS clan_url
FROM (SELECT team_clan_tag AS tag FROM log UNION ALL SELECT opponent_clan_tag FROM log) WHERE tag IS NOT NULL""")
SQL["landed_seasons"] = f"""
WITH i AS (SELECT DISTINCT strftime(o_orderdate + INTERVAL 22 YEAR, '%Y-%m') AS id FROM orders)
SELECT id, '{API_BASE}/locations/global/' ||
  CASE WHEN id > '2022-09' THEN 'pathoflegend/' ELSE 'seasons/' END || id || '/rankings/players/' AS query_url
FROM i"""
_mirror = ("list_transform({0}, lambda c, i: {{'name': CASE WHEN i = 1 THEN 'Mirror' ELSE c.name END, 'level': c.level, "
           "'elixirCost': CASE WHEN i > 1 THEN c.elixirCost END}})")
_cols = []
for _c in LOG_COLS:
    _x = f'"{_c}"'
    if _c == "team_cards":
        _x = f"CASE WHEN leagueNumber = 4 THEN {_mirror.format('team_cards')} ELSE team_cards END"
    if _c.startswith("opponent_"):
        _x = f"CASE WHEN leagueNumber <> 2 THEN {_x} END"
    if _c.startswith("team_clan_"):
        _x = f"CASE WHEN leagueNumber <> 3 THEN {_x} END"
    _cols.append(f'{_x} AS "{_c}"')
SQL["landed_battles"] = with_ctes(BASE, log_out(f"(SELECT {', '.join(_cols)} FROM log)"))
SQL["landed_players"] = with_ctes(["player_stats"], """
SELECT p.*, CASE WHEN expLevel % 2 = 0 THEN 'member' END AS role,
  CASE WHEN expLevel % 3 = 0 THEN to_json({'name': 'Card ' || expLevel, 'id': CAST(26000000 + expLevel AS BIGINT)}) END
    AS currentFavoriteCard,
  CASE WHEN c_nationkey <> 0 THEN '#C' || c_nationkey END AS clanTag
FROM player_stats p JOIN customer ON c_name = tag""")
SQL["landed_ladder"] = with_ctes(BASE, """
, named AS (SELECT *, min(substr(battleTime, 1, 6)) OVER () AS a, max(substr(battleTime, 1, 6)) OVER () AS b FROM ladder)
SELECT "winner.tag", "loser.tag", 'x' || substr(battleTime, 5, 2) || '01' || substr(battleTime, 1, 4) || 'y_WL_tagged' AS source_file,
  'raw_battles_' || substr(a, 5, 2) || '01' || substr(a, 1, 4) || '_' || substr(b, 5, 2) || '01' || substr(b, 1, 4) AS table_name
FROM named""", [_LADDER])
SQL["copied_players"] = with_ctes(["player_stats"], """
SELECT * FROM player_stats UNION ALL SELECT * FROM player_stats""")
SQL["doubled_keys"] = with_ctes(["player_stats"], """
, keyed AS (SELECT CASE WHEN expLevel = 40 THEN NULL ELSE tag END AS tag, wins FROM player_stats)
SELECT tag, 'load 1' AS kept_first, 'load 2' AS kept_last, CAST(wins + 2 AS INTEGER) AS last_wins FROM keyed WHERE tag IS NOT NULL
UNION ALL
SELECT NULL, 'load 1', 'load 2', CAST(NULL AS INTEGER) FROM (SELECT 1 FROM keyed WHERE tag IS NULL LIMIT 1)""")

# ---- tables kept up to date load by load -------------------------------------
SQL["incremental_facts"] = SQL["refresh_daily"]
SQL["incremental_deck_dim"] = SQL["refresh_deck_dim"]
SQL["incremental_date_dim"] = SQL["date_dim"]
# the kept log ignores a battle whose key it has
SQL["deck_usage_rolling"] = with_ctes(_RAW, _TREND, [*_LOADED, CTE["fct"], deck_dim_cte(), daily(True)])
SQL["growing_upsert"] = SQL["upsert_stats"]
_of = {"newest": "battleTime >= '20010601'", "old": "battleTime < '20000101'", "late": "battleTime >= '19990101'"}
_keys = "SELECT DISTINCT team_tag, opponent_tag, battleTime FROM log WHERE "
_new = {"newest": _of["newest"], "old": _of["old"], "late": f"{_of['late']} AND NOT ({_of['newest']}) AND NOT ({_of['old']})"}
SQL["load_counters"] = with_ctes(BASE, ", counted AS (" + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS load_id, (SELECT count(*) FROM log WHERE {_of[k]}) AS fetched, (SELECT count(*) FROM ({_keys}{_new[k]})) AS inserted"
    for k in _of) + """)
SELECT load_id, 'fetched' AS outcome, fetched AS n FROM counted
UNION ALL SELECT load_id, 'inserted', inserted FROM counted
UNION ALL SELECT load_id, 'ignored', fetched - inserted FROM counted""")
SQL["gated_load"] = with_ctes(BASE + ["fct", "date_dim", "player_stats"], f"""
, loads AS (SELECT 'first' AS load_id, * FROM fct WHERE date_id < '20000101'
            UNION ALL SELECT 'second', * FROM fct WHERE date_id >= '19990101'),
judged AS (SELECT load_id, battle_id, player_id, [
    CASE WHEN battle_id IS NULL OR player_id IS NULL THEN 'null_key' END,
    CASE WHEN battle_id IS NOT NULL AND player_id IS NOT NULL AND row_number() OVER (
      PARTITION BY load_id, battle_id, player_id ORDER BY deck_id NULLS FIRST, to_json(cards) NULLS FIRST) > 1 THEN 'duplicate_key' END,
    CASE WHEN NOT coalesce(crowns_earned BETWEEN 0 AND 2, TRUE) THEN 'check:crowns' END,
    CASE WHEN player_id IS NOT NULL AND player_id NOT IN (SELECT {key('tag')} FROM player_stats) THEN 'orphan:player_dim' END,
    CASE WHEN deck_id IS NOT NULL AND deck_id NOT IN (SELECT deck_id FROM deck_dim) THEN 'orphan:deck_dim' END,
    CASE WHEN date_id IS NOT NULL AND date_id NOT IN (SELECT date_id FROM date_dim) THEN 'orphan:date_dim' END] AS rules FROM loads),
own AS (SELECT load_id, battle_id, player_id, list_filter(rules, lambda x: x IS NOT NULL) AS rules FROM judged),
fine AS (SELECT DISTINCT battle_id, player_id FROM own WHERE load_id = 'first' AND len(rules) = 0),
whole AS (SELECT o.load_id, o.battle_id, o.player_id, CASE WHEN f.battle_id IS NOT NULL AND o.load_id = 'second'
            THEN list_append(o.rules, 'stored_key') ELSE o.rules END AS rules
          FROM own o LEFT JOIN fine f ON f.battle_id = o.battle_id AND f.player_id = o.player_id)
SELECT load_id, battle_id, player_id, unnest(CASE WHEN len(rules) = 0 THEN [NULL] ELSE rules END)::VARCHAR AS rule FROM whole""",
                              [deck_dim_cte()])
SQL["landed_broken"] = with_ctes(["player_stats"], """
SELECT tag, CASE WHEN expLevel % 5 = 0 THEN 'malformed' WHEN expLevel % 7 = 0 THEN 'bad_field' ELSE 'landed' END AS outcome FROM player_stats
UNION ALL SELECT tag, 'mended' FROM player_stats WHERE expLevel % 5 <> 0 AND expLevel % 7 = 0
UNION ALL SELECT tag, 'left' FROM player_stats WHERE expLevel % 5 = 0""")
SQL["ladder_tags"] = SQL["dotted_columns"]
for _name in ("player_dim", "deck_dim", "date_dim", "clan_dim", "card_dim"):
    SQL[f"snapshot_{_name}"] = SQL[_name]
SQL["snapshot_seasons"], SQL["snapshot_log"] = SQL["season_urls"], with_ctes(BASE, log_out("log"))
SQL["snapshot_cards"] = with_ctes(["cards"], "\nSELECT * FROM cards")
SQL["snapshot_player_stats"], SQL["snapshot_clan_stats"] = SQL["parse_players"], SQL["parse_clans"]
SQL["kept_top_players"] = """
WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') AS season_id, o_custkey AS custkey, CAST(sum(floor(o_totalprice * 100)) AS BIGINT) AS score
           FROM orders GROUP BY ALL)
SELECT season_id, CAST(row_number() OVER (PARTITION BY season_id ORDER BY score DESC, custkey) AS INTEGER) AS rank, custkey, score
FROM s QUALIFY rank <= 10"""
SQL["reconciled_parquet"] = SQL["reconciled_csv"] = with_ctes(["player_stats"], """
SELECT tag, CAST(wins AS DOUBLE) AS wins, CAST(trophies AS VARCHAR) AS trophies, CAST(NULL AS VARCHAR) AS name
FROM player_stats WHERE expLevel % 3 = 0
UNION ALL SELECT tag, CAST(wins AS DOUBLE), CAST(trophies + 10000000000 AS VARCHAR), NULL FROM player_stats WHERE expLevel % 3 = 1
UNION ALL SELECT tag, wins + CAST(0.5 AS DOUBLE), 't' || trophies, name FROM player_stats WHERE expLevel % 3 = 2""")
_battle = "concat_ws('|', battleTime, team_tag, opponent_tag)"
SQL["battle_ids"] = with_ctes(BASE, ", landed AS (" + "\nUNION ALL\n".join(
    f"SELECT {i} AS n, '{k}' AS load, {_battle} AS battle FROM log WHERE {where}" for i, (k, where) in enumerate(_of.items())) + f"""),
first_seen AS (SELECT battle, min(n) AS n, arg_min(load, n) AS load FROM landed GROUP BY battle),
ids AS (SELECT battle, load, CAST(row_number() OVER (ORDER BY n, battle) - 1 AS BIGINT) AS id FROM first_seen)
SELECT i.battle, i.id, {key('i.battle')} AS hash, i.load FROM (SELECT {_battle} AS battle FROM log) l JOIN ids i USING (battle)""")
