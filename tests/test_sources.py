import json
import os

from matchlake.plans import parse as P
from matchlake.sources import files as FS
from matchlake.sources import json as JS
from matchlake.streaming import stream_insert_ignore
from matchlake import schemas as S


def write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))


def battle(t, team="#A", opp="#B", cards=None):
    side = lambda tag: [{"tag": tag, "name": tag, "cards": cards or [
        {"name": "Mirror", "level": 1, "elixirCost": 4, "id": 1}], "clan": {"tag": "#C"}}]
    return {"type": "PvP", "battleTime": t, "arena": {"id": 1, "name": "Arena 1"},
            "team": side(team), "opponent": side(opp)}


def test_json_envelopes_and_parse(spark, tmpdir_path):
    write(f"{tmpdir_path}/s/seasons.json", {"items": [{"id": "2022-09"}, {"id": "2022-10"}]})
    assert sorted(r.id for r in JS.read_items(spark, f"{tmpdir_path}/s", "id STRING").collect()) == \
        ["2022-09", "2022-10"]
    write(f"{tmpdir_path}/b/log.json", [battle("20231202T101010.000Z"),
                                        {**battle("20231203T101010.000Z"), "team": []}])
    rows = P.parse_battle_log(JS.read_array(spark, f"{tmpdir_path}/b", P.BATTLE)).collect()
    assert len(rows) == 2
    full = [r for r in rows if r.team_tag][0]
    assert full.team_cards[0].elixirCost is None          # Mirror
    assert full.team_clan_tag == "#C" and full.arena_id == 1
    empty = [r for r in rows if not r.team_tag][0]
    assert empty.team_cards is None and empty.opponent_tag == "#B"
    write(f"{tmpdir_path}/c/clan.json", {"tag": "#C", "name": "c", "members": 3})
    c = P.parse_clan(JS.read_object(spark, f"{tmpdir_path}/c", P.CLAN)).first()
    assert c.members == 3 and c.location_id is None


def test_response_routing(spark):
    df = spark.createDataFrame([("a", 200, '{"x":1}'), ("b", 200, "[]"), ("c", 404, None),
                                ("d", 500, "oops"), ("e", 200, None)], "key string, status int, body string")
    got = {r.outcome: r.n for r in JS.outcome_counts(JS.route_responses(df)).collect()}
    assert got == {"ok": 1, "empty": 2, "missing": 1, "error": 1}


def test_csv_suffix_and_date_range(spark, tmpdir_path):
    write(f"{tmpdir_path}/x12272020y_WL_tagged.csv", "winner.tag,loser.tag\n#A,#B\n")
    write(f"{tmpdir_path}/x01042021y_WL_tagged.csv", "winner.tag,loser.tag\n#C,#A\n")
    write(f"{tmpdir_path}/other.csv", "winner.tag,loser.tag\n#Z,#Z\n")
    df = FS.read_ladder_csv(spark, tmpdir_path)
    assert df.count() == 2
    label = FS.date_range_label(FS.source_file_names(df)).first()
    assert label.table_name == "raw_battles_12272020_01042021"


def rec(t, team, v, opponent="#O"):
    r = {f: None for f in S.names(S.PLAYER_BATTLE_LOG)}
    r.update({"battleTime": t, "team_tag": team, "opponent_tag": opponent, "type": v})
    return json.dumps(r)


def test_stream_ingest_is_idempotent(spark, tmpdir_path):
    land = f"{tmpdir_path}/landing"
    write(f"{land}/a.json", "\n".join([rec("20231202T101010.000Z", "#A", "1"),
                                       rec("20231202T101010.000Z", "#A", "dup"),
                                       rec("20231203T101010.000Z", "#B", "1")]))
    tgt, ck = f"{tmpdir_path}/table", f"{tmpdir_path}/ck"
    stream_insert_ignore(spark, land, tgt, ck)
    write(f"{land}/b.json", rec("20231202T101010.000Z", "#A", "late"))   # already stored key
    write(f"{land}/c.json", rec("20200102T101010.000Z", "#C", "old"))    # a late battle is stored
    stream_insert_ignore(spark, land, tgt, ck)
    out = spark.read.parquet(tgt)
    assert out.count() == 3
    assert out.select("team_tag", "opponent_tag", "battleTime").distinct().count() == 3


def test_stream_replay_and_null_keys(spark, tmpdir_path):
    land, tgt = f"{tmpdir_path}/landing", f"{tmpdir_path}/table"
    write(f"{land}/a.json", "\n".join([rec("20231202T101010.000Z", "#A", "1"), rec("20231202T101010.000Z", "#A", "1", None)]))
    for k in range(2):          # another checkpoint: the same file is delivered again
        stream_insert_ignore(spark, land, tgt, f"{tmpdir_path}/ck{k}")
    got = spark.read.parquet(tgt)
    assert got.where("opponent_tag IS NOT NULL").count() == 1
    assert got.where("opponent_tag IS NULL").count() == 2       # NULL keys never match


def test_stream_first_file_wins_and_errors_are_not_swallowed(spark, tmpdir_path):
    import pytest
    land, tgt = f"{tmpdir_path}/landing", f"{tmpdir_path}/table"
    write(f"{land}/a.json", rec("20231202T101010.000Z", "#A", "first"))
    write(f"{land}/b.json", rec("20231202T101010.000Z", "#A", "second"))
    stream_insert_ignore(spark, land, tgt, f"{tmpdir_path}/ck")
    assert [r.type for r in spark.read.parquet(tgt).collect()] == ["first"]
    with pytest.raises(Exception):
        stream_insert_ignore(spark, land, "nofs://x/table", f"{tmpdir_path}/ck2")


def test_ladder_table_named_by_date_range(spark, tmpdir_path):
    from matchlake.sources.catalog import ladder_table, sql_over
    src = f"{tmpdir_path}/dumps"
    os.makedirs(src)
    for d, tag in [("12272020", "#A"), ("01042021", "#B")]:
        spark.createDataFrame([(tag, "#Z")], "`winner.tag` string, `loser.tag` string") \
             .toPandas().to_parquet(f"{src}/x{d}y_WL_tagged.parquet")
    name = ladder_table(spark, src, f"{tmpdir_path}/wh")
    assert name == "raw.raw_battles_12272020_01042021"
    df = spark.table(name)
    assert sql_over(spark, "SELECT count(*) AS n FROM {t}", t=df).first().n == 2
