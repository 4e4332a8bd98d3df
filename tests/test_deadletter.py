import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from matchlake.sources import deadletter as D

SCHEMA = "tag STRING, wins INT, clan STRUCT<tag: STRING>"


@pytest.fixture()
def dead(spark, tmpdir_path):
    db = f"d{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    D.create_dead_letters(spark, f"{db}.dead", f"file://{tmpdir_path}/dead")
    return f"{db}.dead"


GOOD = [{"tag": "a", "wins": 1, "clan": {"tag": "c"}}, {"tag": "b"}, {"wins": 2, "extra": [1]}]
BROKEN = {'{"tag": "x", "wins": ': "malformed", '{"tag": "y", "wins": "many"}': "bad_field", "not json": "malformed",
          '{"tag": "z", "clan": 5}': "bad_field"}


def test_lines_none_lost_none_null(spark, dead, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/in")
    with open(f"{tmpdir_path}/in/one.json", "w") as f:
        f.write("\n".join([*map(json.dumps, GOOD), *BROKEN]) + "\n")
    for _ in range(2):                      # a repeated load has its letters once
        good = D.land(spark, f"{tmpdir_path}/in", SCHEMA, dead, "l1")
        assert sorted(map(str, ((r.tag, r.wins) for r in good.collect()))) == sorted(map(str, [("a", 1), ("b", None), (None, 2)]))
        letters = spark.table(dead).collect()
        assert {r.text: r.reason for r in letters} == BROKEN and len(letters) == len(BROKEN)
        assert all(r.file.endswith("one.json") and r.load_id == "l1" for r in letters)


def test_whole_files(spark, dead, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/in")
    texts = {"good.json": json.dumps(GOOD), "cut.json": json.dumps(GOOD)[:40]}
    for name, text in texts.items():
        open(f"{tmpdir_path}/in/{name}", "w").write(text)
    assert D.land(spark, f"{tmpdir_path}/in", SCHEMA, dead, "l", multi_line=True).count() >= 3
    letters = spark.table(dead).collect()
    assert [(r.reason, r.text, r.file.rpartition("/")[2]) for r in letters] == [("malformed", texts["cut.json"], "cut.json")]


def test_responses(spark, dead):
    rows = [("k1", 200, '{"tag": "a", "wins": 3}'), ("k2", 404, "nothing"), ("k3", 500, None), ("k4", 200, "{}"), ("k5", 200, None),
            ("k6", 200, '{"tag": '), ("k7", 200, '{"tag": "b", "wins": []}'), ("k8", 503, '{"tag": "c"}')]
    good = D.land_responses(spark, spark.createDataFrame(rows, "key string, status int, body string"), SCHEMA, dead, "r")
    assert [tuple(r)[:3] for r in good.collect()] == [("k1", "a", 3)] and good.columns == ["source_file", "tag", "wins", "clan"]
    assert {r.file: (r.reason, r.text) for r in spark.table(dead).collect()} == {
        "k2": ("not_found", "nothing"), "k3": ("failed", ""), "k4": ("empty", "{}"), "k5": ("empty", ""),
        "k6": ("malformed", '{"tag": '), "k7": ("bad_field", '{"tag": "b", "wins": []}'), "k8": ("failed", '{"tag": "c"}')}


def test_replay(spark, dead, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/in")
    open(f"{tmpdir_path}/in/one.json", "w").write("\n".join(BROKEN))
    D.land(spark, f"{tmpdir_path}/in", SCHEMA, dead, "l1")
    mended = F.replace(F.col("text"), F.lit('"many"'), F.lit("7"))
    back = D.replay(spark, dead, "l1", SCHEMA, mended)
    assert [(r.tag, r.wins) for r in back.collect()] == [("y", 7)]
    left = {t: r for t, r in BROKEN.items() if "many" not in t}
    assert {r.text: r.reason for r in spark.table(dead).collect()} == left
    assert D.replay(spark, dead, "l1", SCHEMA.replace("STRUCT<tag: STRING>", "INT")).count() == 1
    assert spark.table(dead).count() == 2
