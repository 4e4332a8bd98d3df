import glob
import random
import uuid

import pytest
from pyspark.sql import functions as F

from matchlake import schemas as S
from matchlake.plans import incremental as I
from matchlake.plans import models as M
from matchlake.plans import refresh as RF
from matchlake.plans import reports as R
from matchlake.sources import published as P

AS_OF = "2024-02-10"
CATS = {"common_count": ("rarity", "Common"), "rare_count": ("rarity", "Rare"), "epic_count": ("rarity", "Epic"),
        "legendary_count": ("rarity", "Legendary"), "champion_count": ("rarity", "Champion"), "troop_count": ("type", "Troop"),
        "spell_count": ("type", "Spell"), "building_count": ("type", "Building")}


def battle(r, day, i, cards):
    def deck():
        return [(r.choice(cards), 1, r.choice([3, None, 4])) for _ in range(r.choice([0, 2, 8, 9]))] or None
    a, b = (f"#{r.randrange(40)}" if r.random() > 0.05 else None for _ in "ab")
    row = {f: None for f in S.names(S.PLAYER_BATTLE_LOG)}
    shared = [deck() for _ in "ab"]
    if r.random() < 0.3:
        shared = [shared[0]] * 2
    row.update(type="PvP", battleTime=f"{day}T{i % 24:02d}0000.000Z", gameMode_name="Ladder_x", team_tag=a, opponent_tag=b,
               deckSelection=r.choice(["collection", "predefined", None]), team_cards=shared[0], opponent_cards=shared[1],
               team_crowns=r.randrange(4), arena_name="Arena 1")
    return tuple(row.values())


def cards_of(spark, r, names):
    rows = [(n, n, n, 3, r.choice(["Troop", "Spell"]), r.choice(["Common", "Rare", "Epic"]), 1, "", 1, None, False) for n in names]
    return spark.createDataFrame(rows, S.STG_CARDS)


def days(r, n):
    return [f"{m}{d:02d}" for m in ("202311", "202312", "202401", "202402") for d in r.sample(range(1, 11), n)]


@pytest.fixture()
def store(spark, tmpdir_path):
    db = f"i{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    out = I.Store(f"{db}.log", f"{db}.fct", f"{db}.dates", f"{db}.decks")
    I.create(spark, out, f"file://{tmpdir_path}", CATS, deck_rows=30)
    out.root = tmpdir_path
    return out


def text(df):
    return sorted(map(str, df.collect()))


def check(spark, store, cards):
    """Every kept table equals its rebuild from the whole log."""
    log = spark.table(store.log).drop(I.MONTH)
    fct, decks, dates = M.fct_battle(log), M.deck_dim(log, cards, categories=CATS), M.date_dim(log)
    assert text(spark.table(store.facts).select(*fct.columns)) == text(fct)
    assert text(I.deck_dim(spark, store).select(*decks.columns)) == text(decks)
    assert text(I.date_dim(spark, store).select(*dates.columns)) == text(dates)
    daily = R.deck_usage_daily(fct, decks, dates, as_of=AS_OF)
    rolling = I.rolling_usage(spark, store, as_of=AS_OF).select(*daily.columns)
    assert text(rolling) == text(daily) and rolling.count() > 0


def test_five_random_loads_equal_the_rebuild(spark, store):
    r = random.Random(11)
    names = [f"card{i}" for i in range(12)]
    cards, stored, seen = cards_of(spark, r, names), [], 0
    for n in range(5):
        batch = [battle(r, d, i, names) for d in days(r, 2) for i in range(6)]
        batch += r.sample(stored, min(len(stored), 10)) + batch[:3]
        if n == 2:
            cards = cards_of(spark, r, names[3:])       # changed, and some gone
        if n == 4:
            cards = cards_of(spark, r, names)
        stored += batch
        df = spark.createDataFrame(batch, S.PLAYER_BATTLE_LOG)
        out = I.load(spark, store, df, RF.log_order(), cards, CATS, AS_OF, f"load{n}")
        assert out["fetched"] == len(batch) and out["inserted"] + out["ignored"] == len(batch)
        seen += out["inserted"]
        assert spark.table(store.log).count() == seen
        if n in (2, 4):
            again = I.load(spark, store, df, RF.log_order(), cards, CATS, AS_OF, f"load{n}")     # the same load once more
            assert again["inserted"] == 0
            check(spark, store, cards)


def test_a_changed_card_touches_its_decks_only(spark, store, monkeypatch):
    r = random.Random(5)
    names = [f"card{i}" for i in range(30)]
    cards = cards_of(spark, r, names)
    log = spark.createDataFrame([battle(r, d, i, names) for d in days(r, 3) for i in range(10)], S.PLAYER_BATTLE_LOG)
    I.load(spark, store, log, RF.log_order(), cards, CATS, AS_OF, "a")
    assert I.change_cards(spark, store, cards, CATS) == 0
    changed = cards.withColumn("rarity", F.when(F.col("name") == "card7", F.lit("Champion")).otherwise(F.col("rarity")))
    held = I.deck_dim(spark, store).where(F.array_contains("cards_list", "card7")).count()
    for f in glob.glob(f"{store.root}/**/log/**/*.parquet", recursive=True) + glob.glob(f"{store.root}/**/fct/**/*.parquet", recursive=True):
        open(f, "wb").write(b"not read")            # no battle and no fact is read
    assert I.change_cards(spark, store, changed, CATS) == held > 0
    assert text(I.deck_dim(spark, store)) == text(M.deck_dim(log, changed, categories=CATS).select(*I.deck_dim(spark, store).columns))


def scanned_rows(df, folder):
    """Rows that the plan's scans of ``folder`` gave, after it has run."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and folder in node.toString():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_day_reads_its_own_day(spark, store):
    """Stored battles of other days, and all facts and partials of other days, are left alone."""
    r = random.Random(8)
    names = [f"card{i}" for i in range(5)]
    all_days = ["20240101", "20240102", "20240103", "20240110", "20231205"]
    keyed = lambda d, n: [b for b in (battle(r, d, i, names) for i in range(n)) if b[10] and b[11]]
    for d in all_days:
        I.load(spark, store, spark.createDataFrame(keyed(d, 30), S.PLAYER_BATTLE_LOG), RF.log_order(), None, CATS, AS_OF, d)
    day = spark.createDataFrame(keyed("20240102", 20), S.PLAYER_BATTLE_LOG)
    read = I.stored_keys(spark, store, day)
    read.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "9999")
    plan = I.stored_keys(spark, store, day)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(battleTime" in plan and "LessThanOrEqual(battleTime" in plan
    whole = spark.table(store.log)
    of_day = whole.where("battleTime LIKE '20240102%'").count()
    assert 0 < scanned_rows(read, "/data") <= of_day < whole.count()
    before = [text(spark.table(store.usage).where("date_id <> '20240102'")), whole.count()]
    log_files = glob.glob(f"{store.root}/**/log/*/data/{I.MONTH}=202312/**/*.parquet", recursive=True)
    fct_files = glob.glob(f"{store.root}/**/fct/**/*.parquet", recursive=True)
    use_files = [f for f in glob.glob(f"{store.root}/**/*usage_days/**/*.parquet", recursive=True) if "date_id=20240102" not in f]
    assert log_files and fct_files and use_files
    kept = {f: open(f, "rb").read() for f in log_files + fct_files + use_files}
    for f in kept:
        open(f, "wb").write(b"not read")
    out = I.load(spark, store, day, RF.log_order(), None, CATS, AS_OF, "late")
    for f, data in kept.items():
        open(f, "wb").write(data)
    assert out["inserted"] > 0
    assert text(spark.table(store.usage).where("date_id <> '20240102'")) == before[0]
    check(spark, store, spark.createDataFrame([], S.STG_CARDS))


@pytest.mark.parametrize("at", [2, 7, 13])
def test_a_load_that_failed_is_repeated(spark, store, monkeypatch, at):
    r = random.Random(at)
    names = [f"card{i}" for i in range(6)]
    cards = cards_of(spark, r, names)
    first, second = ([battle(r, d, i, names) for d in days(r, 2) for i in range(5)] for _ in "ab")
    I.load(spark, store, spark.createDataFrame(first, S.PLAYER_BATTLE_LOG), RF.log_order(), cards, CATS, AS_OF, "first")
    steps = []

    def fail(step):
        steps.append(step)
        if len(steps) == at:
            raise RuntimeError(step)
    monkeypatch.setattr(P, "after", fail)
    df = spark.createDataFrame(second, S.PLAYER_BATTLE_LOG)
    with pytest.raises(RuntimeError):
        I.load(spark, store, df, RF.log_order(), cards, CATS, AS_OF, "second")
    monkeypatch.undo()
    I.load(spark, store, df, RF.log_order(), cards, CATS, AS_OF, "second")
    check(spark, store, cards)
