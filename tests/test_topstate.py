import random
import uuid

from pyspark.sql import functions as F

from matchlake.sources import topstate as T

DDL = "grp STRING, member STRING, score BIGINT, at INT"


def test_loads_and_corrections_equal_the_full_ranking(spark, tmpdir_path):
    """Rising, falling and tied scores, members that come late, a group that uses up its spare members."""
    db = f"t{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    scores, state = f"{db}.scores", f"{db}.state"
    T.create_top(spark, scores, state, f"file://{tmpdir_path}", k=3, spare=2)
    r, want, again = random.Random(2), {}, 0
    for load in range(6):
        batch = [("ab"[i % 2], f"m{r.randrange(40)}", r.randrange(12)) for i in range(40 if load == 0 else 8)]
        if load == 3:       # the best of group a all fall
            best = sorted(((-s, m) for (g, m), s in want.items() if g == "a"))[:5]
            batch += [("a", m, 0) for _, m in best]
        if load == 4:
            batch = [("c", "only", 5), ("c", None, 9), (None, "x", 9), ("c", "y", None), ("a", "new", 99)]
        rows = [(*b, i) for i, b in enumerate(batch)]
        out = T.load_top(spark, scores, state, spark.createDataFrame(rows, DDL), [F.col("at")])
        again += out["ranked_again"]
        for g, m, s in batch:
            if None not in (g, m, s):
                want[g, m] = s
        ranked = []
        for g in {g for g, _ in want}:
            own = sorted((-s, m) for (h, m), s in want.items() if h == g)[:3]
            ranked += [(g, n + 1, m, -s) for n, (s, m) in enumerate(own)]
        got = sorted((x.grp, x["rank"], x.member, x.score) for x in T.top(spark, state).collect())
        assert got == sorted(ranked)
        assert max(n for (n,) in spark.table(state).groupBy("grp").count().select("count").collect()) <= 5
    assert 0 < again < 6            # only when the spare members were used up


def test_nothing_to_load(spark, tmpdir_path):
    db = f"t{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    T.create_top(spark, f"{db}.scores", f"{db}.state", f"file://{tmpdir_path}")
    assert T.load_top(spark, f"{db}.scores", f"{db}.state", spark.createDataFrame([], DDL), [F.col("at")]) == {"groups": 0, "ranked_again": 0}
    assert T.top(spark, f"{db}.state").collect() == []
