"""The best ``k`` of each group, kept up to date under corrections.

Two tables: every member's last score, in growing key buckets, and a small state
per group: its best ``k`` members and some spare ones, with the *cut-off*, the best
(score, member) that is left out.  A load touches the state of its own groups
only.  A member that beats the cut-off comes in; one whose score falls below it
goes out.  While at least ``k`` members beat the cut-off, the best ``k`` are among
them, whatever the others are; when corrections have used up the spare ones, the
group is ranked again from its scores -- that group alone.

Order: score falling, then member; a NULL member or score takes no part.  Within a
load the last row of a member in load order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.topk import top_k_per_group
from ..operators.writes import dedupe_batch
from ..session import shared_dir
from . import buckets as B
from . import published as P

K, SPARE = 10, 20
STATE = "member STRING, score BIGINT, cut_score BIGINT, cut_member STRING, grp STRING"


def create_top(spark: SparkSession, scores: str, state: str, root: str, k: int = K, spare: int = SPARE) -> None:
    B.create_growing(spark, scores, "grp STRING, member STRING, score BIGINT", f"{root}/scores")
    P.create_published(spark, state, STATE, "grp", f"{root}/state", k=k, spare=spare)


def _beats(score: Column, member: Column) -> Column:
    """Whether (score, member) comes before the cut-off; without one all do."""
    return F.col("cut_score").isNull() | (score > F.col("cut_score")) | ((score == F.col("cut_score")) & (member < F.col("cut_member")))


def _cut(rows: DataFrame, most: int) -> DataFrame:
    """The best ``most`` rows of each group; the cut-off is the best row left out,
    else what it was (rows that beat a cut-off and are left out beat it still)."""
    ranked = top_k_per_group(rows, ["grp"], [F.desc("score"), F.asc("member")], most + 1, "n")
    out = F.max(F.when(F.col("n") == most + 1, F.struct("score", "member"))).over(Window.partitionBy("grp"))
    return ranked.withColumn("out", out).where(F.col("n") <= most).select(
        "member", "score", F.coalesce("out.score", "cut_score").alias("cut_score"),
        F.coalesce("out.member", "cut_member").alias("cut_member"), "grp")


def load_top(spark: SparkSession, scores: str, state: str, batch: DataFrame, order: list[Column]) -> dict[str, int]:
    """A load of (grp, member, score); returns how many groups it touched and ranked again."""
    props = P.properties(spark, state)
    k, spare = int(props["k"]), int(props["spare"])
    folder = shared_dir(spark, "top", "batch")
    dedupe_batch(batch.where("grp IS NOT NULL AND member IS NOT NULL AND score IS NOT NULL"), ["grp", "member"], order,
                   keep="last").select("grp", "member", F.col("score").cast("long").alias("score")).write.parquet(folder)
    new = spark.read.schema("grp STRING, member STRING, score BIGINT").parquet(folder)
    B.upsert_growing(spark, scores, new, ["grp", "member"], [F.col("score")])
    touched = [r[0] for r in new.select("grp").distinct().collect()]
    if not touched:
        return {"groups": 0, "ranked_again": 0}
    before = spark.table(state).where(F.col("grp").isin(touched))
    cuts = before.groupBy("grp").agg(F.max("cut_score").alias("cut_score"), F.max("cut_member").alias("cut_member"))
    stay = before.join(new, ["grp", "member"], "left_anti")
    come = new.join(cuts, "grp", "left")
    fine = stay.unionByName(come).where(_beats(F.col("score"), F.col("member")))
    folder = shared_dir(spark, "top", "state")
    _cut(fine, k + spare).write.parquet(folder)
    merged = spark.read.schema(STATE).parquet(folder)
    # members are known to be missing from a state with a cut-off: it needs k that beat it
    enough = merged.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    again = [r[0] for r in cuts.where("cut_score IS NOT NULL").join(enough, "grp", "left_anti").select("grp").collect()]
    result = merged
    if again:
        whole = spark.table(scores).where(F.col("grp").isin(again)).select(
            "grp", "member", "score", F.lit(None).cast("long").alias("cut_score"), F.lit(None).cast("string").alias("cut_member"))
        result = merged.where(~F.col("grp").isin(again)).unionByName(_cut(whole, k + spare))
    P.replace_parts(spark, state, result.hint("rebalance", "grp"), touched)
    return {"groups": len(touched), "ranked_again": len(again)}


def top(spark: SparkSession, state: str) -> DataFrame:
    """grp, rank, member, score: the best ``k`` of each group."""
    k = int(P.properties(spark, state)["k"])
    return top_k_per_group(spark.table(state).select("grp", "member", "score"), ["grp"],
                           [F.desc("score"), F.asc("member")], k, "rank")
