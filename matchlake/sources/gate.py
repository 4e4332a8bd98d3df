"""Write, audit, publish: a load passes its rules before readers see it.

The batch is written down first and judged there: its keys among themselves and
against the stored keys of the parts it falls into, its checks, its references.
Rows that break a rule go to a quarantine table with the rule and the load's id
(one row per rule), the others are published.  The quarantine's part of a load is
replaced when the load is repeated, and a target that has the load already is
left alone, so a load that failed half way can be repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.repeats import BROADCAST_KEYS, split_repeats
from ..session import CODEC, shared_dir
from . import published as P

LOAD = "last_load"
QUARANTINE = "rule STRING, row STRING, load_id STRING"


def create_quarantine(spark: SparkSession, name: str, root: str) -> None:
    P.create_published(spark, name, QUARANTINE, "load_id", root)


def judged(spark: SparkSession, stored: DataFrame, batch: DataFrame, keys: list[str], order: list[Column],
           checks: dict[str, Column], references: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """``batch`` with ``__broken``, the rules that each row breaks:

    ``null_key``; ``duplicate_key``: not the first of its key in load order;
    ``stored_key``: its key is in ``stored``; ``check:NAME``: the condition is
    false (NULL passes, as in SQL); ``orphan:NAME``: the reference is not NULL and
    not there.  ``references`` maps a name to (frame, column of the batch, column
    of the frame).
    """
    folder = shared_dir(spark, "gate", "batch")
    # numbered once, in files, so that the numbers stay what they are
    batch.withColumn("__row", F.monotonically_increasing_id()).write.parquet(folder, compression=CODEC)
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in batch.schema.fields)}, __row LONG").parquet(folder)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(f"`{k}`").isNull()
    # what needs other rows is judged on keys alone, and comes back for the rows that break a rule
    far = []
    keyed = rows.where(~null_key)
    _, rest = split_repeats(keyed, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))
    if rest is not None:
        # partial aggregation: a key with very many rows does not gather in a task
        first = rest.groupBy(*keys).agg(F.min_by("__row", F.struct(*order, "__row")).alias("__row")).select("__row")
        far.append(rest.select("__row").join(first, "__row", "left_anti").withColumn("rule", F.lit("duplicate_key")))
    known = stored.select(*keys).where(~null_key)
    far.append(keyed.select("__row", *keys).join(known, keys, "left_semi").select("__row", F.lit("stored_key").alias("rule")))
    for i, (name, (dim, own, other)) in enumerate(references.items()):
        there = dim.select(F.col(other).alias(f"__k{i}")).where(f"__k{i} IS NOT NULL").distinct()
        far.append(rows.select("__row", F.col(own).alias("__own")).where("__own IS NOT NULL").join(
            there, F.col("__own") == F.col(f"__k{i}"), "left_anti").select("__row", F.lit(f"orphan:{name}").alias("rule")))
    found = reduce(DataFrame.unionByName, far).groupBy("__row").agg(F.collect_set("rule").alias("__far"))
    folder = shared_dir(spark, "gate", "broken")
    found.write.parquet(folder)
    found = spark.read.schema("__row LONG, __far ARRAY<STRING>").parquet(folder)
    if found.count() <= BROADCAST_KEYS:
        found = F.broadcast(found)
    out = rows.join(found, "__row", "left")

    def is_far(rule: str) -> Column:
        return F.when(F.array_contains("__far", rule), F.lit(rule))
    broken = [F.when(null_key, F.lit("null_key")), is_far("duplicate_key"), is_far("stored_key")]
    broken += [F.when(~F.coalesce(c, F.lit(True)), F.lit(f"check:{name}")) for name, c in checks.items()]
    broken += [is_far(f"orphan:{name}") for name in references]
    return out.select(*[F.col(f"`{c}`") for c in batch.columns],
                      F.filter(F.array(*broken), lambda x: x.isNotNull()).alias("__broken"))


def gated_load(spark: SparkSession, target: str, quarantine: str, batch: DataFrame, keys: list[str], order: list[Column],
               checks: dict[str, Column], references: dict[str, tuple[DataFrame, str, str]], load_id: str) -> dict[str, int]:
    """Returns the counts of rows fetched, published and quarantined (zeros if the
    target has the load already)."""
    props = P.properties(spark, target)
    if props.get(LOAD) == load_id:
        return {"fetched": 0, "published": 0, "quarantined": 0}
    part = props["part"]
    # the stored keys of the parts between the batch's least and greatest
    span = batch.agg(F.min(part).alias("a"), F.max(part).alias("b")).first()
    table = spark.table(target)
    stored = table.where(F.col(part).between(span.a, span.b) if span.a is not None else F.lit(False))
    folder = shared_dir(spark, "gate", "judged")
    seen = Observation()
    rows = judged(spark, stored, batch, keys, order, checks, references)
    rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.size("__broken") > 0).alias("bad")).write.parquet(folder, compression=CODEC)
    rows = spark.read.schema(rows.schema).parquet(folder)
    bad = rows.where(F.size("__broken") > 0).select(
        F.explode("__broken").alias("rule"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])).alias("row"), F.lit(load_id).alias("load_id"))
    P.replace_parts(spark, quarantine, bad, [load_id])
    good = rows.where(F.size("__broken") == 0).drop("__broken")
    P.append(spark, target, good.hint("rebalance", part), **{LOAD: load_id})
    n, n_bad = seen.get["n"], seen.get["bad"]
    return {"fetched": n, "published": n - n_bad, "quarantined": n_bad}
