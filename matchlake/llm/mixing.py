"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target /
source size.  Its whole part is taken surely; the fractional parts are rounded
by pivotal duels: two fractional documents meet, and a random amount of mass
(probability x size) moves from one to the other until one of them is 0 or 1.
A duel keeps the words of the pair and each document's expectation, so a
source ends at its target up to one document.  Documents are spread over
bounded groups of a source; a group is one task's work and leaves at most one
fractional residual; the residuals of ``FAN_IN`` groups meet in the next level
of a reduction tree, down to one residual per source, which goes to the nearer
whole number.

Rows that repeat (all columns equal) are one unit: together they expect
``rows x fraction`` extra copies, of which the whole part is sure and the rest,
less than one copy of one row, takes part in the duels.  So a source ends within
one row of its target, however often a row repeats.

Edge cases: a null source is a source of its own, ordered last.  A null or
wordless text has size 0 and takes nothing.  Of rows that repeat, some may have
one copy more than others.  Null doc_ids are allowed.  The result depends only
on the rows and the seed, not on partitioning.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, n_words

GROUP_ROWS = 5_000    # documents of a source in one leaf task, about
FAN_IN = 256          # residuals that meet in one task of the next level
EPS = 1e-9

#: Rows or copies that one row is expanded into at once.
CHUNK = 10_000

DUEL = "src int, bucket long, doc_id long, row_hash long, size long, mult long, extra long, frac double, done boolean"


def source_targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, src, docs, source_size, target) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words by weight; a target stops at ``cap`` times its source's size and
    the rest is shared again.  All targets are ``min(cap x size, weight x
    level)``: the level rises until they add up to the total.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ordered = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda x: (x[0][0], int(x[1]), x[0][2], x[0][1], float(weights[x[1] % len(weights)])))
    ranked = cut(spark.createDataFrame(
        ordered, "source string, src int, docs long, source_size long, weight double"), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    cap_col = F.col("source_size") * F.lit(float(cap))
    while total:
        over = F.col("weight") * F.lit(level) >= cap_col
        n, held, free = ranked.agg(F.count_if(over), F.sum(F.when(over, cap_col)),
                                   F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not free:
            break
        full, level = n, (total - (held or 0.0)) / free
    return ranked.withColumn("target", F.least(cap_col, F.col("weight") * F.lit(level)))


def _draws(seed: int, level: int, src: int, bucket: int, n: int) -> np.ndarray:
    key = hashlib.sha256(f"{seed}/{level}/{src}/{bucket}".encode()).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(key[:16], "little"))).random(n)


def _duel(weight: list[float], prob: list[float], draws) -> int | None:
    """Round ``prob`` in place; the index of the one still fractional, if any."""
    held = None
    for i in range(len(prob)):
        if not EPS < prob[i] < 1 - EPS:
            prob[i] = round(prob[i])
            continue
        if held is None:
            held = i
            continue
        a, b = held, i
        up = min((1 - prob[a]) * weight[a], prob[b] * weight[b])      # from b to a
        down = min(prob[a] * weight[a], (1 - prob[b]) * weight[b])    # from a to b
        move = up if draws[i] * (up + down) < down else -down
        prob[a] += move / weight[a]
        prob[b] -= move / weight[b]
        held = None
        for k in (a, b):
            if EPS < prob[k] < 1 - EPS:
                held = k
            else:
                prob[k] = round(prob[k])
    return held


def _round_group(seed: int, level: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        src, bucket = key[0].as_py(), key[1].as_py()
        # large documents first: what stays fractional is met by ever smaller ones
        rows = rows.sort_by([("size", "descending"), ("doc_id", "ascending"), ("row_hash", "ascending")])
        weight = [float(s) for s in rows["size"].to_pylist()]
        prob = rows["frac"].to_pylist()
        held = _duel(weight, prob, _draws(seed, level, src, bucket, len(prob)))
        if held is not None and last:
            prob[held], held = float(prob[held] >= 0.5), None
        frac = np.array(prob, np.float64)
        done = np.ones(len(prob), bool)
        extra = rows["extra"].to_numpy().astype(np.int64)
        if held is not None:
            done[held] = False
        extra[done] += frac[done].astype(np.int64)
        frac[done] = 0.0
        return pa.table({"src": rows["src"], "bucket": pa.array(np.full(len(prob), bucket // FAN_IN), pa.int64()),
                         **{c: rows[c] for c in ("doc_id", "row_hash", "size", "mult")},
                         "extra": pa.array(extra), "frac": pa.array(frac), "done": pa.array(done)})
    return run


def copies(sizes: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """(src, source, source_size, target, doc_id, row_hash, size, mult, whole, extra) for each
    distinct row (doc_id, source, size, row_hash): ``mult`` rows have ``whole``
    copies each, and ``extra`` of them one more."""
    groups = F.ceil(F.col("docs") / F.lit(GROUP_ROWS))
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))     # a source may have no words
    rates = targets.select(F.col("source").alias("of"), "src", groups.alias("groups"), rate.alias("rate"))
    share = F.col("mult") * (F.col("rate") - F.floor("rate"))
    units = sizes.groupBy("doc_id", "source", "size", "row_hash").agg(F.count("*").alias("mult")) \
                 .join(rates, F.expr("source <=> of"))
    docs = units.where("size > 0").select(
        "src", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "row_hash"), "groups").alias("bucket"),
        "doc_id", "row_hash", "size", "mult", F.floor(share).alias("extra"), (share - F.floor(share)).alias("frac"),
        F.lit(False).alias("done"))
    most = targets.agg(F.max("docs")).first()[0] or 0
    width, level = math.ceil(most / GROUP_ROWS), 0
    settled = units.where("size = 0").select("src", "doc_id", "row_hash", "size", "mult", F.lit(0).cast("long").alias("extra"))
    while True:
        rounded = cut(docs.groupBy("src", "bucket").applyInArrow(
            _round_group(seed, level, width <= 1), DUEL), f"mix-level{level}")
        settled = settled.unionByName(rounded.where("done").select(*settled.columns))
        if width <= 1:
            break
        docs, width, level = rounded.where("NOT done"), math.ceil(width / FAN_IN), level + 1
    of = targets.select("src", "source", "source_size", "target", F.floor(rate).cast("long").alias("whole"))
    return settled.join(of, "src").withColumn("whole", F.when(F.col("size") > 0, F.col("whole")).otherwise(0))


def _times(rows: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` times, numbered from 0 as ``nth``.  A row that is wanted very
    often is dealt out first, so that no task writes all its copies."""
    few = rows.where(F.col(n).between(1, CHUNK)).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    many = rows.where(F.col(n) > CHUNK).withColumn("__part", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(n) - 1) / F.lit(CHUNK))))).hint("rebalance")
    at = F.col("__part") * CHUNK
    return few.unionByName(many.withColumn("nth", F.explode(F.sequence(at, F.least(at + CHUNK, F.col(n)) - 1))).drop("__part"))


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"), _row_hash(docs))


def _row_hash(docs: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_hash")


def mix_plan(docs: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = cut(_sizes(docs), "mix-sizes")
    targets = cut(source_targets(sizes, cap, weights), "mix-targets")
    rows = _times(copies(sizes, targets, seed), "mult")
    n = F.col("whole") + (F.col("nth") < F.col("extra")).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).alias("taken"))


def mix(docs: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7) -> DataFrame:
    """The mixed documents themselves: each row as often as it is taken, with
    the columns of ``docs``."""
    sizes = cut(_sizes(docs), "mix-sizes")
    targets = cut(source_targets(sizes, cap, weights), "mix-targets")
    total = F.col("mult") * F.col("whole") + F.col("extra")
    plan = cut(copies(sizes, targets, seed).select(
        F.col("row_hash").alias("k"), F.col("doc_id").alias("k_id"), F.col("source").alias("k_src"), F.col("size").alias("k_size"),
        "mult", total.alias("n")).where("n > 0"), "mix-plan")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_hash(docs).alias("row_hash"))
    # the hash alone could join different rows; id, source and size settle that
    out = rows.join(plan, F.expr("row_hash = k AND row.doc_id <=> k_id AND row.source <=> k_src"))
    out = out.where(n_words(F.col("row.text")) == F.col("k_size"))
    kept = out.where("mult = 1").select("row", "n")
    if plan.where("mult > 1").head(1):      # rows that repeat are equal: one of them stands for all
        kept = kept.unionAll(out.where("mult > 1").groupBy("k", "k_id", "k_src", "k_size").agg(
            F.any_value("row").alias("row"), F.first("n").alias("n")).select("row", "n"))
    return _times(kept, "n").select("row.*")
