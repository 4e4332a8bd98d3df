"""Dense ids of natural keys, kept in a published table.

A hash of 60 bits can give two keys one number.  The dictionary numbers the
keys themselves: a load's unseen keys take the next ids in key order, by ranges
sorted across the cluster, the counts of the ranges and their running sums; no
window runs over the keys.  Ids never change, have no gaps, and follow from the
order of the loads and the keys alone, so a repeated job gives them again.

A load is published in one step, with the next free id among the table's
properties; a load that is repeated under its name does nothing.  Null keys have
no id.  Finding unseen keys reads the key and hash columns of the dictionary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..session import shared_dir
from . import published as P

DICTIONARY = "natural STRING, hash BIGINT, id BIGINT, load STRING"
_ROW_BITS = 33      # fixed value: monotonically_increasing_id has the row in its low 33 bits


def create_dictionary(spark: SparkSession, name: str, root: str) -> None:
    P.create_published(spark, name, DICTIONARY, "load", root, next_id=0)


def extend(spark: SparkSession, name: str, keys: Column, rows: DataFrame, load: str,
           hashed: Callable[[str], Column] = md5_key) -> int:
    """Give an id to every key of ``rows`` that has none; returns how many there were."""
    if any(part == load for part, _ in P.parts(spark, name)):
        return 0
    base = int(P.properties(spark, name)["next_id"])
    fresh = rows.select(keys.cast("string").alias("natural")).where("natural IS NOT NULL").distinct() \
        .withColumn("hash", hashed("natural")) \
        .join(spark.table(name).select("natural", "hash"), ["natural", "hash"], "left_anti")
    path = shared_dir(spark, "keydict")
    fresh.repartitionByRange("natural").sortWithinPartitions("natural") \
        .withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    fresh = spark.read.schema("natural STRING, hash BIGINT, at BIGINT").parquet(path) \
        .withColumn("range", F.shiftright("at", _ROW_BITS))
    sizes = fresh.groupBy("range").agg(F.count(F.lit(1)).alias("n"))        # one row for each written range
    n = sizes.agg(F.sum("n")).first()[0] or 0
    starts = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("start"))
    ids = fresh.join(starts, "range").select(
        "natural", "hash", (F.lit(base) + F.col("start") + F.col("at").bitwiseAND((1 << _ROW_BITS) - 1)).alias("id"),
        F.lit(load).alias("load"))
    P.append(spark, name, ids, next_id=base + n)
    return n


def with_ids(rows: DataFrame, keys: Column, dictionary: DataFrame, id_name: str) -> DataFrame:
    """``rows`` with the id of each key; null for a null or unknown key."""
    known = dictionary.select(F.col("natural").alias("__key"), F.col("id").alias(id_name))
    return rows.withColumn("__key", keys.cast("string")).join(known, "__key", "left").drop("__key")


def collisions(dictionary: DataFrame) -> DataFrame:
    """Hashes that stand for several keys: ``hash, n, first_key, last_key``."""
    return dictionary.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("natural").alias("first_key"),
                                          F.max("natural").alias("last_key")).where("n > 1")
