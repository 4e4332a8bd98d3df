"""Rows apart whose key comes more than once, without a shuffle of whole rows.

To make rows distinct, or to keep one of each key, only rows that share a key
with another need to meet.  Their keys are found on hashes alone; where they are
few, they go to every task and all other rows pass as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

#: Hashes that are sent to every task at most (16 MB, about).
BROADCAST_KEYS = 1_000_000


def split_repeats(df: DataFrame, key: Column, alone: Column | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows that are the only one with their key, rows that may not be).

    Either is None if it has no rows; the first one also where the repeated keys
    are too many to send to every task.  ``key`` is a hash: rows of different keys
    may share it, and are then in the second frame.  Rows for which ``alone`` is
    not true are there too.  ``df`` is read up to three times, once now for its
    keys: it should be stored.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "repeats")
    hashes = df.select(key.alias("__h"))
    hashes.groupBy("__h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__h").write.parquet(folder)
    found = spark.read.schema("__h LONG").parquet(folder)
    n = found.count()
    if n > BROADCAST_KEYS:
        return None, df
    if n == 0 and alone is None:
        return df, None
    alone = F.coalesce(alone, F.lit(False)) if alone is not None else F.lit(True)
    again = F.broadcast(found.withColumn("__again", F.lit(True)))
    marked = df.withColumn("__h", key).join(again, "__h", "left")
    once = F.col("__again").isNull() & alone
    return tuple(marked.where(c).select(*[F.col(f"`{c}`") for c in df.columns]) for c in (once, ~once))
