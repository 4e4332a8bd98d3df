"""Upserts into tables whose key buckets grow with them (K6, K7).

Linear hashing: a table of ``n`` buckets addresses a key by the low bits of its
hash; growing from ``n`` to ``n + 1`` splits one bucket and moves no other key.
The number of buckets follows the number of rows (``BUCKET_ROWS`` to a bucket,
at most about twice as many in one that is due to split), so the rows that a
batch rewrites are bounded by its own size, and the writers grow with the table.

A load reads and writes again only the buckets that hold a key of the batch and
those it splits, and publishes them in one step.  The lists of touched buckets
come to the driver: numbers below the number of buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.writes import dedupe_batch, upsert
from . import published as P

BUCKET = "key_bucket"
#: Rows of a bucket, about.
BUCKET_ROWS = 500_000


def address(number: int, buckets: int) -> int:
    """The bucket of hash ``number`` among ``buckets``."""
    low = 1 << (buckets.bit_length() - 1)           # the greatest power of two that is not above
    at = number % (2 * low)
    return at if at < buckets else at - low


def bucket_of(keys: list[str], buckets: int) -> Column:
    low = 1 << (buckets.bit_length() - 1)
    at = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(2 * low))
    return F.when(at < buckets, at).otherwise(at - low).cast("int")


def create_growing(spark: SparkSession, name: str, ddl: str, root: str, bucket_rows: int = BUCKET_ROWS) -> None:
    P.create_published(spark, name, f"{ddl}, {BUCKET} INT", BUCKET, root, buckets=1, rows=0, bucket_rows=bucket_rows)


def upsert_growing(spark: SparkSession, name: str, batch: DataFrame, keys: list[str], order: list[Column],
                   by_name: bool = True) -> dict[str, int]:
    """INSERT OR REPLACE; returns how many rows were replaced and inserted, and
    how many buckets the table has and the load wrote."""
    props = P.properties(spark, name)
    buckets, rows, bucket_rows = (int(props[k]) for k in ("buckets", "rows", "bucket_rows"))
    table = spark.table(props["current"])
    columns = [c for c in table.columns if c not in (BUCKET, P.VERSION)]
    if not by_name:
        batch = batch.toDF(*columns)
    # one row per key, once, and on disk: it is read for its buckets, its known keys and the rewrite
    one = dedupe_batch(batch, keys, order, keep="last").withColumn("__old", bucket_of(keys, buckets))
    folder = f"{props['root']}/staged/{P.uuid.uuid4().hex[:12]}"
    one.write.parquet(folder)
    one = spark.read.schema(one.schema).parquet(folder)
    asked = [(r["__old"], r["n"]) for r in one.groupBy("__old").agg(F.count(F.lit(1)).alias("n")).collect()]
    touched = {b for b, _ in asked}
    held = table.where(F.col(BUCKET).isin(sorted(touched)))
    known = held.select(*keys).join(one.select(*keys), keys, "left_semi").count()
    inserted = sum(n for _, n in asked) - known

    now = max(buckets, -(-(rows + inserted) // bucket_rows), 1)
    touched |= {address(b, buckets) for b in range(buckets, now)}       # buckets to split
    old = table.where(F.col(BUCKET).isin(sorted(touched))).drop(BUCKET, P.VERSION)
    new = upsert(old, one.drop("__old"), keys, unique=True)
    new = new.withColumn(BUCKET, bucket_of(keys, now)).repartition(BUCKET)
    gone = {str(b) for b in touched}
    P.publish(spark, name, P.stage(spark, name, new, props), lambda p: p[0] in gone, buckets=now, rows=rows + inserted)
    path, store = P._files(spark, folder)
    store.delete(path, True)
    return {"replaced": known, "inserted": inserted, "buckets": now, "written": len(touched) + now - buckets}
