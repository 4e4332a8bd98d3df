"""Idempotent keyed writes as pure DataFrame rewrites.

``insert_ignore(target, batch, keys)`` returns the rows to append;
``upsert(target, batch, keys)`` returns the new table content.  Table-level
wrappers (atomic directory swap) live in :mod:`matchlake.sources.catalog`.

Semantics (those of a SQL ``INSERT OR IGNORE`` / ``INSERT OR REPLACE ... BY
NAME`` against a UNIQUE key):
* duplicates inside one batch collapse to one row, NULL key parts comparing
  equal there: insert-or-ignore keeps the first in load order, upsert the last.
  Load order (landing file and position, fetch time, or any total order on the
  rows) must be given: without it "first" and "last" have no meaning.  It may
  use columns of the batch that the target lacks;
* a NULL key part never matches a stored row, so such rows are always
  inserted;
* upsert replaces only the columns the batch carries; an explicit NULL in the
  batch wins over the stored value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .repeats import split_repeats


def dedupe_batch(batch: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """One row per key (NULLs equal), the first or last in load ``order``.  An
    aggregate, not a window: partial aggregation keeps a hot key from landing
    whole on one task."""
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.dropDuplicates(keys)
    if not order:
        raise ValueError("load order is needed to choose between rows of the same key")
    pick = F.min_by if keep == "first" else F.max_by
    # rows that tie in load order are settled by their content
    rank = F.struct(*order, F.xxhash64(*[F.col(f"`{c}`") for c in others]))
    agg = batch.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        pick(F.struct(*[F.col(f"`{c}`") for c in others]), rank).alias("__row"))
    return agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col("__row").getField(c).alias(c) for c in others]) \
              .select(*[F.col(f"`{c}`") for c in batch.columns])


def dedupe_stored(batch: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """The rows of :func:`dedupe_batch` for a batch that is in files: a row whose key
    comes once passes without sort or shuffle; the repeated keys are looked for now."""
    if not order and set(batch.columns) - set(keys):
        raise ValueError("load order is needed to choose between rows of the same key")
    once, rest = split_repeats(batch, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))
    if rest is None:
        return once
    rest = dedupe_batch(rest, keys, order, keep)
    return rest if once is None else once.unionByName(rest)


def _key_match(keys: list[str], left: str, right: str) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`")  # NULL never matches
        cond = c if cond is None else cond & c
    return cond


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str],
                  order: list[Column] | None = None, by_name: bool = True,
                  prune_on: str | None = None, stored: bool = False, unique: bool = False) -> DataFrame:
    """Rows of ``batch`` to append to ``target`` (an anti join on ``keys``).

    ``by_name`` aligns the batch to the target's columns, filling absent ones
    with NULL; positional mode renames the batch columns to the target's.

    ``prune_on`` names a column of both frames that is a function of the key
    (e.g. the battle month of the key's battle time, the landing table's
    partition column).  Only target rows between the batch's least and greatest
    value can match; the two are scalar subqueries, so the scan reads just the
    partitions between them.  Exact for any batch.

    ``stored`` says that the batch is in files and may be read more than once:
    whole rows are then shuffled only to meet stored keys, if there are any.
    ``unique`` says that no key comes twice in it, NULLs being equal.
    """
    if not by_name:
        batch = batch.toDF(*target.columns)
    deduped = align_by_name(batch if unique else (dedupe_stored if stored else dedupe_batch)(batch, keys, order), target)
    if stored and target.isEmpty():
        return deduped
    # stored rows with a NULL key part can never match: drop them before the
    # shuffle (they would all hash to one partition)
    t = target.where(_all_keys_present(keys))
    if prune_on:
        span = batch.agg(F.min(prune_on).alias("a"), F.max(prune_on).alias("b"))
        t = t.where(F.col(prune_on).between(span.select("a").scalar(), span.select("b").scalar()))
    t = t.select(*[F.col(f"`{k}`") for k in keys]).alias("t")
    return deduped.alias("b").join(t, _key_match(keys, "b", "t"), "left_anti")


def _all_keys_present(keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"`{k}`").isNotNull()
        cond = c if cond is None else cond & c
    return cond


def align_by_name(batch: DataFrame, target: DataFrame) -> DataFrame:
    have = set(batch.columns)
    cols = []
    for f in target.schema.fields:
        if f.name in have:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return batch.select(*cols)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           order: list[Column] | None = None, by_name: bool = True, unique: bool = False) -> DataFrame:
    """Full new content of ``target`` after an insert-or-replace, by name or
    (``by_name=False``) by position.

    Batch rows whose key has a NULL part never match and are appended.
    Within the batch the *last* row per key in load order wins; ``unique`` says
    that no key comes twice, NULLs being equal.
    """
    if not by_name:
        batch = batch.toDF(*target.columns)
    supplied = [c for c in target.columns if c in set(batch.columns) and c not in keys]
    b = (batch if unique else dedupe_batch(batch, keys, order, keep="last")).select(
        *[F.col(f"`{c}`") for c in batch.columns if c in set(target.columns)])
    # rows with a NULL key part never match: they bypass the join (a full
    # outer join cannot split a skewed partition, and they would all share one)
    has_keys = _all_keys_present(keys)
    t_null = target.where(~has_keys)
    b_null = align_by_name(b.where(~has_keys), target)
    b = b.where(has_keys).withColumn("__in_batch", F.lit(True))
    t = target.where(has_keys).alias("t")
    j = t.join(b.alias("b"), _key_match(keys, "t", "b"), "full_outer")
    in_b = F.col("b.__in_batch").isNotNull()
    cols = []
    for f in target.schema.fields:
        n = f.name
        if n in keys or n in supplied:
            cols.append(F.when(in_b, F.col(f"b.`{n}`")).otherwise(F.col(f"t.`{n}`"))
                        .cast(f.dataType).alias(n))
        else:
            cols.append(F.col(f"t.`{n}`").alias(n))
    return j.select(*cols).unionByName(t_null).unionByName(b_null)
