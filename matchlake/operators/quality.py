"""Declared data-quality rules, evaluated as distributed reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are NULL or occur more than once: ``keys..., n, reason``."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else any_null | c
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (g.where(any_null | (F.col("n") > 1))
             .withColumn("reason", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate_key"))))


def check_violations(df: DataFrame, checks: dict[str, Column], carry: list[str]) -> DataFrame:
    """Rows failing a CHECK (a NULL result passes, as in SQL): ``carry..., check_name``."""
    parts = [df.where(~F.coalesce(expr, F.lit(True)))
               .select(*carry, F.lit(name).alias("check_name"))
             for name, expr in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_facts(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]],
                 carry: list[str]) -> DataFrame:
    """Fact rows whose dimension row is missing, one report row per (fact, dimension).

    ``dims`` maps a label to (dimension frame, fact column, dimension column).
    NULL fact keys are not reported (an inner join would also drop them, but
    they are not a broken reference).  One pass over the facts: each
    dimension contributes its distinct keys (one row per key, so the left
    join never multiplies facts; small key sets are broadcast by AQE), and
    the labels of the missing ones are exploded at the end.
    """
    need = list(dict.fromkeys(carry + [fcol for _, fcol, _ in dims.values()]))
    out = fact.select(*need)
    flags = []
    for i, (label, (dim, fcol, dcol)) in enumerate(dims.items()):
        k, hit = f"__k{i}", f"__hit{i}"
        keys = dim.select(F.col(dcol).alias(k)).where(F.col(k).isNotNull()).distinct() \
                  .withColumn(hit, F.lit(True))
        out = out.join(keys, F.col(fcol) == F.col(k), "left")
        flags.append(F.when(F.col(fcol).isNotNull() & F.col(hit).isNull(), F.lit(label)))
    missing = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return out.select(*carry, F.explode(missing).alias("dimension"))
