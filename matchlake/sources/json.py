"""JSON landing readers and response routing.

Landed responses should be JSON Lines (one document per line) so files
split across tasks; ``multi_line=True`` reads whole-file documents (a file is
then one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_items(spark: SparkSession, path: str, item_schema: str, multi_line: bool = True) -> DataFrame:
    """``{"items": [...]}`` envelope -> one row per item."""
    env = spark.read.schema(f"items ARRAY<STRUCT<{_as_fields(item_schema)}>>") \
                    .option("multiLine", multi_line).json(path)
    return env.select(F.inline("items"))


def read_array(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Top-level JSON array -> one row per element (S2); JSON Lines also work."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_object(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """One JSON object per file (or per line) -> one row (S3)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def _as_fields(ddl: str) -> str:
    # "a STRING, b INT" -> "a: STRING, b: INT" at the top nesting level
    out, depth, cur = [], 0, ""
    for ch in ddl:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    out.append(cur.strip())
    return ", ".join(f"{p.split(' ', 1)[0]}: {p.split(' ', 1)[1]}" for p in out if p)


# fixed values: bodies that count as "no data" for a 200 response
EMPTY_BODIES = ["", "[]", "{}", "null"]


def response_outcome(status: Column, body: Column) -> Column:
    """200 with data -> ok; 200 without -> empty; 404 -> missing; else error."""
    empty = body.isNull() | F.trim(body).isin(*EMPTY_BODIES)
    return (F.when((status == 200) & ~empty, F.lit("ok"))
             .when(status == 200, F.lit("empty"))
             .when(status == 404, F.lit("missing"))
             .otherwise(F.lit("error")))


def route_responses(responses: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Adds ``outcome``; filter ``outcome = 'ok'`` for the data branch."""
    return responses.withColumn("outcome", response_outcome(F.col(status), F.col(body)))


def outcome_counts(routed: DataFrame) -> DataFrame:
    """Load counters per outcome (A11), one partial aggregation."""
    return routed.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
