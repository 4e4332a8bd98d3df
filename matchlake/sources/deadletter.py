"""Landed documents that cannot be read, kept with their text.

Documents are read permissively: a record that does not fit its schema keeps its
whole text beside what could be read.  Such records go to a dead-letter table
(file, reason, text, load) instead of becoming rows of NULLs, and can be replayed
once the text or the schema has been mended.

``malformed``  the text is no JSON
``bad_field``  it is JSON, but a field is not of its type
``not_found`` / ``failed``  the response had status 404, or any other but 200
``empty``  a 200 response without data
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import published as P
from .json import response_outcome

CORRUPT = "_corrupt_record"
DEAD = "file STRING, reason STRING, text STRING, load_id STRING"


def create_dead_letters(spark: SparkSession, name: str, root: str) -> None:
    P.create_published(spark, name, DEAD, "load_id", root)


def reason(text: Column) -> Column:
    """Why a text did not fit its schema."""
    return F.when(F.get_json_object(text, "$").isNull(), F.lit("malformed")).otherwise(F.lit("bad_field"))


def read_checked(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON documents with ``_corrupt_record`` (NULL where a document fits) and ``source_file``."""
    return (spark.read.schema(f"{schema}, {CORRUPT} STRING").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).json(path)
            .select("*", F.col("_metadata.file_path").alias("source_file")))


def _split(spark: SparkSession, rows: DataFrame, dead_table: str, load_id: str) -> DataFrame:
    """Publish the dead letters of a load (again, if it is repeated); the good rows."""
    # parsed once: the two parts are read from files
    folder = shared_dir(spark, "landed", "checked")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    dead = rows.where(F.col(CORRUPT).isNotNull()).select(
        F.col("source_file").alias("file"), F.coalesce("reason", reason(F.col(CORRUPT))).alias("reason"),
        F.col(CORRUPT).alias("text"), F.lit(load_id).alias("load_id"))
    P.replace_parts(spark, dead_table, dead, [load_id])
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "reason")


def land(spark: SparkSession, path: str, schema: str, dead_table: str, load_id: str, multi_line: bool = False) -> DataFrame:
    """The documents of a landing folder that fit ``schema``; the others become
    dead letters of the load.  None is lost and none becomes a row of NULLs."""
    rows = read_checked(spark, path, schema, multi_line)
    return _split(spark, rows.withColumn("reason", F.lit(None).cast("string")), dead_table, load_id)


def land_responses(spark: SparkSession, responses: DataFrame, schema: str, dead_table: str, load_id: str) -> DataFrame:
    """The parsed bodies of API responses (key, status, body) that have data; all
    others become dead letters with their outcome and their body ('' if NULL)."""
    outcome = response_outcome(F.col("status"), F.col("body"))
    why = F.when(outcome == "missing", F.lit("not_found")).when(outcome == "error", F.lit("failed")).when(outcome == "empty", F.lit("empty"))
    parsed = F.from_json("body", f"{schema}, {CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = responses.select("key", "body", why.alias("reason"), F.when(why.isNull(), parsed).alias("p")).select(
        F.col("key").alias("source_file"), "reason",
        F.when(F.col("reason").isNotNull(), F.coalesce("body", F.lit(""))).otherwise(F.col(f"p.{CORRUPT}")).alias(CORRUPT), "p")
    return _split(spark, rows.withColumn("p", F.col("p").dropFields(CORRUPT)), dead_table, load_id).select("source_file", "p.*")


def replay(spark: SparkSession, dead_table: str, load_id: str, schema: str, mend: Column | None = None) -> DataFrame:
    """Read a load's dead letters again, their ``text`` mended by an expression;
    those that fit now are returned and leave the table, the others stay with the
    reason they have now."""
    letters = spark.table(dead_table).where(F.col("load_id") == load_id)
    text = F.col("text") if mend is None else mend
    parsed = F.from_json("text", f"{schema}, {CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = letters.select("file", text.alias("text"), "reason").select("file", "text", "reason", parsed.alias("p"))
    body = F.col("reason").isin("malformed", "bad_field")
    left = ~body | F.col(f"p.{CORRUPT}").isNotNull() | F.col("text").isNull()
    rows = rows.select(F.col("file").alias("source_file"),
                       F.when(~body, F.col("reason")).alias("reason"),
                       F.when(left, F.col("text")).alias(CORRUPT), F.col("p").dropFields(CORRUPT).alias("p"))
    return _split(spark, rows, dead_table, load_id).select("source_file", "p.*")
