"""File sources: CSV and Parquet battle dumps, and dates carried in file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: dump file suffix, date format inside file names
LADDER_SUFFIX = "WL_tagged.csv"
NAME_DATE_FORMAT = "MMddyyyy"


def read_ladder_csv(spark: SparkSession, path: str, schema: str | None = None,
                    suffix: str = LADDER_SUFFIX) -> DataFrame:
    """CSV dumps whose file names end with ``suffix``.

    Without a schema the header row names the columns and types are inferred
    from all rows (the only inferring reader in the package).
    """
    r = spark.read.option("header", True).option("pathGlobFilter", f"*{suffix}")
    if schema:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_parquet_dir(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All ``*.parquet`` files of a directory."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.parquet(path.rstrip("/") + "/*.parquet")


def csv_to_parquet(spark: SparkSession, src: str, dest: str, schema: str | None = None,
                   suffix: str = LADDER_SUFFIX) -> DataFrame:
    """Convert the CSV dumps to Parquet in one distributed write (K8).

    Output is partitioned by the source file stem, so each input keeps its
    own folder; returns the written data read back lazily.
    """
    df = read_ladder_csv(spark, src, schema, suffix) \
        .withColumn("source_file", file_stem(F.col("_metadata.file_name")))
    df.write.mode("overwrite").partitionBy("source_file").parquet(dest)
    return spark.read.parquet(dest)


def file_stem(name: Column) -> Column:
    """``a/b/x.y.csv`` -> ``x.y``."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def name_dates(names: DataFrame, col: str = "file_name", fmt: str = NAME_DATE_FORMAT) -> DataFrame:
    """Every digit run of each file name parsed as a date."""
    runs = names.select(F.explode(F.regexp_extract_all(F.col(col), F.lit(r"(\d+)"), 1)).alias("run"))
    return runs.select(F.to_date(F.col("run"), fmt).alias("d"))


def date_range_label(names: DataFrame, col: str = "file_name", prefix: str = "raw_battles_",
                     fmt: str = NAME_DATE_FORMAT) -> DataFrame:
    """One row: table name carrying the min..max date found in names."""
    d = name_dates(names, col, fmt).agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"))
    return d.select(
        F.concat(F.lit(prefix), F.date_format("min_date", fmt), F.lit("_"),
                 F.date_format("max_date", fmt)).alias("table_name"),
        "min_date", "max_date")


def source_file_names(df: DataFrame) -> DataFrame:
    """Distinct file names behind a file-based DataFrame."""
    return df.select(F.col("_metadata.file_name").alias("file_name")).distinct()
