"""Catalog tables, snapshot import/export and atomic table rewrites.

Tables are Parquet directories.  A rewrite never overwrites the path it is
reading: it writes a new versioned directory and then points the catalog
table at it (or returns the new path for path-based tables).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.writes import align_by_name, insert_ignore, upsert
from ..session import CODEC, shared_dir


def ensure_schemas(spark: SparkSession, *names: str) -> None:
    """CREATE SCHEMA IF NOT EXISTS (K3)."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`")


def create_table(spark: SparkSession, name: str, schema_ddl: str, location: str,
                 replace: bool = False, partition_by: list[str] | None = None) -> None:
    """CREATE [OR REPLACE] TABLE with explicit columns (K1/K2)."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet{part} "
              f"LOCATION '{location}'")


def use_schema(spark: SparkSession, name: str) -> None:
    """USE schema (K3): unqualified names then mean its tables."""
    spark.catalog.setCurrentDatabase(name)


def replace_table(spark: SparkSession, name: str, df: DataFrame, location: str) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS SELECT (K1) without a moment in which
    readers find no table: the new content is written to ``location`` first,
    then the table is pointed at it."""
    df.write.mode("error").parquet(location, compression=CODEC)
    if spark.catalog.tableExists(name):
        swap_location(spark, name, location)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return spark.table(name)


def drop_versions(spark: SparkSession, folder: str, current: str, keep: int = 1) -> int:
    """Remove the ``v-...`` folders of a rewritten table but for the current one
    and the ``keep`` newest others, which running readers may still use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = sorted((f for f in store.listStatus(path) if f.getPath().getName().startswith("v-")
                  and f.getPath().getName() != current.rstrip("/").rpartition("/")[2]),
                 key=lambda f: -f.getModificationTime())
    for f in old[keep:]:
        store.delete(f.getPath(), True)
    return len(old[keep:])


def write_table(df: DataFrame, name: str, location: str, mode: str = "overwrite") -> None:
    """Materialize a model as a table at an explicit location (K1/K2/K9).

    ``mode='ignore'`` gives CREATE TABLE IF NOT EXISTS ... AS SELECT.
    """
    df.write.mode(mode).option("path", location).option("compression", CODEC).format("parquet").saveAsTable(name)


def append_parquet(spark: SparkSession, name: str, path: str, schema_ddl: str) -> None:
    """COPY table FROM a Parquet file (K10): typed read, by-name append."""
    src = spark.read.schema(schema_ddl).parquet(path)
    target = spark.table(name)
    align_by_name(src, target).write.insertInto(name)


def swap_location(spark: SparkSession, name: str, new_location: str) -> None:
    """Point a table at a freshly written directory (the atomic step)."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_location}'")
    spark.catalog.refreshTable(name)


def insert_ignore_table(spark: SparkSession, name: str, batch: DataFrame, keys: list[str],
                        order=None, by_name: bool = True, prune_on: str | None = None) -> None:
    """INSERT OR IGNORE into a catalog table (K4/K5): anti join, then append.

    With ``prune_on`` (the table's partition column, a function of the key)
    only the partitions the batch touches are read for the anti join.
    """
    target = spark.table(name)
    new = insert_ignore(target, batch, keys, order, by_name, prune_on=prune_on)
    if prune_on:
        # cluster the append by (partition, key bucket): a few files per
        # partition, and a batch of one day still spreads over many writers
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
        new = new.repartition(F.col(prune_on), F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    new.write.insertInto(name)


def upsert_table(spark: SparkSession, name: str, batch: DataFrame, keys: list[str],
                 order=None, base: str | None = None, by_name: bool = True) -> str:
    """INSERT OR REPLACE into a catalog table, by name (K6) or by position (K7).

    Writes the new content to a new directory under the shared folder, then
    swaps the table location; readers see the old or the new table, never a
    half-written one.  Returns the new location.
    """
    target = spark.table(name)
    out = upsert(target, batch, keys, order, by_name)
    loc = base or shared_dir(spark, "tables", name.replace(".", "_"))
    out.write.mode("error").parquet(loc)
    swap_location(spark, name, loc)
    return loc


def import_snapshot(spark: SparkSession, src_dir: str, dest_dir: str,
                    tables: dict[str, str] | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """DDL + one Parquet file per table -> catalog tables.

    File names follow ``schema_table.parquet`` (``main`` tables unprefixed).
    ``prefix`` goes before the schema names, for a set of schemas of its own.
    """
    tables = tables or S.SNAPSHOT_TABLES
    out = {}
    for t, ddl in tables.items():
        fname = t.replace(".", "_") + ".parquet"
        df = spark.read.schema(ddl).parquet(f"{src_dir.rstrip('/')}/{fname}")
        loc = f"{dest_dir.rstrip('/')}/{t.replace('.', '/')}"
        name = t if not prefix else f"{prefix}{t}" if "." in t else f"{prefix}main.{t}"
        if "." in name:
            ensure_schemas(spark, name.split(".")[0])
        write_table(df, name, loc)
        out[t] = spark.table(name)
    return out


def export_snapshot(frames: dict[str, DataFrame], dest_dir: str) -> None:
    """Write each table as ``schema_table.parquet`` (a directory of parts)."""
    for t, df in frames.items():
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{dest_dir.rstrip('/')}/{t.replace('.', '_')}.parquet")


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for a set of tables, as one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
             for t, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over local frames referenced by name, e.g. ``{df}``."""
    return spark.sql(query, **frames)


def ladder_table(spark: SparkSession, parquet_dir: str, dest_dir: str,
                 schema_name: str = "raw", names: DataFrame | None = None) -> str:
    """CREATE OR REPLACE TABLE raw.raw_battles_<first>_<last> from a dump
    directory (D11); the dates come from the file names, or from ``names``
    (file_name) where the files themselves are named otherwise.  Only the
    one-row label reaches the driver.  Returns the table name."""
    from .files import date_range_label, read_parquet_dir, source_file_names
    df = spark.read.parquet(parquet_dir) if names is not None else read_parquet_dir(spark, parquet_dir)
    label = date_range_label(source_file_names(df) if names is None else names).first()["table_name"]
    name = f"{schema_name}.{label}"
    ensure_schemas(spark, schema_name)
    replace_table(spark, name, df, f"{dest_dir.rstrip('/')}/{label}/v-{uuid.uuid4().hex[:12]}")
    return name
