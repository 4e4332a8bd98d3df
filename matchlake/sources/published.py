"""Tables whose partitions are published together, or not at all (K7).

A published table is a view over one *version*: an external Parquet table whose
partitions the catalog lists as (part, version).  All versions share one folder,
``<root>/data/<part>=.../version=.../``.  A load

1. writes its rows under a version tag of its own, which nobody reads yet;
2. registers a new version: the partitions of the current one that stay, and
   its own (metadata only, no file is copied);
3. points the view at the new version -- one catalog step.

A failure before step 3 leaves the old content, after it the new; readers see
one of the two, also when a load replaces many partitions.  A frame made before
a publish keeps reading its own version.  Versions but the last few are retired
afterwards, and folders that no remaining version lists are deleted.

Properties of the table (its number of buckets, its last load) are set in the
same step.  One writer at a time: the catalog has no compare-and-swap for views.
The list of partitions comes to the driver; it grows with the table's months or
buckets, not its rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CODEC

VERSION = "version"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"

Pair = tuple[str, str]      # (value of the part column, version tag)


def after(step: str) -> None:
    """Called after each step of a publish; tests make it fail."""


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def parts(spark: SparkSession, name: str, props: dict[str, str] | None = None) -> list[Pair]:
    """The (part, version) pairs that the table consists of now."""
    found = []
    for r in spark.sql(f"SHOW PARTITIONS {_quoted((props or properties(spark, name))['current'])}").collect():
        part, version = (piece.split("=", 1)[1] for piece in r[0].split("/"))
        found.append((part, version))
    return found


def _value(part: str) -> str:
    if part == NULL_PART:
        return "null"
    if not re.fullmatch(r"[A-Za-z0-9_-]+", part):
        raise ValueError(f"a part of a published table is a word, got {part!r}")
    return f"'{part}'"


def _register(spark: SparkSession, name: str, ddl: str, part: str, root: str, pairs: Iterable[Pair]) -> str:
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {_quoted(version)} ({ddl}, {VERSION} STRING) USING parquet "
              f"PARTITIONED BY ({part}, {VERSION}) LOCATION '{root}/data'")
    specs = [f"PARTITION ({part}={_value(p)}, {VERSION}='{v}')" for p, v in pairs]
    for at in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {_quoted(version)} ADD IF NOT EXISTS {' '.join(specs[at:at + 500])}")
    return version


def _point(spark: SparkSession, name: str, version: str, props: dict[str, str]) -> None:
    """The step that publishes: the view names the new version and its properties."""
    columns = ", ".join(f"`{c}`" for c in spark.table(version).columns if c != VERSION)
    listed = ", ".join(f"{_text(k)}={_text(v)}" for k, v in {**props, "current": version}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ({listed}) AS SELECT {columns} FROM {_quoted(version)}")


def create_published(spark: SparkSession, name: str, ddl: str, part: str, root: str, **props: object) -> None:
    """CREATE TABLE IF NOT EXISTS, without rows.  ``ddl`` includes the column ``part``."""
    if exists(spark, name):
        return
    # the schema stands in the version table's columns, so later publishes need only the names
    root = root.rstrip("/")
    version = _register(spark, name, ddl, part, root, [])
    _point(spark, name, version, {"part": part, "root": root, "versions": version, **{k: str(v) for k, v in props.items()}})


def stage(spark: SparkSession, name: str, rows: DataFrame, props: dict[str, str] | None = None) -> str:
    """Write rows under a new version tag; returns the tag."""
    props = props or properties(spark, name)
    tag = uuid.uuid4().hex[:12]
    table = spark.table(props["current"])
    rows = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                             for f in table.schema.fields if f.name != VERSION], f"'{tag}' AS {VERSION}")
    rows.write.mode("append").partitionBy(props["part"], VERSION).parquet(f"{props['root']}/data", compression=CODEC)
    after("staged")
    return tag


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def staged_parts(spark: SparkSession, tag: str, props: dict[str, str]) -> list[Pair]:
    """What a stage has written, from the folder's listing."""
    path, store = _files(spark, f"{props['root']}/data/*/{VERSION}={tag}")
    return [(s.getPath().getParent().getName().split("=", 1)[1], tag) for s in store.globStatus(path) or []]


def publish(spark: SparkSession, name: str, tag: str | None, drop: Callable[[Pair], bool] | None = None, keep: int = 2,
            **props: object) -> None:
    """Make staged rows part of the table and take the pairs that ``drop`` holds for out, in one step."""
    old = properties(spark, name)
    pairs = [p for p in parts(spark, name, old) if not (drop and drop(p))] + (staged_parts(spark, tag, old) if tag else [])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(old["current"]).schema.fields if f.name != VERSION)
    version = _register(spark, name, ddl, old["part"], old["root"], pairs)
    after("registered")
    versions = [*old["versions"].split(","), version]
    kept = {k: v for k, v in old.items() if not k.startswith("view.")}
    _point(spark, name, version, {**kept, **{k: str(v) for k, v in props.items()}, "versions": ",".join(versions[-keep - 1:])})
    after("published")
    if versions[:-keep - 1]:
        retire(spark, old["root"], versions[:-keep - 1], versions[-keep - 1:])


def retire(spark: SparkSession, root: str, versions: list[str], kept: list[str]) -> None:
    """Drop old versions and the folders that only they list."""
    def listed(version: str) -> set[str]:
        return {r[0] for r in spark.sql(f"SHOW PARTITIONS {_quoted(version)}").collect()}
    here = set().union(*(listed(v) for v in kept))
    for v in versions:
        if not spark.catalog.tableExists(v):
            continue
        for gone in listed(v) - here:
            path, store = _files(spark, f"{root}/data/{gone}")
            store.delete(path, True)
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(v)}")


def in_parts(part: str, pairs: Iterable[Pair], kind: str = "string") -> Column:
    """Condition on a version table that holds for exactly these pairs; only their folders are read."""
    by_part: dict[str, list[str]] = {}
    for p, v in pairs:
        by_part.setdefault(p, []).append(v)
    out = F.lit(False)
    for p, versions in by_part.items():
        own = F.col(part).isNull() if p == NULL_PART else F.col(part) == F.lit(p).cast(kind)
        out = out | (own & F.col(VERSION).isin(versions))
    return out


def drop_published(spark: SparkSession, name: str) -> None:
    if exists(spark, name):
        versions = properties(spark, name)["versions"].split(",")
        spark.sql(f"DROP VIEW {_quoted(name)}")
        for v in versions:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(v)}")


def append(spark: SparkSession, name: str, rows: DataFrame, **props: object) -> None:
    """INSERT: the rows join the table in one step."""
    publish(spark, name, stage(spark, name, rows), **props)


def replace_parts(spark: SparkSession, name: str, rows: DataFrame, values: Iterable[str], **props: object) -> None:
    """The parts ``values`` hold ``rows`` from now on, and nothing else; all change in one step."""
    values = {NULL_PART if v is None else str(v) for v in values}
    publish(spark, name, stage(spark, name, rows), lambda p: p[0] in values, **props)


# ---- compaction ----------------------------------------------------------------

#: Bytes that a compacted folder should hold, about.
FOLDER_BYTES = 128 << 20


def pack(sizes: dict[Pair, int], most: int = FOLDER_BYTES) -> list[list[Pair]]:
    """Bins of folders of one part, first fit by falling size, none over ``most``
    bytes; bins of a single folder are left out, as nothing is to be done there."""
    out: list[list[Pair]] = []
    by_part: dict[str, list[Pair]] = {}
    for pair in sizes:
        by_part.setdefault(pair[0], []).append(pair)
    for pairs in by_part.values():
        bins: list[tuple[int, list[Pair]]] = []
        for pair in sorted(pairs, key=lambda p: (-sizes[p], p)):
            for i, (held, own) in enumerate(bins):
                if held + sizes[pair] <= most:
                    bins[i] = (held + sizes[pair], [*own, pair])
                    break
            else:
                bins.append((sizes[pair], [pair]))
        out += [own for _, own in bins if len(own) > 1]
    return out


def folder_sizes(spark: SparkSession, name: str) -> dict[Pair, int]:
    props = properties(spark, name)
    out = {}
    for p, v in parts(spark, name, props):
        path, store = _files(spark, f"{props['root']}/data/{props['part']}={p}/{VERSION}={v}")
        out[p, v] = sum(f.getLen() for f in store.listStatus(path))
    return out


def compact(spark: SparkSession, name: str, most: int = FOLDER_BYTES) -> int:
    """Merge the small folders of each part, by file statistics; the table's rows do
    not change and readers see the old or the new folders.  Returns how many
    folders were merged."""
    bins = pack(folder_sizes(spark, name), most)
    if not bins:
        return 0
    props = properties(spark, name)
    table = spark.table(props["current"])
    kind = table.schema[props["part"]].dataType.simpleString()
    number = F.coalesce(*[F.when(in_parts(props["part"], own, kind), F.lit(i)) for i, own in enumerate(bins)])
    rows = table.where(in_parts(props["part"], [p for own in bins for p in own], kind)).withColumn("__bin", number)
    tag = stage(spark, name, rows.repartition(len(bins), "__bin").drop("__bin", VERSION), props)
    merged = {p for own in bins for p in own}
    publish(spark, name, tag, merged.__contains__)
    return sum(map(len, bins))
