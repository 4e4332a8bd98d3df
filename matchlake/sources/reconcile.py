"""Dumps that differ in columns or types, read as one table.

The schema of each dump comes from its Parquet footers or, for CSV, from its
header and one pass over all values.  Columns are matched by name (regardless of
case, as Spark does), in the order in which the dumps, by name, bring them.  Types are
widened only where every value is kept: integers to the larger integer, 32-bit
integers and floats to double, decimals to one that holds both.  Any other
difference makes the column text and is reported with the type each dump has.

Dumps with the same schema are read by one scan, so the plan has as many scans
as there are schemas, not dumps.  A column that a dump lacks is null there.  No dumps, two
columns of one name in a dump, or files of one dump that do not fit together
are an error.  Only names and types come to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONFLICTS = "column STRING, dump STRING, type STRING"

_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_INTEGERS = list(_DIGITS)
_EXACT_IN_DOUBLE = {*_INTEGERS[:3], T.FloatType(), T.DoubleType()}

# texts that a number gives back unchanged, or exactly up to 15 digits
_INT_TEXT = r"^(0|-?[1-9][0-9]{0,8})$"
_LONG_TEXT = r"^(0|-?[1-9][0-9]{0,17})$"
_DOUBLE_TEXT = r"^-?(?=[0-9.]{1,16}$)(0|[1-9][0-9]{0,14})(\.[0-9]{1,14})?$"


def _decimal(t: T.DataType) -> T.DecimalType | None:
    return T.DecimalType(_DIGITS[t], 0) if t in _DIGITS else t if isinstance(t, T.DecimalType) else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _DIGITS and b in _DIGITS:
        return max(a, b, key=_INTEGERS.index)
    if {a, b} <= _EXACT_IN_DOUBLE:
        return T.DoubleType()
    x, y = _decimal(a), _decimal(b)
    if x and y:
        scale = max(x.scale, y.scale)
        whole = max(x.precision - x.scale, y.precision - y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def reconcile(schemas: dict[str, T.StructType]) -> tuple[T.StructType, list[tuple[str, str, str]]]:
    """(schema that holds all dumps, (column, dump, type) of each column in conflict)."""
    found: dict[str, list[tuple[str, T.StructField]]] = {}
    for dump in sorted(schemas):
        names = [f.name.lower() for f in schemas[dump]]
        if len(set(names)) < len(names):
            raise ValueError(f"two columns of one name in {dump}: {schemas[dump].names}")
        for f in schemas[dump]:
            found.setdefault(f.name.lower(), []).append((dump, f))
    fields, conflicts = [], []
    for column in found.values():
        name, types = column[0][1].name, [f.dataType for _, f in column]
        kind = reduce(lambda a, b: a and wider(a, b), types)
        if kind is None:
            conflicts += [(name, dump, f.dataType.simpleString()) for dump, f in column]
        fields.append(T.StructField(name, T.StringType() if kind is None or isinstance(kind, T.NullType) else kind))
    return T.StructType(fields), conflicts


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _as(own: T.DataType, wanted: T.DataType, name: str) -> Column:
    c = F.col(_quoted(name))
    if own == wanted:
        return c
    if isinstance(wanted, T.StringType) and isinstance(own, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast(wanted)


def _csv(spark: SparkSession, columns: list[str], paths: list[str]) -> DataFrame:
    """Files of one header, all values as text; a file with another header is an error."""
    texts = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", True).option("enforceSchema", False).schema(texts).csv(paths)


def _csv_types(texts: DataFrame) -> list[T.DataType]:
    """The narrowest type of each column that gives all its values back, in one pass over all rows."""
    tests = [(T.IntegerType(), _INT_TEXT), (T.LongType(), _LONG_TEXT), (T.DoubleType(), _DOUBLE_TEXT),
             (T.BooleanType(), r"^(true|false)$")]
    counts = texts.agg(*[F.count(_quoted(c)).alias(f"n{i}") for i, c in enumerate(texts.columns)],
                       *[F.count_if(F.col(_quoted(c)).rlike(p)).alias(f"n{i}_{k}")
                         for i, c in enumerate(texts.columns) for k, (_, p) in enumerate(tests)]).first()
    return [T.NullType() if not counts[f"n{i}"] else
            next((t for k, (t, _) in enumerate(tests) if counts[f"n{i}_{k}"] == counts[f"n{i}"]), T.StringType())
            for i in range(len(texts.columns))]


def read_dumps(spark: SparkSession, dumps: dict[str, str], kind: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(all rows of the dumps in one schema, the conflicts): ``dumps`` maps a
    dump's name to its file or folder, ``kind`` is ``parquet`` or ``csv``."""
    if not dumps:
        raise ValueError("no dumps")
    groups: list[tuple[list[str], T.StructType, DataFrame]] = []
    if kind == "csv":
        headers: dict[tuple[str, ...], list[str]] = {}
        for dump in sorted(dumps):
            headers.setdefault(tuple(spark.read.option("header", True).csv(dumps[dump]).columns), []).append(dump)
        for columns, own in headers.items():
            texts = _csv(spark, list(columns), [dumps[d] for d in own])
            groups.append((own, T.StructType([T.StructField(c, t) for c, t in zip(columns, _csv_types(texts))]), texts))
    else:
        schemas: dict[str, list[str]] = {}
        for dump in sorted(dumps):
            found = spark.read.option("mergeSchema", True).parquet(dumps[dump]).schema
            schemas.setdefault(found.json(), []).append(dump)
        for own in schemas.values():
            schema = spark.read.option("mergeSchema", True).parquet(dumps[own[0]]).schema
            groups.append((own, schema, spark.read.schema(schema).parquet(*[dumps[d] for d in own])))
    wanted, conflicts = reconcile({d: schema for own, schema, _ in groups for d in own})
    parts = []
    for _, schema, rows in groups:
        # values of a CSV are still text here
        types = {f.name.lower(): (f.name, T.StringType() if kind == "csv" else f.dataType) for f in schema}
        parts.append(rows.select(*[
            (_as(types[w.name.lower()][1], w.dataType, types[w.name.lower()][0]) if w.name.lower() in types
             else F.lit(None).cast(w.dataType)).alias(w.name) for w in wanted]))
    return reduce(DataFrame.unionAll, parts), spark.createDataFrame(conflicts, CONFLICTS)
