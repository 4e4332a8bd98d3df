"""Array / struct helpers for nested API documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed value: the card whose elixir cost is not a fixed number
MIRROR = "Mirror"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def slots(arr: Column | str, field: str | None = None, n: int = 8) -> Column:
    """``[arr[1].field, ..., arr[n].field]``: always n entries, NULL past the end."""
    arr = _c(arr)

    def pick(i):
        e = F.get(arr, i)
        return e.getField(field) if field else e
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), pick)


def list_avg(arr: Column | str) -> Column:
    """Average of the non-NULL elements as DOUBLE; NULL when there are none."""
    vals = F.filter(_c(arr), lambda x: x.isNotNull())
    total = F.aggregate(vals, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(vals) > 0, total / F.size(vals))


def mirror_cost(cards: Column | str) -> Column:
    """Keep name/level/elixirCost of each card; Mirror's cost becomes NULL."""
    return F.transform(_c(cards), lambda c: F.struct(
        c.getField("name").alias("name"),
        c.getField("level").cast("bigint").alias("level"),
        F.when(c.getField("name") != F.lit(MIRROR), c.getField("elixirCost"))
         .cast("int").alias("elixirCost")))


def first_element_fields(arr: Column | str, fields: dict[str, str], prefix: str) -> list[Column]:
    """Fields of the first list element as ``prefix_<alias>`` columns.

    ``fields`` maps output suffix -> dotted path inside the element.  An empty
    or missing list gives NULLs (``get`` is NULL-safe past the end).
    """
    first = F.get(_c(arr), 0)
    out = []
    for alias, path in fields.items():
        e = first
        for part in path.split("."):
            e = e.getField(part)
        out.append(e.alias(f"{prefix}_{alias}"))
    return out


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs -> top-level ``a_b_c`` columns; arrays left as they are.

    Walks the schema (not the rows) and emits a single projection.
    """
    cols: list[Column] = []

    def walk(dtype, path: list[str], expr: Column):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name], expr.getField(f.name))
        else:
            cols.append(expr.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name], F.col(f"`{f.name}`"))
    return df.select(*cols)
