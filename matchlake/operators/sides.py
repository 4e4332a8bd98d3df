"""Two-sided rows -> one row per side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided_unpivot(df: DataFrame, common: dict[str, Column],
                      sided: dict[str, tuple[Column, Column]],
                      side_col: str | None = None) -> DataFrame:
    """``(team_x, opponent_x)`` columns -> two rows with a common name ``x``.

    One scan: the row becomes an array of two structs that is exploded, so the
    source is read once (a SQL UNION of two SELECTs reads it twice).
    ``common`` columns are computed once per input row.
    """
    names = list(sided)

    def side(i: int, label: str) -> Column:
        fields = [sided[n][i].alias(n) for n in names]
        if side_col:
            fields.append(F.lit(label).alias(side_col))
        return F.struct(*fields)

    both = F.explode(F.array(side(0, "team"), side(1, "opponent"))).alias("__side")
    staged = df.select(*[c.alias(n) for n, c in common.items()], both)
    outs = [F.col(n) for n in common] + [F.col("__side." + n).alias(n) for n in names]
    if side_col:
        outs.append(F.col("__side." + side_col).alias(side_col))
    return staged.select(*outs)
