"""Date and time helpers for battle timestamps.

Fixed values: the battle-time text format ``%Y%m%dT%H%M%S.%fZ`` (3 or 6
fraction digits), the date key format ``%Y%m%d`` and the display format
``%B %-d, %Y``; weekend days are Saturday and Sunday.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: battle time text format (SSSSSS also accepts 3 fraction digits)
BATTLE_TIME_FORMAT = "yyyyMMdd'T'HHmmss.SSSSSS'Z'"
BATTLE_TIME_OUT_FORMAT = "yyyyMMdd'T'HHmmss.SSS'Z'"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_battle_time(c: Column | str, strict: bool = True) -> Column:
    """Battle-time text -> TIMESTAMP_NTZ.  Strict raises on bad text,
    tolerant gives NULL."""
    c = _c(c)
    if strict:
        return F.to_timestamp_ntz(c, F.lit(BATTLE_TIME_FORMAT))
    return F.try_to_timestamp(c, F.lit(BATTLE_TIME_FORMAT)).cast("timestamp_ntz")


def yyyymmdd(c: Column | str) -> Column:
    return F.date_format(_c(c), "yyyyMMdd")


def month_name(c: Column | str) -> Column:
    return F.date_format(_c(c), "MMMM")


def day_name(c: Column | str) -> Column:
    return F.date_format(_c(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    # weekday(): Monday = 0 ... Sunday = 6
    return F.when(F.weekday(_c(c)) >= 5, F.lit("yes")).otherwise(F.lit("no"))


def month_day_year(c: Column | str) -> Column:
    return F.date_format(_c(c), "MMMM d, yyyy")
