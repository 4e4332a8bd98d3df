"""Surrogate keys.

The warehouse keys are hashes of natural keys.  ``md5_key`` is the default
because it is reproducible in any SQL engine (the leading 15 hex digits of
md5, i.e. a non-negative 60-bit BIGINT); ``xx_key`` is the cheaper
engine-local alternative.  A NULL natural key gives a NULL surrogate key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def md5_key(c: Column | str) -> Column:
    """60-bit BIGINT from md5 text; NULL in, NULL out."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("bigint")


def xx_key(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.xxhash64(c))


def list_key(arr: Column | str, key=md5_key) -> Column:
    """Order-sensitive key of an array that keeps NULL elements apart.

    Hashing the JSON text keeps ``[a, NULL, b]`` and ``[a, b]`` distinct
    (plain ``xxhash64`` over an array skips NULL elements and collides).
    """
    arr = F.col(arr) if isinstance(arr, str) else arr
    return key(F.to_json(arr, _JSON_KEEP_NULLS))


def battle_id(battle_time: Column | str, team_tag: Column | str,
              opponent_tag: Column | str) -> Column:
    """md5 of the concatenation, skipping NULL parts like SQL CONCAT does."""
    return F.md5(F.concat_ws("", *(F.col(x) if isinstance(x, str) else x
                                   for x in (battle_time, team_tag, opponent_tag))))
