"""Request keys built from tags (the engine starts at landed responses)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_tag(c: Column | str) -> Column:
    """Percent-encode the ``#`` of a tag: ``#ABC`` -> ``%23ABC``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(c, F.lit("#"), F.lit("%23"))


def format_url(template: str, *cols: Column | str) -> Column:
    """``template`` uses ``%s`` placeholders, filled by ``format_string``."""
    return F.format_string(template, *[F.col(c) if isinstance(c, str) else c for c in cols])
