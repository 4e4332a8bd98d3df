"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression plus the literal tokens (runs of ``[a-z0-9]``)
that every URL it fits must hold whole.  The tokens of all URLs are counted;
each rule is filed under the one of its tokens that the fewest URLs hold.  A
URL fetches the rules filed under its own tokens by a join, and only these run
their regular expressions.  Rules without a token are filed under the empty
token, which every URL holds.

Edge cases: a null URL, or one without ``://``, has an empty host and path and
fits no host rule; its verdict is the default.  Equal URLs are judged once and
share the verdict.  Extra columns are kept out of the work; only the row's own
columns are returned, with ``host, path, rule, verdict`` added (a column of
the input with one of these names is replaced).  Empty table: no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule tables up to this many rows (a few MB) are sent to every executor;
#: longer ones are joined by a shuffle on the token.
BROADCAST_RULES = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``regex`` is searched in ``host + path`` (host lower-cased).  ``shown``
    is what the result names; among fitting rules the highest ``tier``, then
    the longest ``name`` wins."""
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    tier: int = 0
    shown: bool = False


def host_rule(host: str, path: str, verdict: str) -> UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    found = re.findall("[a-z0-9]+", host)
    # a token that ends the path may go on in the URL, so it is not a whole one
    found += re.findall("[a-z0-9]+(?=[^a-z0-9])", path.lower())
    rx = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)
    return UrlRule(host + path, verdict, rx, tuple(dict.fromkeys(found)), tier=1, shown=True)


def path_word_rule(word: str) -> UrlRule:
    """Blocks URLs with a path segment or file suffix equal to ``word``."""
    return UrlRule(f"word:{word}", "block", rf"(?i)/(?:[^/]*\.)?{re.escape(word)}(?:/|\z)", (word,))


#: Pages that carry no prose: accounts, shops and binary files.
DEFAULT_RULES = tuple(path_word_rule(w) for w in (
    "login", "logout", "signin", "signup", "register", "cart", "checkout", "wishlist",
    "jpg", "jpeg", "png", "gif", "svg", "webp", "mp3", "mp4", "avi", "zip", "gz", "exe", "dmg", "iso"))


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict``."""
    spark = pages.sparkSession
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    urls = pages.select(F.col(url).alias("u")).where(F.col("u").isNotNull()).distinct().select(
        "u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"))
    urls = urls.withColumn("hp", F.concat("h", "p"))
    held = F.array_distinct(F.split(F.translate("hp", UPPER, LOWER), "[^a-z0-9]+"))
    spots = urls.select("u", "hp", F.explode(F.array_union(held, F.array(F.lit("")))).alias("token"))

    table = spark.createDataFrame(
        [(i, r.name, r.verdict, r.regex, r.tier, r.shown, list(r.tokens) or [""]) for i, r in enumerate(rules)],
        "rule_id int, name string, rule_verdict string, regex string, tier int, shown boolean, tokens array<string>")
    small = len(rules) <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda df: df)
    by_token = table.select("rule_id", F.explode("tokens").alias("token"))
    counts = spots.join(hint(by_token.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    filed = by_token.join(counts, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    index = table.drop("tokens").join(filed, "rule_id")

    fits = spots.join(hint(index), "token").where(F.regexp_like("hp", F.col("regex")))
    best = fits.groupBy("u").agg(F.max(F.struct(
        "tier", F.length("name").alias("n"), F.struct("name", "rule_verdict", "shown").alias("r")))["r"].alias("best"))
    rows = pages.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(keep)], F.col(url).alias("u"))
    out = rows.join(best, "u", "left")
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(keep)],
                      host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"),
                      F.when(F.col("best.shown"), F.col("best.name")).alias("rule"),
                      F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
