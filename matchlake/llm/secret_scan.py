"""Secrets in texts, found through an inverted index of trigrams.

Each rule is a regular expression.  :func:`trigrams.query` derives from it which
trigrams a text with a match must hold (an OR of ANDs).  :func:`postings` lists,
for every trigram that some rule asks for, the texts that hold it;
:func:`candidates` intersects the postings of each clause; only candidate texts
run the rule's expression.  A rule without mandatory trigrams (long runs of hex
digits) runs over every text.  The index only rules texts out, so the result is
that of running every rule over every text.

DataFrame functions only.  Texts are known by a 64-bit hash in the index: equal
texts share their postings, and texts that collide share them too, which can
add candidates but lose none.  Postings combine map-side, one long per (text,
clause), so a text that a third of the rows hold is one row per map task; the
texts meet their candidates in a left join, whose large side can be split.

``spans`` lists ``kind:start:end`` of all matches in order of their start, then
of their rule, comma-joined; offsets count code points, the end is exclusive,
and a span is the whole match.  Matches of one rule do not overlap, those of
different rules may.

Edge cases: a null or empty text has no spans (digest of the empty string);
whole texts are searched, however long; equal rows each give a row; an empty
table gives none; other columns pass through :func:`scan` untouched, unless they
have the name of a result column, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .trigrams import query


@dataclass(frozen=True)
class SecretRule:
    """``regex`` uses what Java's and Python's syntax share.  A match counts if
    ``group`` has at least ``least`` code points; failing matches use up their
    text all the same."""
    kind: str
    regex: str
    group: int = 0
    least: int = 0
    base: bool = False


# The base rules.  The runs of "access" and "hex" go on as far as
# they can, so their least length stands in the expression itself.
BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               group=2, least=6, base=True),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    SecretRule("hex", r"[0-9a-f]{24,}", base=True),
)
# Published forms of credentials.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    SecretRule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
)
DEFAULT_RULES = BASE_RULES + MORE_RULES

#: Matches whose lengths are summed up together; see :func:`_starts`.
STEP = 256
KEY, FOUND = "__text", "__rules"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _bits(rules) -> list[tuple[str, int, int, int]]:
    """(trigram, clause, its bit in the clause, all bits of the clause) of every rule's query."""
    out = []
    clause = 0
    for rule in rules:
        for grams in query(rule.regex) or ():
            # 62 trigrams of a longer clause are condition enough
            for i, g in enumerate(sorted(grams)[:62]):
                out.append((g, clause, 1 << i, (1 << min(len(grams), 62)) - 1))
            clause += 1
    return out


def _clause_rules(rules) -> list[int]:
    """The rule of each clause."""
    return [n for n, rule in enumerate(rules) for _ in query(rule.regex) or ()]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def postings(docs: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """The inverted index, (trigram, text key), of the trigrams that ``rules`` ask for."""
    grams = sorted({g for g, *_ in _bits(rules)})
    if not grams:
        return docs.sparkSession.createDataFrame([], f"trigram string, {KEY} long")
    held = _let(F.lower("text"), lambda low: F.filter(
        F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(low, g)))
    return docs.where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias(KEY), F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """(text key, numbers of the rules that its trigrams admit): the postings of a
    clause are intersected by collecting a bit for each of its trigrams."""
    spark = index.sparkSession
    bits, of_clause = _bits(rules), _clause_rules(rules)
    # as many rows as the rules have trigrams, however large the input
    clauses = spark.createDataFrame(bits, "trigram string, clause int, bit long, full long")
    whole = index.join(F.broadcast(clauses), "trigram").groupBy(KEY, "clause").agg(
        F.bit_or("bit").alias("bits"), F.first("full").alias("full")).where("bits = full")
    rule = F.array(*[F.lit(n) for n in of_clause] or [F.lit(0)])[F.col("clause")]
    return whole.groupBy(KEY).agg(F.collect_set(rule).alias(FOUND))     # at most one entry per rule


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each.  Blocks of ``STEP`` are summed first, so
    that a text with very many matches does not cost the square of their number."""
    def add(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def by_block(a: Column) -> Column:
        n_blocks = F.ceil(F.size(a) / F.lit(STEP)).cast("int")
        sums = F.transform(F.sequence(F.lit(0), n_blocks), lambda b: add(F.slice(a, b * STEP + 1, STEP)))
        return _let(sums, lambda s: _let(
            F.transform(s, lambda _, b: add(F.slice(s, 1, b))),
            lambda before: F.transform(a, lambda _, i: before[F.floor(i / F.lit(STEP)).cast("int")]
                                       + add(F.slice(a, F.floor(i / F.lit(STEP)).cast("int") * STEP + 1, i % STEP)))))
    return _let(lengths, by_block)


def _spans(text: Column, number: int, rule: SecretRule) -> Column:
    """Array of (start, rule number, end) of the rule's matches.  The text between
    matches (split) and the matches themselves (extract) take turns."""
    found = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    parts = F.struct(F.split(text, rule.regex, -1).alias("between"), found.alias("found"),
                     (F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else found).alias("kept"))

    def spans(p: Column) -> Column:
        lengths = F.transform(p["found"], lambda m, i: F.length(p["between"][i]) + F.length(m))
        all_spans = _let(_starts(lengths), lambda before: F.transform(p["found"], lambda m, i: F.struct(
            (before[i] + F.length(p["between"][i])).alias("start"), F.lit(number).alias("rule"),
            (before[i] + F.length(p["between"][i]) + F.length(m)).alias("end"),
            (F.length(p["kept"][i]) >= rule.least).alias("ok"))))
        return F.transform(F.filter(all_spans, lambda s: s["ok"]), lambda s: F.struct(
            s["start"].alias("start"), s["rule"].alias("rule"), s["end"].alias("end")))
    return _let(parts, spans)


def scan(docs: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """The rows of ``docs`` with ``secrets``: array of (start, rule number, end) in order."""
    keyed = docs.withColumn(KEY, text_key(F.col("text")))
    index = cut(postings(docs, rules), "trigram-postings")
    joined = keyed.join(candidates(index, rules), KEY, "left")
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    each = []
    for n, rule in enumerate(rules):
        spans = _spans(F.coalesce(F.col("text"), F.lit("")), n, rule)
        runs = F.lit(True) if query(rule.regex) is None else F.array_contains(F.col(FOUND), n)
        each.append(F.when(runs, spans).otherwise(none))
    return joined.withColumn("secrets", F.array_sort(F.concat(*each))).drop(KEY, FOUND)


def joined_spans(secrets: Column, rules=DEFAULT_RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", kinds[s["rule"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """doc_id, matches of each base rule, digest of the base spans, all spans."""
    base = [n for n, r in enumerate(rules) if r.base]

    def count(n: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["rule"] == n)).cast("long")
    of_base = F.filter("secrets", lambda s: s["rule"].isin(base))
    return scan(docs, rules).select(
        "doc_id",
        *[count(n).alias(f"n_{rules[n].kind}") for n in base],
        F.sha2(joined_spans(of_base, rules), 256).alias("base_sha256"),
        joined_spans(F.col("secrets"), rules).alias("spans"))
