"""Line dedup: exact copies and near copies of lines, by deletion neighbourhoods.

A line is a ``\\n``-separated part of a text, trimmed of ASCII white space; its
words are its parts between single spaces.  Two lines are duplicates if they
are equal, or if both have at least ``min_words`` words and one word
inserted, deleted or replaced turns one into the other.  A line is dropped if
an earlier line, by (doc_id, text hash, line number), is its duplicate, whether
or not that one is itself dropped.

Method: equal lines collapse to their earliest place.  Lines with an edit of
one word agree in their first or second half, so only lines that share a half
with another line go on; this loses nothing.  Each of them emits every
deletion variant (the line less one word) as a hashed key: variants with the
same gap meet for a replaced word, variants and whole lines for an inserted
one.  A key's lines are compared with its earliest line only, never in pairs
with each other, since all lines with the same variant and gap are duplicates
of the earliest.  The word edit distance of each such pair is verified.

Variant hashes are made in one pass: the exclusive or of ``hash(word, place)``
before the gap and ``hash(word, place - 1)`` after it.

All of it is DataFrame code; there is no Python on the rows' path.

Edge cases: a null text stays null; lines without a word are never duplicates
and stay; null doc_ids are last in order; rows with equal doc_id are ordered by
text hash, and rows equal in both keep the same lines (none of them counts as
the other's earlier copy).  Texts and lines of any length are processed whole.
Clashing column names do no harm: columns are renamed for the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, known_small

MIN_WORDS = 10
SPACE = " \t\n\x0b\x0c\r"
#: Lists of ids (8 to 40 bytes a row) up to this many rows are broadcast.
SMALL_ROWS = 1_000_000


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, t, no, line) of every line with a word."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("t"),
                       F.posexplode(F.split(F.col(text), "\n")).alias("no", "raw"))
    return rows.select("doc_id", "t", "no", F.btrim("raw", F.lit(SPACE)).alias("line")).where("line <> ''").select(
        "*", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), F.col("line")).alias("k2"))


def _place() -> Column:
    return F.struct(F.isnull("doc_id").alias("last"), F.col("doc_id"), F.col("t"), F.col("no"))


def _halves() -> Column:
    """Keys that a line shares with any line one word away, from ``w`` and ``n``.

    Of two lines of n words that differ in one, the first n/2 or the other
    words agree.  Of a line of m + 1 words and one of m, either the first m/2
    words or the last m - m/2 agree.
    """
    def pair(m: Column) -> list[Column]:
        h = F.floor(m / 2).cast("int")
        tail = m - h
        return [F.xxhash64(F.lit(0), m, F.slice("w", F.lit(1), h)),
                F.xxhash64(F.lit(1), m, F.slice("w", F.col("n") - tail + 1, tail))]
    return F.array(*pair(F.col("n")), *pair(F.col("n") - 1))


def _one_word_apart(a: str, b: str) -> Column:
    """Whether the word lists ``a`` and ``b`` are within one edit: behind the
    first difference, the rest agrees."""
    na, nb = F.size(a), F.size(b)
    least = F.least(na, nb)
    differs = F.zip_with(F.slice(a, F.lit(1), least), F.slice(b, F.lit(1), least), lambda x, y: x != y)
    at = F.array_position(differs, True).cast("int")
    skip_a, skip_b = F.when(na >= nb, 1).otherwise(0), F.when(nb >= na, 1).otherwise(0)
    rest = lambda c, n, skip: F.slice(c, F.greatest(at + skip, F.lit(1)), n)
    return (F.abs(na - nb) <= 1) & ((at == 0) | (rest(a, na, skip_a) == rest(b, nb, skip_b)))


def near_lines(lines: DataFrame, distinct: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(k1, k2) of the distinct lines with an earlier line one word away."""
    halves = distinct.where(F.col("n") >= min_words).select("k1", F.explode("halves").alias("half"))
    shared = cut(halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half"), "lines-halves")
    chosen = cut(halves.join(known_small(shared, SMALL_ROWS), "half", "left_semi").select("k1").distinct(), "lines-chosen")

    # the chosen lines, numbered from the earliest on
    texts = lines.join(known_small(chosen, SMALL_ROWS), "k1", "left_semi").groupBy("k1", "k2").agg(
        F.min(_place()).alias("place"), F.any_value("line").alias("line"))
    texts = cut(texts.orderBy("place").select("k1", "k2", F.split("line", " ").alias("w"),
                                              F.monotonically_increasing_id().alias("r")), "lines-texts")

    words = texts.where(F.size("w") >= min_words).select("r", F.size("w").alias("n"), F.posexplode("w").alias("i", "word"))
    words = words.select("r", "n", "i", F.xxhash64("word", "i").alias("x"),
                         F.xxhash64(F.col("word"), F.col("i") - 1).alias("y"))
    run = Window.partitionBy("r").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("r")
    words = words.select("r", "n", "i", "x", F.bit_xor("x").over(run).alias("xs"), F.bit_xor("y").over(run).alias("ys"),
                         F.bit_xor("y").over(whole).alias("y_all"))
    before, after = F.col("xs").bitwiseXOR(F.col("x")), F.col("y_all").bitwiseXOR(F.col("ys"))
    gap = words.select("r", "n", "i", before.bitwiseXOR(after).alias("v"), "xs")
    variants = cut(gap.select("r", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.xxhash64(F.lit(0), F.col("n"), F.col("i"), F.col("v")).alias("key")),
        F.struct(F.lit(1).alias("kind"), F.xxhash64(F.lit(1), F.col("n") - 1, F.col("v")).alias("key")),
        F.when(F.col("i") == F.col("n") - 1, F.struct(
            F.lit(2).alias("kind"), F.xxhash64(F.lit(1), F.col("n"), F.col("xs")).alias("key"))))).alias("v"))
        .where("v IS NOT NULL").select("r", "v.kind", "v.key"), "lines-variants")

    first = variants.groupBy("key").agg(
        F.count("*").alias("c"), F.min(F.when(F.col("kind") == 0, F.col("r"))).alias("r0"),
        F.min(F.when(F.col("kind") == 1, F.col("r"))).alias("r1"),
        F.min(F.when(F.col("kind") == 2, F.col("r"))).alias("r2")).where("c > 1").drop("c")
    other = F.when(F.col("kind") == 0, F.col("r0")).when(F.col("kind") == 1, F.col("r2")).otherwise(F.col("r1"))
    pairs = variants.join(known_small(cut(first, "lines-first"), SMALL_ROWS), "key").select("r", other.alias("e")).where(
        "e < r").distinct()
    a, b = texts.select("r", "k1", "k2", F.col("w").alias("wa")), texts.select(F.col("r").alias("e"), F.col("w").alias("wb"))
    return pairs.join(a, "r").join(b, "e").where(_one_word_apart("wa", "wb")).select("k1", "k2").distinct()


def dropped_lines(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, t, exact, near): numbers of the dropped lines of each document
    that has any; ``t`` is the hash of its text."""
    lines = _lines(docs, text)
    sized = lines.select("*", F.split("line", " ").alias("w")).withColumn("n", F.size("w"))
    halves = F.when(F.col("n") >= min_words, _halves())
    distinct = cut(sized.select("k1", "k2", _place().alias("place"), "n", halves.alias("halves")).groupBy("k1", "k2").agg(
        F.min("place").alias("place"), F.count("*").alias("c"), F.any_value("n").alias("n"),
        F.any_value("halves").alias("halves")), "lines-distinct")
    near = cut(near_lines(lines, distinct, min_words), "lines-near").withColumn("near", F.lit(True))
    affected = distinct.join(near, ["k1", "k2"], "left").where("c > 1 OR near").select(
        "k1", "k2", "place", F.coalesce("near", F.lit(False)).alias("near"))
    found = lines.join(known_small(cut(affected, "lines-affected"), SMALL_ROWS), ["k1", "k2"]).select(
        "doc_id", "t", "no", "near", (_place() == F.col("place")).alias("earliest")).where("near OR NOT earliest")
    return found.groupBy("doc_id", "t").agg(
        F.collect_set(F.when(~F.col("earliest"), F.col("no"))).alias("exact"),
        F.collect_set(F.when(F.col("earliest"), F.col("no"))).alias("near"))


def dedup_lines(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its texts less the dropped lines; added after its columns:
    ``lines_exact`` and ``lines_near``, how many were dropped as which."""
    drop = dropped_lines(docs, text, min_words).select(
        F.col("doc_id").alias("x_id"), F.col("t").alias("x_t"), F.col("exact").alias("x_exact"), F.col("near").alias("x_near"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("d_id"), F.xxhash64(F.col(text)).alias("d_t"))
    out = rows.join(drop, F.expr("d_id <=> x_id AND d_t = x_t"), "left")
    # an explode of one element keeps the split from being made anew for each line
    parts = F.when(F.col("x_t").isNotNull(), F.split(F.col(f"row.{text}"), "\n"))
    out = out.select("row", "x_t", "x_exact", "x_near", F.explode(F.array(parts)).alias("parts"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.array_union("x_exact", "x_near"))
    cleaned = F.when(F.col("x_t").isNull(), F.col(f"row.{text}")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("parts", i)), "\n"))
    count = lambda c: F.when(F.col("x_t").isNull(), 0).otherwise(F.size(c)).cast("long")
    return out.select(*[(cleaned if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns],
                      count("x_exact").alias("lines_exact"), count("x_near").alias("lines_near"))
