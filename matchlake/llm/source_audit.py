"""How far the sources of a language differ in their words.

Every kept term of a language (in at least ``LEAST_DOCS`` of its documents) has
a row: its nonzero counts by source.  A source's share of a term is a whole
number, ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``, with N the
source's occurrences of kept terms and V the number of kept terms.  Two sources
differ by the sum of ``|p - q|`` over all kept terms.

Most counts are zero, so the sum is built from corrections to the case that
both sources hold nothing (``V * |p0 - q0|``):

* a term that one source holds moves the pair from ``|p0 - q0|`` to
  ``|p - q0|``.  That depends on the other source by ``q0`` alone, so running
  sums over the source's shares in order answer it for all other sources;
* a term that both hold needs a correction for the pair.  Those come from a
  frequent-pattern tree: a term's row, (source, share) by source, is a path;
  equal rows are one path with a multiplicity; paths are sorted across the
  cluster, and a task walks its stretch with a stack.  When a node is left, its
  multiplicity is known, and it adds one correction for each of its ancestors,
  however many terms share the path.  A path prefix that two tasks share is a
  node in each; their sums add up.

Words are counted inside the scan tasks and combined before the shuffle; term
rows are keyed by (language, term), paths by their content, so neither a hot
source nor a hot language gathers in a task.  Pairs of sources are as many as the
result has rows.  Sums are longs: exact below about two thousand million kept
terms of a language.

Edge cases: null text, lang and source count as ''.  Rows that repeat count each
time.  A group without terms takes part in ``pair`` with counts of zero; a
language without kept terms has pairs of value 0 and no terms; a language with
one source has no pairs.  Texts are counted whole, in pieces of bounded size.
Ties go to the smaller item by UTF-8.  An empty table gives no rows.  Columns
other than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

LEAST_DOCS = 30
TOP_TERMS = 50
PRIOR = 5
SCALE = 1_000_000_000

#: Distinct (source, term) entries that a task holds before it hands them on.
HELD = 200_000
#: Pair sums that a task holds before it hands them on.
SUMS = 2_000_000
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Parts that the pairs of a language are dealt to.
PARTS = 16

COUNTS = "lang string, source string, term string, n long, docs long"
SUMMED = "lang string, a int, b int, value long"

# a term is a run of ASCII letters and non-ASCII bytes; capitals A-Z become small, all else a space
_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(c if c in _LETTERS else 0x20 for c in range(256)).lower()


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    text = text.translate(_FOLD)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE else text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.record_batch({
                "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array(n.values(), pa.int64()), "docs": pa.array([docs[t] for t in terms], pa.int64())})
        held.clear()

    for batch in batches:
        langs, sources, texts = (batch.column(c) for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            pieces = words(text.as_buffer().to_pybytes())
            first = next(pieces, [])
            n.update(first)
            seen = set(first)
            for piece in pieces:
                n.update(piece)
                seen.update(piece)
            docs.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from hand_on()
    yield from hand_on()


def term_rows(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, lang_n, cells): the kept terms with their counts by source."""
    counts = docs.mapInArrow(_count, COUNTS)
    # one shuffle: rows of a term together, then its sources, then the term
    by_source = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("cells")).where(F.col("docs") >= least_docs).drop("docs")


def _share(count: str, total: str, terms: str) -> Column:
    """p of a count, exact; null where no term is kept."""
    return F.when(F.col(terms) > 0, F.expr(
        f"1 + (CAST({count} + {PRIOR} AS DECIMAL(20,0)) * CAST({SCALE} AS DECIMAL(10,0)))"
        f" div CAST({total} + {PRIOR} * {terms} AS DECIMAL(20,0))").cast("long"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the pairs on the paths, which come in order."""
    stack: list[np.ndarray] = []       # of each node on the path to the last row: source, share, share of nothing
    times: list[int] = []              # terms below each node
    sums: dict[int, np.ndarray] = {}   # of a source: its correction with every source before it
    lang: str | None = None

    def leave(depth: int) -> None:
        while len(stack) > depth:
            b, p, p0 = stack.pop().tolist()
            m = times.pop()
            if not stack:
                continue
            times[-1] += m
            above = np.array(stack)
            a, q, q0 = above[:, 0], above[:, 1], above[:, 2]
            if b not in sums:
                sums[b] = np.zeros(b, np.int64)
            sums[b][a] += m * (np.abs(q - p) - np.abs(q - p0) - np.abs(p - q0) + np.abs(q0 - p0))

    def hand_on() -> Iterator[pa.RecordBatch]:
        for b, values in sums.items():
            a = np.nonzero(values)[0]
            yield pa.record_batch({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a.astype(np.int32)),
                                   "b": pa.array(np.full(len(a), b, np.int32)), "value": pa.array(values[a])})
        sums.clear()

    for batch in batches:
        path = batch.column("path")
        flat = path.flatten()
        nodes = np.stack([flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("idx", "p", "p0")], axis=1)
        ends = np.cumsum([0, *path.value_lengths().to_pylist()])
        for i, (row_lang, m) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("times").to_pylist())):
            own = nodes[ends[i]:ends[i + 1]]
            if row_lang != lang:
                leave(0)
                yield from hand_on()
                lang = row_lang
            shared = 0
            while shared < min(len(stack), len(own)) and (stack[shared] == own[shared]).all():
                shared += 1
            leave(shared)
            stack += list(own[shared:])
            times += [0] * (len(own) - shared)
            times[-1] += m
            if sum(map(len, sums.values())) > SUMS:
                yield from hand_on()
    leave(0)
    yield from hand_on()


def tree_corrections(cells: DataFrame) -> DataFrame:
    """(lang, a, b, value) for sources a before b that share terms; a pair may have several rows."""
    paths = cells.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("idx", "p", "p0"))).alias("path")) \
                 .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    return paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").mapInArrow(_walk, SUMMED)


def _one_sided(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, a, b, value): terms that a holds, as if b held none of them."""
    held = cells.groupBy("lang", F.col("idx").alias("a"), F.col("p").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    asked = pairs.where("p0 IS NOT NULL").select("lang", "a", F.col("q0").alias("x"), F.lit(0).cast("long").alias("n"), "b", "p0")
    rows = held.withColumns({"b": F.lit(None).cast("int"), "p0": F.lit(None).cast("long")}).unionByName(asked)
    all_rows = Window.partitionBy("lang", "a")
    below = all_rows.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    s = rows.select("lang", "a", "b", "x", "p0",
                    F.sum("n").over(below).alias("n_below"), F.sum(F.col("n") * F.col("x")).over(below).alias("sum_below"),
                    F.sum("n").over(all_rows).alias("n_all"), F.sum(F.col("n") * F.col("x")).over(all_rows).alias("sum_all"))
    return s.where("b IS NOT NULL").select("lang", "a", "b", F.expr(
        "x * n_below - sum_below + (sum_all - sum_below) - x * (n_all - n_below) - n_all * abs(p0 - x)").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language the
    other sources by distance (``pair``) and the terms it has most in excess of
    its language (``term``)."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    rows = cut(term_rows(docs, least_docs), "audit-terms")
    flat = rows.select("lang", "term", "lang_n", F.explode("cells").alias("c")).select("lang", "term", "lang_n", "c.source", "c.n")
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left") \
                 .na.fill(0, ["total", "v", "lang_total"]).withColumn("none", F.lit(0))
    groups = cut(groups.select(
        "lang", "source", "total", "v", "lang_total", _share("none", "total", "v").alias("p0"),
        F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("idx")), "audit-groups")

    cells = cut(flat.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "idx", "p0", _share("n", "total", "v").alias("p"),
        _share("lang_n", "lang_total", "v").alias("q")), "audit-cells")

    one = groups.select("lang", F.col("source"), F.col("idx").alias("a"), "p0", "v",
                        F.pmod(F.xxhash64("source"), F.lit(PARTS)).alias("part"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("b"), F.col("p0").alias("q0"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part"))
    pairs = one.join(other, ["lang", "part"]).where("a <> b")
    nothing = F.coalesce(F.col("v") * F.abs(F.col("p0") - F.col("q0")), F.lit(0))
    corrections = tree_corrections(cells).unionByName(_one_sided(cells, pairs))
    both_ways = corrections.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "value").select("lang", "p.a", "p.b", "value")
    pair = pairs.select("lang", "a", "b", nothing.alias("value"), "source", "item").unionByName(
        both_ways, allowMissingColumns=True).groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.max("source").alias("source"), F.max("item").alias("item"))
    term = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")).unionByName(
        term.withColumn("rank", rank).where(F.col("rank") <= top_terms)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
