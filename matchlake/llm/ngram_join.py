"""N-gram Jaccard join by a MinHash LSH forest.

Documents are sets of five-word shingles (a text of one to four words is one
shingle); a pair is linked if their Jaccard similarity is at least 0.8.

Method: equal word sequences collapse to one class.  Each class gets ``TREES``
signatures of eight one-byte min-hashes, packed into a long so that its leading
bytes are a prefix in that tree's sorted trie.  Starting from whole signatures,
the matched prefix is shortened, byte by byte, until the target recall is
reached.  Recall is taken from the data: a bounded sample of texts is compared
with all texts exactly, while those are signed; of the links found, the share
that meets in some tree, and the probability to meet at the links' own
similarities, must both reach the target (``depth_for``).  With few links to
judge by, they count as links just at the threshold.  Classes that meet are joined
to the least of their prefix, never in pairs, and the stars are contracted to
groups.  Each group is verified exactly: it is cut into blocks by hash, and a
task compares two blocks through products of their shingle incidence matrices.
It gives one row per class and pair of blocks (links counted, least linked
class), so the work on a group may grow with its square but its rows do not.
The links' components are the classes of near duplicates.

``n_links`` counts the other documents similar to a document, copies included.

Edge cases: a null or wordless text has no shingles, no links and a class of its
own.  Null doc_ids take part; a class is named by its least doc_id (null if it
has none).  Rows that repeat count as copies; of rows equal in id and text that
differ elsewhere ``deduplicate`` keeps the one of the least hash.  Texts are taken whole.  Only
``doc_id`` and ``text`` are read (``deduplicate`` returns the other columns
untouched).  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import number_words, releasing, row_blocks
from .common import cut, known_small
from .components import components

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH = 32, 8
RECALL = 0.9999          # for a pair just at the threshold
SAMPLE = 500             # texts that are compared with all texts, about
SAMPLE_BYTES = 4 << 20   # bytes of text they have, at most
FEW_LINKS = 50           # fewer links than this say too little about similarities
BLOCK = 512              # classes of a verified group that one side of a task holds, about
SMALL_ROWS = 1_000_000
COLUMNS = 4096           # shingles per matrix product
HASH_BYTES = 8 << 20      # text whose words are hashed together

_SEED = np.random.Generator(np.random.PCG64(20))
_MULT = _SEED.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _SEED.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The 64-bit hashes of each text's words in order; each distinct word is hashed once."""
    numbers, each, words = number_words(texts)
    of_word = np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))
    return np.split(of_word[numbers], np.cumsum(each)[:-1])


def shingles(h: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the ``width``-grams of words with hashes ``h``."""
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(h))):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(grams: np.ndarray) -> np.ndarray:
    """One long per tree; byte k from the top is the tree's k-th min-hash."""
    best = np.full(TREES * DEPTH, np.iinfo(np.uint64).max)
    for part in range(0, len(grams), 4096):
        g = grams[None, part:part + 4096]
        for j in range(0, TREES * DEPTH, 16):
            some = ((g ^ _FLIP[j:j + 16, None]) * _MULT[j:j + 16, None]).min(axis=1)
            np.minimum(best[j:j + 16], some, out=best[j:j + 16])
    # the low bits of a min-hash are as good as random; mix them into one byte
    best = (best ^ (best >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    byte = (best >> np.uint64(56)).reshape(TREES, DEPTH)
    shift = np.arange(56, -8, -8, dtype=np.uint64)
    return np.bitwise_or.reduce(byte << shift, axis=1).view(np.int64)


def meets(similarity, depth: int):
    """The probability that a pair meets in some tree by its first ``depth`` bytes."""
    return 1 - (1 - similarity ** depth) ** TREES


class Sample:
    """Texts to be compared with all others: their shingles, sorted, with owners."""

    def __init__(self, sets: list[np.ndarray], threshold: float):
        self.threshold = threshold
        self.sizes = np.array([len(g) for g in sets], np.int64)
        grams = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.grams, self.start = np.unique(grams[order], return_index=True)
        self.end = np.append(self.start[1:], len(order))

    def links(self, grams: np.ndarray) -> tuple[list[int], list[float]]:
        """Numbers of the sampled texts at the threshold or more, and their similarities."""
        if not len(self.grams) or not len(grams):
            return [], []
        at = np.searchsorted(self.grams, grams)
        inside = at < len(self.grams)
        at = at[inside][self.grams[at[inside]] == grams[inside]]
        if not len(at):
            return [], []
        many = self.end[at] - self.start[at]
        first = np.repeat(self.start[at] - np.cumsum(many) + many, many)
        common = np.bincount(self.owner[first + np.arange(len(first))], minlength=len(self.sizes))
        alike = common / (self.sizes + len(grams) - common)
        found = np.flatnonzero(alike >= self.threshold - 1e-9)
        return found.tolist(), alike[found].tolist()


def sample_of(docs: DataFrame, threshold: float) -> tuple[Sample, list[bytes]]:
    """A sample of the distinct texts by hash, and the digests of its words."""
    n = docs.count()
    width = 1 << 32
    few = docs.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(width)) < F.lit(int(width * min(1.0, SAMPLE / max(n, 1))) or 1))
    sizes = few.where("text IS NOT NULL").groupBy(F.xxhash64("text").alias("t")).agg(
        F.max(F.octet_length("text")).alias("n")).orderBy("t").limit(2 * SAMPLE).collect()
    picked, held = [], 0
    for r in sizes:
        if held + r.n <= SAMPLE_BYTES:
            picked.append(r.t)
            held += r.n
    texts = [r.text for r in few.where(F.xxhash64("text").isin(picked)).groupBy(F.xxhash64("text").alias("t")).agg(
        F.first("text").alias("text")).orderBy("t").collect()] if picked else []
    hashes = word_hashes(pa.array(texts, pa.string())) if texts else []
    return Sample([shingles(h) for h in hashes], threshold), [hashlib.md5(h.tobytes()).digest() for h in hashes]


def depth_for(classes: DataFrame, digests: list[bytes], threshold: float, recall: float) -> tuple[int, dict[int, float], int]:
    """(bytes of the prefix, recall by depth, sampled links): the longest prefix
    by which the sample's links meet as often as ``recall`` asks."""
    spark = classes.sparkSession
    own = {r.digest: r.sign for r in classes.where(F.col("digest").isin(digests)).select("digest", "sign").collect()} if digests else {}
    rows = [(i, bytearray(d), own[bytes(d)]) for i, d in enumerate(digests) if bytes(d) in own]
    expected = {d: float(meets(threshold, d)) for d in range(1, DEPTH + 1)}
    met, links = {d: 1.0 for d in expected}, 0
    if rows:
        sample = F.broadcast(spark.createDataFrame(rows, "i int, s_digest binary, s_sign array<long>"))     # SAMPLE rows
        pairs = classes.select("digest", "sign", F.explode(F.arrays_zip("alike", "alike_by")).alias("l")).select(
            "digest", "sign", F.col("l.alike").alias("i"), F.col("l.alike_by").alias("s")).join(sample, "i").where("digest <> s_digest")
        both = F.zip_with("sign", "s_sign", lambda a, b: a.bitwiseXOR(b))

        def met_at(d: int):
            return F.exists(both, lambda x: F.shiftrightunsigned(x, 8 * (DEPTH - d)) == 0) if d < DEPTH else F.exists(both, lambda x: x == 0)
        row = pairs.agg(F.count("*").alias("n"), *[F.count_if(met_at(d)).alias(f"met{d}") for d in expected],
                        *[F.sum(1 - F.pow(1 - F.pow("s", F.lit(float(d))), F.lit(float(TREES)))).alias(f"p{d}") for d in expected]).first()
        links = row.n
        if links:
            met = {d: row[f"met{d}"] / links for d in expected}
        if links >= FEW_LINKS:
            expected = {d: row[f"p{d}"] / links for d in expected}
    found = {d: min(met[d], expected[d]) for d in expected}
    depth = DEPTH
    while depth > 1 and found[depth] < recall:
        depth -= 1
    return depth, found, links


def _signed(sample: Sample):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_blocks(batches, "text", HASH_BYTES):
            digest, sizes, signs, alike, by = [], [], [], [], []
            for h in word_hashes(b["text"].combine_chunks()):
                grams = shingles(h)
                digest.append(hashlib.md5(h.tobytes()).digest())
                sizes.append(len(grams))
                signs.append(signature(grams) if len(grams) else None)
                of, s = sample.links(grams)
                alike.append(of)
                by.append(s)
            done = pa.table([b["doc_id"], b["t"], pa.array(digest, pa.binary()), pa.array(sizes, pa.int64()),
                             pa.array(signs, pa.list_(pa.int64())), pa.array(alike, pa.list_(pa.int32())),
                             pa.array(by, pa.list_(pa.float64()))],
                            names=["doc_id", "t", "digest", "grams", "sign", "alike", "alike_by"])
            yield from done.combine_chunks().to_batches()
    return run


def _verify(threshold: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """Links between the classes of two blocks of a group (or of one)."""
        one, other = key[1].as_py(), key[2].as_py()
        first: dict[int, int] = {}
        for i, n in enumerate(rows["node"].to_pylist()):
            first.setdefault(n, i)
        nodes = np.array(sorted(first), np.int64)
        pick = [first[n] for n in nodes.tolist()]
        block = rows["block"].to_numpy()[pick]
        copies = rows["copies"].to_numpy()[pick].astype(np.float64)
        sets = [shingles(h) for h in word_hashes(rows["text"].take(pick).combine_chunks())]
        size = np.array([len(s) for s in sets], np.float64)
        owner = np.repeat(np.arange(len(sets)), size.astype(np.int64))
        _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        wide = held[column] > 1                         # a shingle of one class is in no intersection
        owner, column = owner[wide], np.unique(column[wide], return_inverse=True)[1]
        left = np.flatnonzero(block == one)
        right = left if one == other else np.flatnonzero(block == other)
        common = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        ends = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + COLUMNS, COLUMNS))
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            m = np.zeros((len(sets), COLUMNS), np.float32)
            m[owner[a:b], column[a:b] - k * COLUMNS] = 1
            common += m[left] @ m[right].T
        union = size[left][:, None] + size[right][None, :] - common
        near = common >= threshold * union - 1e-6
        if one == other:
            np.fill_diagonal(near, False)
        links = np.zeros(len(nodes))
        links[left] += near @ copies[right]
        if one != other:
            links[right] += near.T @ copies[left]
        # least class reached through the links of this task
        root = np.arange(len(nodes))
        while True:
            low = root.copy()
            if len(left) and len(right):
                np.minimum.at(low, left, np.where(near, root[right][None, :], len(nodes)).min(axis=1))
                np.minimum.at(low, right, np.where(near, root[left][:, None], len(nodes)).min(axis=0))
            low = low[low]
            if np.array_equal(low, root):
                break
            root = low
        return pa.table({"node": nodes, "links": pa.array(links.astype(np.int64)), "root": nodes[root]})
    return run


def _classes(docs: DataFrame, sample: Sample) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, t, digest, grams) and classes of equal word sequences
    (node, digest, doc_id, t, copies, sign, and the sampled texts they are like), both written."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    rows = cut(slim.mapInArrow(releasing(_signed(sample)), "doc_id long, t long, digest binary, grams long, sign array<long>, "
                               "alike array<int>, alike_by array<double>"), "ngram-rows")
    first = F.min(F.struct(F.isnull("doc_id").alias("last"), F.col("doc_id"), F.col("t")))
    classes = rows.where("grams > 0").groupBy("digest").agg(
        first.alias("f"), F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in ("sign", "alike", "alike_by")])
    classes = cut(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "f.doc_id", "f.t", "copies",
                                 "sign", "alike", "alike_by"), "ngram-classes")
    return rows, classes


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, t, digest, grams) and, for each distinct text, (digest,
    doc_id, t, copies, links, class): its links to other texts' documents and
    the struct (doc_id, t) that names its class of near duplicates."""
    sample, digests = sample_of(docs, threshold)
    rows, classes = _classes(docs, sample)
    depth, _, _ = depth_for(classes, digests, threshold, recall)
    cut_at = (1 << 8 * (DEPTH - depth)) - 1
    prefixes = classes.select("node", F.posexplode("sign").alias("tree", "s")).select(
        "node", "tree", F.col("s").bitwiseAND(F.lit(~cut_at)).alias("prefix"))
    met = prefixes.groupBy("tree", "prefix").agg(F.min("node").alias("least"), F.max("node").alias("most")).where(
        "least < most").select("tree", "prefix", "least")
    stars = prefixes.join(known_small(cut(met, "ngram-prefixes"), SMALL_ROWS), ["tree", "prefix"]).select(
        F.col("node").alias("a"), F.col("least").alias("b"))
    groups = cut(components(stars, "ngram-stars"), "ngram-groups")

    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    placed = groups.join(sizes, "root").join(classes.select("node", "doc_id", "t", "copies"), "node").select(
        "root", "node", "doc_id", "t", "copies", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("block"))
    placed = cut(placed.select(F.col("doc_id").alias("p_id"), F.col("t").alias("p_t"), "root", "node", "copies", "block",
                               "blocks"), "ngram-placed")
    texts = docs.select(F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_t"), "text")
    # rows that repeat a class's document merge where they are read: each text goes to its blocks once
    texts = texts.join(known_small(placed, SMALL_ROWS), F.expr("d_id <=> p_id AND d_t = p_t")).groupBy(
        "root", "node", "copies", "block", "blocks").agg(F.any_value("text").alias("text")).select(
        "root", "node", "copies", "block", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("x"))
    cells = texts.select("root", F.least("block", "x").alias("one"), F.greatest("block", "x").alias("other"),
                         "node", "copies", "block", "text")
    checked = cut(cells.groupBy("root", "one", "other").applyInArrow(
        _verify(threshold), "node long, links long, root long"), "ngram-links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")), "ngram-linked")

    named = classes.join(linked, "node", "left").join(links, "node", "left").select(
        "digest", "doc_id", "t", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    heads = named.groupBy("root").agg(F.min(F.struct(
        F.isnull("doc_id").alias("last"), F.col("doc_id"), F.col("t"))).alias("head"))
    return rows.drop("sign", "alike", "alike_by"), named.join(heads, "root").select(
        "digest", "doc_id", "t", "copies", "links", F.struct("head.doc_id", "head.t").alias("class"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links."""
    rows, named = near_classes(docs, threshold, recall)
    found = named.select(F.col("digest").alias("n_digest"), "copies", "links", F.col("class.doc_id").alias("class_id"))
    return rows.join(found, F.expr("digest = n_digest AND grams > 0"), "left").select(
        "doc_id", F.when(F.col("n_digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` less all but one document of each class: that of the least
    (doc_id, text hash) stays; texts without shingles all stay."""
    rows, named = near_classes(docs, threshold, recall)
    heads = named.select(F.col("class.doc_id").alias("h_id"), F.col("class.t").alias("h_t")).distinct()
    heads = cut(heads.join(rows.where("grams > 0").groupBy(F.col("doc_id").alias("r_id"), F.col("t").alias("r_t")).agg(
        F.count("*").alias("h_n")), F.expr("h_id <=> r_id AND h_t = r_t")).select("h_id", "h_t", "h_n"), "ngram-heads")
    data = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_t"))
    empty = F.coalesce(F.length(F.btrim("row.text", F.lit(" \t\n\x0b\x0c\r"))), F.lit(0)) == 0
    kept = data.where(~empty).join(heads, F.expr("d_id <=> h_id AND d_t = h_t"))
    # rows that repeat a head are one document too
    if heads.where("h_n > 1").head(1):
        many = kept.where("h_n > 1").groupBy("d_id", "d_t").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        kept = kept.where("h_n = 1").select("row").unionAll(many.select("row"))
    return kept.select("row").unionAll(data.where(empty).select("row")).select("row.*")
