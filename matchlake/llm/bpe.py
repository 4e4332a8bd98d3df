"""BPE encoding and decoding through a distinct-word table.

White space never joins the pieces of two words in the vocabularies used here
(``word_bpe_49k``: white space is dropped, merges stay inside a word), so a
text's ids are its words' ids in order.  Tasks gather neighbouring documents
into blocks, split them into words and note, for each block, its distinct
words and every document as positions in that list.  The block lists are dealt
out by word hash; there each distinct word is encoded once and its ids go back
to the blocks.  A block then joins ids to its documents by position, and
decodes through the table of ids and pieces.

The blocks are computed twice (once for their words, once for the positions)
rather than stored; a digest of the word list travels with both halves and a
difference raises an error, so an input whose rows come in another order the
second time (not a table or file) is refused, never mis-encoded.

Edge cases: a null or blank text gives no ids and decodes to the empty text.
A text without white space is one word.  Rows are encoded one by one, so
repeated rows, ties and null ids are kept as they are.  Columns besides the
carried ones are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 16 << 20     # text of one block; a longer text is a block by itself
MAX_VOCABULARY = 1 << 20   # the id-to-piece table is sent to tasks up to this size
ENCODE_AT_ONCE = 512
SEPARATOR = "<|startoftext|>"
MARKS = ".,;:!?"           # each of these alone is one piece of a word


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@cache
def pieces(path: str) -> list[str]:
    """The id-to-piece table: bounded by the vocabulary, not by the data."""
    t = tokenizer(path)
    n = t.get_vocab_size(with_added_tokens=True)
    if n > MAX_VOCABULARY:
        raise ValueError(f"vocabulary of {n} is over {MAX_VOCABULARY}")
    return [t.id_to_token(i) for i in range(n)]


def _encode_apart(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As encode_words, for any words.  They are encoded many at a time with a
    special token between them; words that hold the token go alone."""
    t = tokenizer(path)
    mark = t.token_to_id(SEPARATOR)
    flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for k in range(0, len(words), ENCODE_AT_ONCE):
        part = words[k:k + ENCODE_AT_ONCE]
        if mark is None or any(SEPARATOR in w for w in part):
            for e in t.encode_batch_fast(part, add_special_tokens=False):
                flat.append(np.array(e.ids, np.uint32))
                counts.append(np.array([len(e.ids)]))
            continue
        ids = np.array(t.encode_batch_fast([SEPARATOR.join(part)], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(ids == mark)
        flat.append(np.delete(ids, cuts))
        counts.append(np.diff(cuts, prepend=-1, append=len(ids)) - 1)
    return np.concatenate(flat), np.concatenate(counts)


def _encode_letters(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As encode_words, for words of letters only: each ends with its only piece
    that has the word end, so they can be encoded with spaces between them."""
    t, last = tokenizer(path), word_ends(path)
    flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for k in range(0, len(words), ENCODE_AT_ONCE):
        part = words[k:k + ENCODE_AT_ONCE]
        ids = np.array(t.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(last[ids])
        if len(ends) != len(part):
            raise AssertionError("a word of letters is not one run of pieces")
        flat.append(ids)
        counts.append(np.diff(ends, prepend=-1))
    return np.concatenate(flat), np.concatenate(counts)


@cache
def word_ends(path: str) -> np.ndarray:
    """Whether each piece ends a word; empty if the vocabulary has no word ends
    or does not split letters from marks and put them in lower case."""
    made = json.loads(tokenizer(path).to_str())
    suffix, text = made["model"].get("end_of_word_suffix"), json.dumps(made["pre_tokenizer"])
    if not suffix or "[\\\\p{L}]+|" not in text or "Lowercase" not in json.dumps(made["normalizer"]):
        return np.zeros(0, bool)
    return np.array([p.endswith(suffix) for p in pieces(path)])


def encode_words(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another as uint32, number of ids of each).

    Words of letters, with or without one mark at the end, share the ids of
    their letters in lower case, which are encoded once; others go as they are.
    """
    if not len(word_ends(path)):
        return _encode_apart(path, words)
    cores: dict[str, int] = {}
    core, mark, other = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64), []
    for i, w in enumerate(words):
        m = MARKS.find(w[-1]) + 1
        letters = w[:-1] if m else w
        # two letters whose lower case depends on more than the letter
        if letters.isalpha() and "\u0130" not in letters and "\u03a3" not in letters:
            core[i], mark[i] = cores.setdefault(letters.lower(), len(cores)), m
        else:
            other.append(i)
    known = Runs(*_encode_letters(path, list(cores)))
    marks = np.concatenate([[0], _encode_apart(path, list(MARKS))[0]]).astype(np.uint32)
    rest_flat, rest_counts = _encode_apart(path, [words[i] for i in other])

    counts = np.zeros(len(words), np.int64)
    plain = np.flatnonzero(core >= 0)
    counts[plain] = known.counts[core[plain]] + (mark[plain] > 0)
    counts[other] = rest_counts
    ends = np.cumsum(counts)
    flat = np.empty(int(counts.sum()), np.uint32)
    filled = np.zeros(len(flat), bool)
    marked = plain[mark[plain] > 0]
    flat[ends[marked] - 1] = marks[mark[marked]]
    filled[ends[marked] - 1] = True
    of_other = np.zeros(len(words), bool)
    of_other[other] = True
    where = np.repeat(of_other, counts)
    flat[where] = rest_flat
    flat[~where & ~filled] = known.gather(core[plain])
    return flat, counts


def number_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word numbers of all texts one after another, words in each text, the
    distinct words by number); numbers follow first use."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, of = split.flatten(), pc.list_parent_indices(split)
    some = pc.not_equal(pc.binary_length(words), 0)
    coded = words.filter(some).dictionary_encode()
    each = np.bincount(of.filter(some).to_numpy(zero_copy_only=False), minlength=len(texts))
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32), each, coded.dictionary


class Runs:
    """Runs of ``counts`` neighbouring elements of ``flat``, fetched by number."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray):
        self.flat, self.counts = flat, counts
        self.starts = np.cumsum(counts) - counts

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The runs with the numbers ``at``, one after another."""
        n = self.counts[at]
        shift = self.starts[at] - (np.cumsum(n) - n)
        return self.flat[np.repeat(shift, n) + np.arange(int(n.sum()))]


def joined(parts: pa.Array, counts: np.ndarray) -> pa.Array:
    """Strings of ``counts`` neighbouring ``parts`` each, set apart by spaces."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(offsets, parts), " ")


def release() -> None:
    """Give freed memory back to the system, for the sake of other workers and
    of the executor: an idle worker would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving its memory back when a task ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return task


def row_blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Neighbouring rows with up to ``limit`` bytes of text; where blocks end
    follows from the rows alone, not from how they came in batches."""
    parts: list[pa.RecordBatch] = []
    held = 0
    for b in batches:
        start = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(b[text]), 0).to_pylist()):
            if (parts or i > start) and held + n > limit:
                yield pa.Table.from_batches([*parts, b.slice(start, i - start)]).combine_chunks()
                parts, start, held = [], i, 0
                release()
            held += n
        parts.append(b.slice(start))
    if any(p.num_rows for p in parts):
        yield pa.Table.from_batches(parts).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    c = table[name]
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int, buckets: int):
    """(block id, rows, word positions, words of each row, distinct words by
    bucket, first position of each bucket and the end, digest) of each block."""
    part = TaskContext.get().partitionId() << 32
    for ordinal, table in enumerate(row_blocks(batches, "bpe_text", limit)):
        numbers, each, words = number_words(_column(table, "bpe_text"))
        words = words.cast(pa.binary()).to_pylist()
        bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        listed = [words[i] for i in order.tolist()]
        yield (part + ordinal, table, rank[numbers], each, listed,
               np.searchsorted(bucket[order], np.arange(buckets + 1)), hashlib.md5(b" ".join(listed)).digest())


def _pack(numbers: np.ndarray) -> bytes:
    """Byte planes of numbers under 2**32, compressed (small numbers leave empty planes)."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, "<u4")
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encode_decode(docs: DataFrame, path: str, carried: list[str], finish: Callable[[np.ndarray, str], tuple],
                  finished: str, text: str = "text", buckets: int | None = None,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Encode ``text`` of every row, decode the ids again, and return the
    ``carried`` columns with those of ``finish(ids, decoded)``, whose DDL is
    ``finished``; ids come as little-endian uint32.

    Needs a vocabulary whose pieces never cross white space and whose decoder
    sets pieces apart by one space (tokenizers: decoder null).
    """
    if json.loads(tokenizer(path).to_str())["decoder"] is not None:
        raise ValueError("this vocabulary's decoder is not a join of pieces by spaces")
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(carried))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, names)], F.col(text).alias("bpe_text"))
    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words, starts, digest in _blocks(batches, block_bytes, buckets):
            some = np.flatnonzero(np.diff(starts)).tolist()
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(some, pa.int32()),
                "block": pa.array([block] * len(some), pa.int64()),
                "digest": pa.array([digest] * len(some), pa.binary()),
                "words": pa.array([b" ".join(words[starts[k]:starts[k + 1]]).decode() for k in some], pa.string())})

    def encode_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = encoded(table)
        release()
        return out

    def encoded(table: pa.Table) -> pa.Table:
        """Encode a bucket's distinct words once and give each block the ids of its own."""
        numbers, each, words = number_words(_column(table, "words"))
        ids = Runs(*encode_words(path, words.to_pylist()))
        of_block = np.split(numbers, np.cumsum(each)[:-1])
        return pa.table({
            "block": table["block"], "bucket": table["bucket"], "digest": table["digest"],
            "n": pa.array(each, pa.int32()),
            "lengths": pa.array([_pack(ids.counts[x]) for x in of_block], pa.binary()),
            "total": pa.array([int(ids.counts[x].sum()) for x in of_block], pa.int32()),
            "ids": pa.array([_pack(ids.gather(x)) for x in of_block], pa.binary())})

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, numbers, each, _, _, digest in _blocks(batches, block_bytes, buckets):
            n = len(each)
            packed = [_pack(x) for x in np.split(numbers, np.cumsum(each)[:-1])]
            out = pa.table([*(table[c] for c in names), pa.array([block] * n, pa.int64()),
                            pa.array([digest] * n, pa.binary()), pa.array(each, pa.int64()),
                            pa.array(packed, pa.binary())], names=[*names, "block", "digest", "n", "at"])
            yield from out.combine_chunks().to_batches(max_chunksize=2000)

    out_ddl = ", ".join(x for x in (kept, finished) if x)
    fields = to_arrow_schema(spark.createDataFrame([], out_ddl).schema)

    def join_back(key: tuple[pa.Scalar, ...], docs_of: pa.Table, ids: pa.Table) -> pa.Table:
        out = joined_back(docs_of, ids)
        release()
        return out

    def joined_back(docs_of: pa.Table, ids: pa.Table) -> pa.Table:
        """Ids and pieces of a block's words, strung together by position for its documents."""
        seen = set(ids["digest"].to_pylist()) or {hashlib.md5(b"").digest()}
        if docs_of.num_rows and {*docs_of["digest"].to_pylist()} != seen:
            raise RuntimeError("a block's rows came in another order the second time: encode from a table or file")
        listed = sorted(ids.select(["bucket", "n", "lengths", "total", "ids"]).to_pylist(), key=lambda r: r["bucket"])
        counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(r["lengths"], r["n"]) for r in listed)]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, "<u4"), *(_unpack(r["ids"], r["total"]) for r in listed)]).astype("<u4")
        piece = pa.array(pieces(path), pa.string())
        word_text = joined(piece.take(pa.array(flat)), counts)      # the id-to-piece join
        runs = Runs(flat, counts)
        out: list[list] = [[] for _ in finished_fields]
        for n, data in zip(docs_of["n"].to_pylist(), docs_of["at"].to_pylist()):
            at = _unpack(data, n)
            at = at[counts[at] > 0]         # a word without ids (of exotic white space) leaves no gap
            decoded = joined(word_text.take(pa.array(at)), np.array([len(at)]))[0].as_py()
            for c, v in zip(out, finish(runs.gather(at), decoded)):
                c.append(v)
        done = [pa.array(c, f.type) for c, f in zip(out, finished_fields)]
        return pa.table([*(docs_of[c] for c in names), *done], names=fields.names).cast(fields)

    finished_fields = list(fields)[len(names):]
    ids = rows.select("bpe_text").mapInArrow(releasing(lists), "bucket int, block long, digest binary, words string").groupBy(
        "bucket").applyInArrow(encode_bucket, "block long, bucket int, digest binary, n int, lengths binary, "
                                              "total int, ids binary")
    placed = rows.mapInArrow(releasing(positions), ", ".join(x for x in (kept, "block long, digest binary, n long, at binary") if x))
    out = placed.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(join_back, out_ddl)
    rest = out.columns[len(names):]
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carried)], *rest)


def digests(ids: np.ndarray, decoded: str) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def ids_and_digests(ids: np.ndarray, decoded: str) -> tuple:
    n, ids_hash, text_hash = digests(ids, decoded)
    return n, ids.astype(np.int32), ids_hash, text_hash


IDS_AND_DIGESTS = "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
