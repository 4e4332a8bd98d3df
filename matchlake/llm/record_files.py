"""Token-id record files: length-delimited binary records with an offset index.

A record is ``length (u64) | masked CRC-32C of the length bytes (u32) | payload |
masked CRC-32C of the payload (u32)``, all little-endian, the mask being a
rotation by 15 bits plus 0xa282ead8: the framing of TFRecord files.  A payload is one document's sequence:
``doc_id (i64) | flags (u8) | ids``, ids being u16 if the vocabulary fits, else
u32 (flag 1); flag 2 marks a null doc_id.  Beside each ``shard-P-S.rec`` lies
``shard-P-S.idx``: for each record its offset (u64) and length (u64), so that
single records can be fetched in any order.

Documents are dealt out by ranges of doc_id; each task encodes its range and
rolls files at ``ROLL_BYTES``.  Files appear under their names only when
complete, and a repeated task writes the same bytes.

Edge cases: a null text is an empty sequence (only the end id).  Null doc_ids
come first.  Rows with equal doc_id are ordered by text; equal rows are all
written.  Texts are encoded whole, whatever their length.  Other columns are
not read.  An empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .bpe import Runs, encode_words, number_words, releasing, row_blocks, tokenizer
from .common import cut, open_fs, whole_file
from .crc32c import crc32c

ROLL_BYTES = 64 << 20
ENCODE_BYTES = 24 << 20   # text whose distinct words are encoded together
READ_BYTES = 4 << 20
TIE_CHARS = 32        # of a text, that set apart rows of one id
FRAME_AT_ONCE = 1000      # records whose checksums are taken together
MASK = 0xA282EAD8         # fixed value
HEAD, PREFIX = struct.Struct("<QI"), struct.Struct("<qB")
MANIFEST = "part int, seq int, path string, records long, ids long, bytes long"

def masked(strings: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each string."""
    c = crc32c(strings)
    return ((c >> np.uint32(15)) | (c << np.uint32(17))) + np.uint32(MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """The framed record of each payload."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    first, last = masked(heads).astype("<u4"), masked(payloads).astype("<u4")
    return [h + a.tobytes() + p + b.tobytes() for h, a, p, b in zip(heads, first, payloads, last)]


def unframe(records: list[bytes]) -> list[bytes]:
    """The payload of each framed record; ValueError if a checksum disagrees."""
    payloads = [r[HEAD.size:-4] for r in records]
    heads = [r[:8] for r in records]
    if any(len(r) < HEAD.size + 8 or HEAD.unpack_from(r)[0] != len(p) for r, p in zip(records, payloads)):
        raise ValueError("damaged record")
    first = np.frombuffer(b"".join(r[8:HEAD.size] for r in records), "<u4")
    last = np.frombuffer(b"".join(r[-4:] for r in records), "<u4")
    if (first != masked(heads)).any() or (last != masked(payloads)).any():
        raise ValueError("damaged record")
    return payloads


def sequences(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """(doc_id, ids) of each row, some megabytes of text at a time; the words
    of each part are numbered and each distinct one is encoded once."""
    for table in row_blocks(batches, "text", ENCODE_BYTES):
        numbers, each, words = number_words(table["text"].combine_chunks())
        ids = Runs(*encode_words(path, words.to_pylist()))
        ends = np.cumsum(each)
        yield [(doc_id, ids.gather(numbers[a:b])) for doc_id, a, b in zip(
            table["doc_id"].to_pylist(), (ends - each).tolist(), ends.tolist())]


def _records(batches: Iterator[pa.RecordBatch], path: str, end_id: int, narrow: bool) -> Iterator[tuple[bytes, int]]:
    """(framed record, number of ids) of each row."""
    for part in sequences(batches, path):
        for k in range(0, len(part), FRAME_AT_ONCE):
            some = [(i, np.append(ids, np.uint32(end_id))) for i, ids in part[k:k + FRAME_AT_ONCE]]
            yield from zip(frame([_payload(i, ids, narrow) for i, ids in some]), [len(ids) for _, ids in some])


def write_records(docs: DataFrame, folder: str, path: str, end_id: int = 1) -> DataFrame:
    """Write all documents below ``folder`` in ascending doc_id order; the
    manifest, a row for each file in that order."""
    narrow = tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        rows = _records(batches, path, end_id, narrow)
        row = next(rows, None)
        while row is not None:
            name = f"{folder}/shard-{part:06d}-{seq:05d}"
            index, at, ids = [], 0, 0
            with whole_file(name + ".rec") as out:
                while row is not None and at < ROLL_BYTES:
                    record, tokens = row
                    out.write(record)
                    index += [at, len(record)]
                    at, ids = at + len(record), ids + tokens
                    row = next(rows, None)
            with whole_file(name + ".idx") as out:
                out.write(np.array(index, "<u8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "path": [name + ".rec"], "records": [len(index) // 2], "ids": [ids], "bytes": [at]})
            seq += 1

    # rows of one id, null too, are dealt out by the beginning of their text, which keeps their order
    by_id = F.col("doc_id").asc_nulls_first()
    dealt = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(by_id, F.left("text", F.lit(TIE_CHARS)))
    ordered = dealt.sortWithinPartitions(by_id, "text")
    return cut(ordered.mapInArrow(releasing(write), MANIFEST), "records-manifest")


def with_starts(manifest: DataFrame, width: int = 1000) -> DataFrame:
    """``manifest`` plus ``start``, the ids in all files before; sums of
    ``width`` writing tasks at a time, then over those sums."""
    groups = manifest.withColumn("g", F.floor(F.col("part") / F.lit(width)))
    before = groups.groupBy("g").agg(F.sum("ids").alias("s")).withColumn(
        "before", F.sum("s").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, 0)) - F.col("s"))
    inside = F.sum("ids").over(Window.partitionBy("g").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, 0))
    return groups.withColumn("inside", inside - F.col("ids")).join(before.select("g", "before"), "g").select(
        *manifest.columns, (F.col("inside") + F.col("before")).alias("start"))


def _payload(doc_id: int | None, ids: np.ndarray, narrow: bool) -> bytes:
    flags = (0 if narrow else 1) | (2 if doc_id is None else 0)
    return PREFIX.pack(doc_id or 0, flags) + ids.astype("<u2" if narrow else "<u4").tobytes()


def _sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = PREFIX.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 1 else "<u2", offset=PREFIX.size)
    return (None if flags & 2 else doc_id), ids.astype("<u4")


def read_records(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every record of the files: doc_id, start, n_tokens, ids_crc32 and, if
    ``with_ids``, ids.  Checksums are verified."""
    spark: SparkSession = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist()):
                store, at = open_fs(path)
                with store.open_input_file(at[:-4] + ".idx") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
                with store.open_input_stream(at) as f:
                    # neighbouring records, some megabytes at a time
                    for some in np.split(index, np.flatnonzero(np.diff(index[:, 0] // READ_BYTES)) + 1):
                        data = memoryview(f.read(int(some[:, 1].sum())))
                        out: dict[str, list] = {c: [] for c in ("doc_id", "start", "n_tokens", "ids_crc32", "ids")}
                        for payload in unframe([data[a:a + n] for a, n in (some - [some[0, 0], 0]).tolist()]):
                            doc_id, ids = _sequence(payload)
                            for c, v in zip(out, (doc_id, start, len(ids), zlib.crc32(ids), ids if with_ids else None)):
                                out[c].append(v)
                            start += len(ids)
                        cols = [pa.array(out[c], pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
                        cols += [pa.array(out["ids"], pa.list_(pa.int32()))] * with_ids
                        yield pa.RecordBatch.from_arrays(cols, list(out)[:len(cols)])

    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return with_starts(manifest).select("path", "start").repartition(files).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def offset_index(manifest: DataFrame) -> DataFrame:
    """(path, record, offset, length) of every record, from the index files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["path"].to_pylist():
                store, at = open_fs(path)
                with store.open_input_file(at[:-4] + ".idx") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
                n = len(index)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array(np.arange(n)), pa.array(index[:, 0]), pa.array(index[:, 1])],
                    ["path", "record", "offset", "length"])

    return manifest.select("path").mapInArrow(read, "path string, record long, offset long, length long")


def read_shuffled(manifest: DataFrame, seed: int) -> DataFrame:
    """(place, doc_id, ids) in an order drawn from ``seed``: the index is dealt
    out by random place, and each task fetches its records by offset."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for place, path, offset, length in zip(*(b[c].to_pylist() for c in ("place", "path", "offset", "length"))):
                store, at = open_fs(path)
                with store.open_input_file(at) as f:
                    f.seek(offset)
                    found.append((place, f.read(length)))
            read = [_sequence(p) for p in unframe([r for _, r in found])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([x for x, _ in read], pa.int64()),
                 pa.array([x for _, x in read], pa.list_(pa.int32()))], ["place", "doc_id", "ids"])

    index = offset_index(manifest).withColumn("place", F.xxhash64(F.lit(seed), "path", "record"))
    return index.repartitionByRange("place").sortWithinPartitions("place", "path", "record").mapInArrow(
        fetch, "place long, doc_id long, ids array<int>")
