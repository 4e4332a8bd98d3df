"""WARC archives: writing with revisit records, and reading in parallel blocks.

Writing: every row becomes one WARC/1.1 record whose block is an HTTP message
with the page as payload.  Of records with equal payloads of at least
``min_revisit`` bytes, the one with the largest id is a response and the
others are revisits, which keep the HTTP head and name the response.

Reading: an archive is cut into blocks.  A task looks for the magic line at
the start of its block's records and emits each candidate with the offset of
its successor (end of record by Content-Length).  Payloads may hold whole WARC
records, so candidates are not trusted: a block's chains are followed to where
they leave the block, and pointer jumping from the start of each file, doubling
the stride each round, keeps the entries that are reached.  Only records on the
chain from an entry are read.  Heads may have any length.  If the files come
with their numbers of records (a manifest), an archive whose chain holds another
number is an error.  Equal payloads are told by SHA-1 and length.

Edge cases: a null payload is empty; a null URL leaves out WARC-Target-URI;
control characters in a URL are percent-encoded.  A null id is smaller than
any other and is written as ``null``.  Rows that tie on the largest id are all
responses.  Empty table: no files, no records.  A file that does not begin
with the magic, or a record cut short, ends its chain there (an error if the number
of records is given).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, open_fs, whole_file

MAGIC = b"WARC/1.1\r\n"          # fixed value
END = b"\r\n\r\n"
MIN_REVISIT = 1000
ROLL_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20
READ_ON = 1 << 16                 # bytes first read past a block; more as a head needs them
ID = "urn:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
FIELDS = {b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-payload-digest", b"warc-target-uri",
          b"content-length"}
MANIFEST = "path string, records long, bytes long"
RECORD = ("path string, offset long, record_type string, id string, refers_to string, url string, "
          "payload_bytes long, payload_digest string, payload binary")


def _record(page_id, url, payload: bytes, sha1: str, size: int, refers: tuple | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [f"WARC-Type: {'response' if refers is None else 'revisit'}",
            f"WARC-Record-ID: <{ID}{'null' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers is not None:
        head += [f"WARC-Refers-To: <{ID}{refers[0]}>", f"WARC-Profile: {REVISIT}"]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return MAGIC + "\r\n".join(head).encode() + END + http + payload + END


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; the manifest of files."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"),
                        F.sha1(body).alias("sha1"), F.octet_length(body).cast("long").alias("size"))
    # only payloads that occur again: their number is known before the join is planned
    again = cut(rows.where(F.col("size") >= min_revisit).groupBy("sha1", "size").agg(
        F.count("*").alias("n"), F.max("id").alias("first_id")).where("n > 1 AND first_id IS NOT NULL")
        .select(F.col("sha1").alias("a_sha1"), F.col("size").alias("a_size"), "first_id"), "warc-again")
    told = rows.join(again, F.expr("sha1 = a_sha1 AND size = a_size"), "left").select(
        "id", "url", "body", "sha1", "size",
        F.when(~F.col("id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        rows = (x for b in batches for x in zip(*(b[c] for c in ("id", "url", "body", "sha1", "size", "refers"))))
        row = next(rows, None)
        while row is not None:
            path, n, size = f"{folder}/part-{part:06d}-{seq:05d}.warc", 0, 0
            with whole_file(path) as out:
                while row is not None and size < ROLL_BYTES:
                    page_id, link, data, sha1, length, refers = (x.as_py() for x in row)
                    record = _record(page_id, link, data, sha1, length, None if refers is None else (refers,))
                    out.write(record)
                    n, size = n + 1, size + len(record)
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})
            seq += 1

    return cut(told.mapInArrow(write, MANIFEST), "warc-manifest")


def _head(f, data: bytes, at: int) -> tuple[bytes, dict[bytes, tuple[int, bytes]] | None, int]:
    """Walk the head whose magic is at ``data[at]``, reading on from ``f`` (which
    stands at the end of ``data``) until it ends: the data, the place and value
    of each of ``FIELDS`` and the start of the block.  The fields are None if
    this is no head; the last value is then where it broke."""
    fields: dict[bytes, tuple[int, bytes]] = {}
    step, at = READ_ON, at + len(MAGIC)
    seen = at
    while True:
        stop = data.find(b"\r\n", seen)
        if stop < 0:
            more = f.read(step)
            if not more:
                return data, None, len(data)
            seen, step = max(at, len(data) - 1), 2 * step
            data += more
            continue
        if stop == at:
            return data, fields, stop + 2
        name, colon, value = data[at:stop].partition(b":")
        if not colon:
            return data, None, at
        if (name := name.strip().lower()) in FIELDS:
            fields[name] = at, value.strip()
        at = seen = stop + 2


def _heads(f, data: bytes, limit: int) -> Iterator[tuple[int, int]]:
    """(place, start of the next record) of each place before ``data[limit]``
    where a record can begin.  Magics inside a walked head share its end, and
    none up to a broken line begins a record: every line is walked once."""
    fields, over = None, 0
    k = data.find(MAGIC)
    while 0 <= k < limit:
        if (first := k + len(MAGIC)) > over:
            data, fields, over = _head(f, data, k)
        if (to := _next(fields, over, first)) is not None:
            yield k, to
        k = data.find(MAGIC, k + 1)


def _next(fields: dict[bytes, tuple[int, bytes]] | None, block: int, first: int) -> int | None:
    """Start of the record after the one whose lines begin at ``first``, if it is one."""
    none = -1, b""
    at, length = (fields or {}).get(b"content-length", none)
    kind, _ = (fields or {}).get(b"warc-type", none)
    return block + int(length) + 4 if min(at, kind) >= first and length.isdigit() else None


def _blocks_of(files: DataFrame, block_bytes: int) -> DataFrame:
    """(path, bytes, block) for each block of each file, spread over tasks."""
    spark = files.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / F.lit(block_bytes)))).alias("block")).repartition(n)


def candidates(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, bytes, offset, successor, leaves, records) of every place that
    looks like a record; ``leaves`` is where its chain first passes the end of
    its block (null if the chain breaks inside it), after so many records."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, block in zip(*(b[c].to_pylist() for c in ("path", "bytes", "block"))):
                start, stop = block * block_bytes, min(size, (block + 1) * block_bytes)
                store, at = open_fs(path)
                with store.open_input_file(at) as f:
                    f.seek(start)
                    data = f.read(stop - start + READ_ON)
                    follow = {start + k: start + to for k, to in _heads(f, data, stop - start) if start + to <= size}
                leaves: dict[int, int | None] = {}
                records: dict[int, int] = {}
                for k in sorted(follow, reverse=True):
                    to = follow[k]
                    leaves[k] = to if to >= stop else leaves.get(to)
                    records[k] = 1 + records.get(to, 0)
                n = len(follow)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array([size] * n, pa.int64()),
                     pa.array(list(follow), pa.int64()), pa.array(list(follow.values()), pa.int64()),
                     pa.array([leaves[k] for k in follow], pa.int64()),
                     pa.array([records[k] for k in follow], pa.int64())],
                    ["path", "bytes", "offset", "successor", "leaves", "records"])

    return _blocks_of(files, block_bytes).mapInArrow(
        find, "path string, bytes long, offset long, successor long, leaves long, records long")


def reached_entries(found: DataFrame) -> DataFrame:
    """(path, bytes, offset, records): where the chain from a file's start enters
    a block, and its records there.

    Pointer jumping: after round k the entries up to 2**k blocks along the
    chain are known and every pointer spans 2**k blocks.
    """
    found = cut(found, "warc-candidates")
    targets = found.select("path", F.col("leaves").alias("offset")).where("offset IS NOT NULL").distinct()
    pointers = found.join(targets, ["path", "offset"], "left_semi").unionByName(found.where("offset = 0")).select(
        "path", "offset", F.when(F.col("leaves") < F.col("bytes"), F.col("leaves")).alias("to")).distinct()
    pointers = cut(pointers, "warc-pointers")
    reached = pointers.where("offset = 0").select("path", "offset")
    count = -1
    while (now := reached.count()) > count:
        count = now
        step = reached.join(pointers, ["path", "offset"]).where("to IS NOT NULL").select("path", F.col("to").alias("offset"))
        known = pointers.select("path", "offset")
        reached = cut(reached.union(step.join(known, ["path", "offset"], "left_semi")).distinct(), "warc-reached")
        ahead = pointers.select("path", F.col("offset").alias("to"), F.col("to").alias("further"))
        pointers = cut(pointers.join(ahead, ["path", "to"], "left").select(
            "path", "offset", F.col("further").alias("to")), "warc-pointers")
    return found.select("path", "bytes", "offset", "records").join(reached, ["path", "offset"], "left_semi")


def _whole(files: DataFrame, entries: DataFrame) -> None:
    """Fail unless the chains of ``entries`` hold as many records as ``files`` name."""
    told = files.groupBy("path").agg(F.sum("records").alias("told"))
    found = entries.groupBy("path").agg(F.sum("records").alias("found"))
    wrong = told.join(found, "path", "left").select("path", "told", F.coalesce("found", F.lit(0)).alias("found")).where(
        "told <> found").limit(5).collect()
    if wrong:
        raise ValueError("broken archives: " + "; ".join(f"{r.path} has {r.found} of {r.told} records" for r in wrong))


def _fields(path: str, offset: int, head: dict[bytes, bytes], block: bytes) -> tuple:
    kind = head[b"warc-type"].decode()
    http, _, payload = block.partition(END)
    ident = lambda k: (m := re.fullmatch(rb"<" + ID.encode() + rb"(.*)>", head.get(k, b""), re.S)) and m[1].decode()
    if kind == "revisit":
        m = re.search(rb"\r\nContent-Length: *(\d+)", http)
        digest = head.get(b"warc-payload-digest", b"").removeprefix(b"sha1:")
        size, sha1 = (int(m[1]) if m else None), base64.b32decode(digest).hex()
        payload = None
    else:
        size, sha1 = len(payload), hashlib.sha1(payload).hexdigest()
    uri = head.get(b"warc-target-uri")
    return path, offset, kind, ident(b"warc-record-id"), ident(b"warc-refers-to"), uri and uri.decode(), size, sha1, payload


def read_warc(files: DataFrame, block_bytes: int = BLOCK_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the archives in ``files`` (path, bytes, and the number of
    their records, if known)."""
    entries = reached_entries(candidates(files, block_bytes))
    if "records" in files.columns:
        _whole(files, entries)
    ddl = RECORD if with_payload else RECORD.rpartition(",")[0]
    names = [x.split()[0] for x in ddl.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[x.split()[1]] for x in ddl.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, offset, records in zip(*(b[c].to_pylist() for c in ("path", "bytes", "offset", "records"))):
                stop = min(size, (offset // block_bytes + 1) * block_bytes)
                store, at = open_fs(path)
                rows, held, n, entry = [], 0, 0, offset
                with store.open_input_file(at) as f:
                    f.seek(offset)
                    data, base = f.read(stop - offset + READ_ON), offset
                    while offset < stop and data.startswith(MAGIC, offset - base):
                        data, head, block = _head(f, data, offset - base)
                        to = _next(head, block, offset - base)
                        if to is None or base + to > size:
                            break
                        if to > len(data):               # a record longer than what is read
                            data += f.read(to - len(data) + READ_ON)
                        head = {k: v for k, (_, v) in head.items()}
                        rows.append(_fields(path, offset, head, data[block:to - 4])[:len(names)])
                        held, n, offset = held + to - block, n + 1, base + to
                        if held > (4 << 20):
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if n != records:
                    raise ValueError(f"broken archive: {n} of {records} records read at {entry} of {path}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(n).mapInArrow(read, ddl)
