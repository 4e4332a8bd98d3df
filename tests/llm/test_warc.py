import hashlib

import pytest

from matchlake.llm import warc

PAGES = "page_id long, url string, html string, sha1 string, size long, refers string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], PAGES).repartition(3, "page_id")


def inner():
    body = b"HTTP/1.1 200 OK\r\n\r\nfake"
    return (warc.MAGIC + b"WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: %d" % len(body)
            + warc.END + body + warc.END).decode()


@pytest.fixture(scope="module")
def rows():
    big = "same " * 400
    return [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/4", "small"),
            (5, "http://a/5", "small"), (6, "http://a/ \r\nX: y", None), (7, "u", ""), (None, "u", big),
            (8, "http://é/ü", "ünï" * 500), (8, "http://é/ü", "ünï" * 500), (None, None, None),
            (9, "u", inner() * 30), (10, "u", "x" * 300_000), (11, "u", "WARC/1.1\r\n" * 50 + inner())]


def expected(rows):
    known = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            known[b] = max(known.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = known.get(b)
        again = first is not None and i != first
        out.append((None if i is None else str(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response",
                    str(first) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [700, 5000, 1 << 23])
def test_round_trip_whatever_the_blocks(spark, rows, folder, block):
    files = warc.write_warc(pages(spark, rows), folder)
    got = warc.read_warc(files, block_bytes=block)
    found = sorted(((None if r.id == "null" else r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                    for r in got.collect()), key=str)
    assert found == expected(rows)
    kept = {r.id: bytes(r.payload) for r in got.collect() if r.record_type == "response"}
    assert kept["9"] == (inner() * 30).encode() and kept["10"] == b"x" * 300_000
    assert not got.where("id = '666'").collect()


def test_candidates_hold_more_than_the_records(spark, rows, folder):
    files = warc.write_warc(pages(spark, rows), folder)
    assert warc.candidates(files).count() > files.agg({"records": "sum"}).first()[0] == len(rows)


def test_urls_are_escaped(spark, rows, folder):
    got = warc.read_warc(warc.write_warc(pages(spark, rows), folder))
    assert got.where("id = '6'").first().url == "http://a/%20%0D%0AX:%20y"
    assert got.where("id = '3'").first().url is None


def test_a_cut_file_ends_its_chain(spark, folder):
    import os
    files = warc.write_warc(pages(spark, [(i, "u", f"page {i}") for i in range(20)]).coalesce(1), folder)
    path = files.first().path.removeprefix("file://")
    size = os.path.getsize(path) - 7
    os.truncate(path, size)
    cut = spark.createDataFrame([(files.first().path, size)], "path string, bytes long")
    assert warc.read_warc(cut).count() == 19


def test_no_rows(spark, folder):
    files = warc.write_warc(pages(spark, []), folder)
    assert files.collect() == [] and warc.read_warc(files).collect() == []


@pytest.mark.parametrize("block", [700, 1 << 23])
def test_heads_of_any_length(spark, folder, block):
    """Records with very long URLs, and all after them, are read."""
    rows = [(i, "u" if i % 2 else "data:" + "é:/WARC/1.1" * (i * 3000), f"page {i}") for i in range(8)]
    files = warc.write_warc(pages(spark, rows).coalesce(1), folder)
    got = {int(r.id): (r.url, bytes(r.payload).decode()) for r in warc.read_warc(files, block_bytes=block).collect()}
    assert got == {i: (u, p) for i, u, p in rows}


def test_pages_that_look_like_endless_heads(spark, folder):
    """Magic lines that share one head, no head or a head without an end."""
    rows = [(1, "u", "X: WARC/1.1\r\n" * 100_000), (2, "u", "WARC/1.1\r\nA: b\r\n" * 50_000),
            (3, "u", "WARC/1.1\r\n" + "x" * 200_000), (4, "u", "WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 5\r\nX: " + inner())]
    files = warc.write_warc(pages(spark, rows).coalesce(1), folder)
    got = {int(r.id): bytes(r.payload).decode() for r in warc.read_warc(files, block_bytes=100_000).collect()}
    assert got == {i: h for i, _, h in rows}


def test_a_broken_chain_is_an_error(spark, folder):
    import os
    files = warc.write_warc(pages(spark, [(i, "u", f"page {i}") for i in range(20)]).coalesce(1), folder)
    path, size = files.first().path, files.first().bytes - 7
    os.truncate(path.removeprefix("file://"), size)
    cut = spark.createDataFrame([(path, 20, size)], warc.MANIFEST)
    with pytest.raises(ValueError, match="19 of 20 records"):
        warc.read_warc(cut)
