import zlib

import numpy as np
import pytest

from matchlake.llm import record_files as R
from matchlake.llm.queries import vocabulary


def plain(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (
        r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    out, start = [], 0
    for r in rows:
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["small_docs", "edge_docs"])
def test_round_trip(request, which, folder, monkeypatch):
    docs = request.getfixturevalue(which)
    manifest = R.write_records(docs, folder, vocabulary())
    got = sorted((tuple(r) for r in R.read_records(manifest).collect()), key=lambda r: r[1])
    assert got == plain(docs)
    assert sum(r.records for r in manifest.collect()) == len(got)


def test_shuffled_reads_by_offset(small_docs, folder):
    manifest = R.write_records(small_docs, folder, vocabulary())
    want = {(r[0], tuple(r[4])) for r in plain(small_docs)}
    one = [(r.doc_id, tuple(r.ids)) for r in R.read_shuffled(manifest, 1).orderBy("place").collect()]
    two = [(r.doc_id, tuple(r.ids)) for r in R.read_shuffled(manifest, 2).orderBy("place").collect()]
    assert set(one) == set(two) == want and one != two


def test_rolls_files_and_sums_starts(spark):
    rows = [(p, s, f"{p}-{s}", 1, 10 * p + s, 0) for p in range(7) for s in range(3)]
    got = R.with_starts(spark.createDataFrame(rows, R.MANIFEST), width=2).orderBy("part", "seq").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.ids


def test_damage_is_found():
    record, = R.frame([b"payload"])
    assert R.unframe([record]) == [b"payload"]
    for k in range(len(record)):
        bad = bytearray(record)
        bad[k] ^= 1
        with pytest.raises(ValueError):
            R.unframe([bytes(bad)])


def test_checksums_of_every_length():
    import random

    from matchlake.llm.crc32c import crc32c

    def plain(data):
        c = 0xFFFFFFFF
        for x in data:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF
    assert plain(b"123456789") == 0xE3069283            # the published check value
    r = random.Random(1)
    strings = [r.randbytes(n) for n in [*range(4, 200), 1000, 4096, 10_001, 30_000]]
    assert crc32c(strings).tolist() == [plain(s) for s in strings]
    assert crc32c([]).tolist() == []


def test_no_rows(no_docs, folder):
    manifest = R.write_records(no_docs, folder, vocabulary())
    assert manifest.collect() == [] and R.read_records(manifest).collect() == []


def test_rows_without_an_id_go_to_several_tasks(spark, folder):
    docs = spark.createDataFrame([(None if i % 2 else i, f"{i % 50} text {i}") for i in range(800)], "doc_id long, text string").repartition(4)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")        # so little data would be one task
    try:
        manifest = R.write_records(docs, folder, vocabulary())
    finally:
        spark.conf.unset(setting)
    got = sorted((tuple(r) for r in R.read_records(manifest).collect()), key=lambda r: r[1])
    assert got == plain(docs)
    records = [r.records for r in manifest.collect()]
    assert len(records) >= 3 and max(records) < 400     # 400 rows have no id
