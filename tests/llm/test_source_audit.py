import random
import re
from collections import Counter, defaultdict

import pytest

from matchlake.llm import source_audit as A


def plain(docs, least=30, top=50):
    """(lang, source, part, item, value, rank) by the definitions, all terms of all pairs."""
    count, seen, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in docs:
        text, lang, source = text or "", lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]
        groups[lang].add(source)
        for w in found:
            count[lang, source, w] += 1
        for w in set(found):
            seen[lang, w] += 1
    out = []
    for lang, sources in groups.items():
        kept = [w for (g, w), n in seen.items() if g == lang and n >= least]
        total = {s: sum(count[lang, s, w] for w in kept) for s in sources}

        def p(n, total):
            return 1 + 10**9 * (n + 5) // (total + 5 * len(kept))
        share = {s: {w: p(count[lang, s, w], total[s]) for w in kept} for s in sources}
        whole = {w: p(sum(count[lang, s, w] for s in sources), sum(total.values())) for w in kept}
        for s in sources:
            pairs = sorted(((-sum(abs(share[s][w] - share[o][w]) for w in kept), o.encode()) for o in sources if o != s))
            terms = sorted((whole[w] - share[s][w], w.encode()) for w in kept if count[lang, s, w] and share[s][w] > whole[w])
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            out += [(lang, s, "term", w.decode(), -v, i + 1) for i, (v, w) in enumerate(terms[:top])]
    return sorted(out)


def random_docs(seed, n, sources, vocabulary, langs=("en", "de", None)):
    r = random.Random(seed)
    names = [f"s{i}" for i in range(sources)] + [None, "", "é"]
    terms = ["".join(r.choice("abcÀé") for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    return [(" ".join(r.choice(terms[:r.randint(1, vocabulary)]) + r.choice(["", "!", "7", "_x"]) for _ in range(r.randint(0, 30))),
             r.choice(langs), r.choice(names)) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame([(i, *d, "x", 1, "y") for i, d in enumerate(docs)],
                                 "doc_id long, text string, lang string, source string, term string, idx int, `value.p` string")


@pytest.mark.parametrize("seed, n, sources, vocabulary, least", [(1, 200, 6, 40, 3), (2, 120, 2, 15, 30), (3, 150, 25, 60, 2)])
def test_equals_all_terms_of_all_pairs(spark, seed, n, sources, vocabulary, least):
    docs = random_docs(seed, n, sources, vocabulary)
    docs += [docs[0]] * 40 + [(None, "en", "none"), ("", "xx", "a"), ("  12 ", "xx", "b"), ("A a Ａ a" * 3, "yy", "only")] * 2
    got = A.audit(frame(spark, docs).repartition(7), least_docs=least, top_terms=5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect())) == plain(docs, least, 5)


def test_flushes_and_pieces_change_nothing(spark, monkeypatch):
    docs = random_docs(4, 60, 5, 30) + [("Ab é " * 5000, "en", "s1")]
    assert list(A.words("Ab1é  x".encode())) == [[b"ab", "é".encode(), b"x"]]
    for name, value in (("HELD", 3), ("SUMS", 2), ("PIECE", 16)):
        monkeypatch.setattr(A, name, value)
    assert [w for p in A.words(b"ab " * 50 + b"c" * 99) for w in p] == [b"ab"] * 50 + [b"c" * 99]
    import pyarrow as pa
    texts = [d[0] for d in docs]
    batch = pa.record_batch({"text": texts, "lang": [d[1] or "" for d in docs], "source": [d[2] or "" for d in docs]})
    total = Counter()
    for b in A._count(iter([batch.slice(i, 7) for i in range(0, len(docs), 7)])):
        for r in b.to_pylist():
            total[r["lang"], r["term"]] += r["docs"]
    want = Counter()
    for text, lang, _ in docs:
        for w in {w.decode() for p in A.words(text.encode()) for w in p}:
            want[lang or "", w] += 1
    assert total == want


def test_walk_adds_each_shared_node_once():
    import pyarrow as pa
    paths = [[(1, 9, 2), (2, 5, 3)], [(1, 9, 2), (2, 5, 3), (4, 8, 1)], [(1, 9, 2), (4, 8, 1)], [(2, 7, 3), (4, 8, 1)]]
    times = [3, 2, 5, 1]
    batch = pa.record_batch({
        "lang": ["en"] * 3 + ["fr"], "times": pa.array(times, pa.int64()),
        "path": pa.array([[dict(zip(("idx", "p", "p0"), n)) for n in p] for p in paths],
                         pa.list_(pa.struct([("idx", pa.int32()), ("p", pa.int64()), ("p0", pa.int64())])))})
    got = Counter()
    for b in A._walk(iter([batch.slice(0, 2), batch.slice(2)])):
        for r in b.to_pylist():
            got[r["lang"], r["a"], r["b"]] += r["value"]
    want = Counter()
    for lang, path, m in zip(["en"] * 3 + ["fr"], paths, times):
        for i, (b, p, p0) in enumerate(path):
            for a, q, q0 in path[:i]:
                want[lang, a, b] += m * (abs(q - p) - abs(q - p0) - abs(p - q0) + abs(q0 - p0))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_edge_documents(edge_docs, no_docs, edge_rows):
    docs = [(t, g, s) for _, t, g, s, *_ in edge_rows]
    assert sorted(map(tuple, A.audit(edge_docs, least_docs=1).collect())) == plain(docs, 1)
    assert sorted(map(tuple, A.audit(edge_docs).collect())) == plain(docs)
    assert A.audit(no_docs).collect() == []
