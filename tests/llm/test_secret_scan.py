import hashlib
import re

import pytest

from matchlake.llm import secret_scan as S
from matchlake.llm.trigrams import query

PLAIN_BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A,
               lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24)}


def plain(text):
    """Every rule over the whole text: the base ones as they are defined, the others as written."""
    text = text or ""
    base = [(m.start(), i, m.end(), k) for i, (k, (p, flags, ok)) in enumerate(PLAIN_BASE.items())
            for m in re.finditer(p, text, flags) if ok(m)]
    more = [(m.start(), i + 3, m.end(), r.kind) for i, r in enumerate(S.MORE_RULES) for m in re.finditer(r.regex, text)]

    def joined(spans):
        return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    return (*(sum(s[3] == k for s in base) for k in PLAIN_BASE), hashlib.sha256(joined(base).encode()).hexdigest(),
            joined(base + more))


HEX = "0123456789abcdef" * 2
TEXTS = [
    None, "", " ", "no such thing", "password=abcdef", "PassWord : 'abc12'", "api_key=\"AKIA" + "A1" * 8 + "\"",
    "token=token: abcdefg", "token=passwd=abcdef12", "secret  =  " + HEX, "é😀 token: ünter", "😀" * 5 + "apikey=" + HEX + "😀",
    "AKIA" + "B" * 15, "AKIA" + "B" * 16, "zAKIAAKIA" + "C" * 12, "AKIAx AKIA" + "9" * 40, HEX[:23], HEX[:24], "x" + HEX + "y" + HEX + "A",
    "ghp_" + "a1" * 18, "ghp_" + "a" * 35, "xoxb-" + "1" * 12, "xoxz-" + "1" * 12, "-----BEGIN RSA PRIVATE KEY-----",
    "-----BEGIN PRIVATE KEY-----", "AIza" + "x" * 35, "sk_live_" + "q" * 20, "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12,
    "https://me:pw@host/", "https://me@host:80/", "ſecret=abcdefgh toKen=abcdefgh", "password='" + "p" * 7 + "'\npasswd:" + "q" * 6,
    "(password|secret) $1 \\ [0-9a-f]{24}", ("token=abcdef " + HEX + "\n") * 1500, "a" * 300_000, "word " * 70_000 + "SECRET=hunter22"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "t", "s", "r") for i, t in enumerate(TEXTS * 2)] + [(None, "password=abcdef", None, None, None)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, trigram string, spans string, `dotted.name` string").repartition(5)


def test_equals_every_rule_over_every_text(docs):
    got = S.report(docs)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = got.collect()
    want = {i: plain(t) for i, t in enumerate(TEXTS * 2)} | {None: plain("password=abcdef")}
    assert len(rows) == len(TEXTS) * 2 + 3
    for r in rows:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_scan_keeps_other_columns(docs):
    out = S.scan(docs)
    assert out.columns == docs.columns + ["secrets"]
    assert out.count() == docs.count()


def test_edge_documents(edge_docs, no_docs, edge_rows):
    got = {(r.doc_id, tuple(r)[1:]) for r in S.report(edge_docs).collect()}
    assert got == {(i, plain(t)) for i, t, *_ in edge_rows}
    assert S.report(edge_docs).count() == len(edge_rows)
    assert S.report(no_docs).collect() == []


def test_small_table(spark, small_docs):
    from matchlake.llm.queries import op13_secret_scan
    from tests.conftest import SF_SMALL
    want = sorted((r.doc_id, plain(r.text)) for r in small_docs.collect())
    assert sorted((r.doc_id, tuple(r)[1:]) for r in op13_secret_scan(spark, SF_SMALL).collect()) == want


def test_queries_of_patterns():
    assert query("abcd") == [frozenset({"abc", "bcd"})]
    assert query("ABC") == query("[aA]bc") == [frozenset({"abc"})]
    assert query("abc|xy+") is None
    assert set(query("(abc|defg)h")) == {frozenset({"abc", "bch"}), frozenset({"def", "efg", "fgh"})}
    assert query("ab?cd") == sorted([frozenset({"abc", "bcd"}), frozenset({"acd"})], key=sorted)
    assert query("abc[0-9]+def") == [frozenset({"abc", "def"})]
    assert query("(abc)*") is None and query("[0-9a-f]{24,}") is None and query("a.c") is None
    assert query("(?:abc){2}") == [frozenset({"abc", "bca", "cab"})]
    assert query("(?:abc)+x") == [frozenset({"abc"})]
    assert query("naïve") is None


@pytest.mark.parametrize("rule", S.DEFAULT_RULES, ids=lambda r: r.kind)
def test_no_match_without_the_trigrams(rule):
    clauses = query(rule.regex)
    for t in TEXTS:
        if t and clauses is not None and re.search(rule.regex, t):
            assert any(all(g in t.lower() for g in c) for c in clauses)


def test_postings_are_intersected(spark):
    docs = spark.createDataFrame([(1, "token"), (2, "tok oke"), (3, "tok oke ken"), (4, "akia"), (5, "token")], "doc_id long, text string")
    index = S.postings(docs)
    keys = {r.doc_id: r.k for r in docs.select("doc_id", S.text_key(docs.text).alias("k")).collect()}
    found = {r[S.KEY]: set(r[S.FOUND]) for r in S.candidates(index).collect()}
    assert found == {keys[1]: {0}, keys[3]: {0}, keys[4]: {1}}


def test_no_python_on_the_path(docs):
    plan = S.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
