from collections import Counter

from matchlake.llm import quality_rules as Q
from tests.llm.conftest import prose


def plain(text):
    t = text or ""
    words = t.encode().split()
    lines = [x for x in t.split("\n") if x.encode().split()]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(len(w.decode()) for w in words), sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_signals_and_verdict(small_docs, edge_docs):
    for docs in (small_docs, edge_docs):
        text = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        got = sorted(Q.quality_report(docs).collect(), key=lambda r: str((r.doc_id, r.n_words)))
        want = sorted(((i, *plain(t)) for i, t in text), key=lambda r: str(r[:2]))
        assert [tuple(r)[:6] for r in got] == want
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_order_does_not_change_the_verdict(small_docs):
    names = tuple(Q.RULES)
    one, two = Q.quality_filter(small_docs, names), Q.quality_filter(small_docs, names[::-1])
    assert one.columns == small_docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in two.collect())
    kept = {r.doc_id for r in Q.quality_report(small_docs).where("kept").collect()}
    assert kept == {r.doc_id for r in one.collect()}


def test_cheap_and_strict_rules_come_first(spark, monkeypatch):
    slow = lambda s: sum(range(20_000)) < 0
    monkeypatch.setitem(Q.RULES, "slow_never", slow)
    monkeypatch.setitem(Q.RULES, "quick_often", lambda s: s.text.startswith("a"))
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(2000)], "doc_id long, text string")
    rules = ("slow_never", "quick_often")
    assert Q.measured_order(docs, rules) == ("quick_often", "slow_never")


def test_cascade_stops_at_the_first_broken_rule():
    s = Q.Signals("x")
    assert Q.cascade(s, ("too_short", "repeated_phrases")) == "too_short"
    assert "n_repeat_words" not in s.__dict__       # the dear signal was not computed


def test_clean_text_stays_and_junk_goes(spark):
    docs = spark.createDataFrame([(1, prose(300)), (2, "same three words " * 50), (3, "a | b | c | d " * 9 + prose(60)),
                                  (4, prose(20)), (5, None)], "doc_id long, text string")
    assert [r.doc_id for r in Q.quality_filter(docs).collect()] == [1]


def test_no_rows(no_docs):
    assert Q.quality_report(no_docs).collect() == [] and Q.quality_filter(no_docs).collect() == []
