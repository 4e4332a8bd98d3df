import re

from matchlake.llm import url_filter as U
from matchlake.llm.queries import URL_RULES

URLS = ["http://example.org/es/x", "https://www.example.org/en/123?x=/es/", "http://example.org/en/2", "http://a.com/fr/1#t",
        "http://a.COM/de/1", "http://com/de/", "http://xcom/de/", "http://x.net/login", "http://x.net/a/b.jpg?c", "http://x.org",
        "http://x.org/", "ftp://ORG/a", "no scheme /login/", "", None, "http://x.net/LOGIN/", "http://x.net/loginx",
        "://com/fr/", "http://u@example.org/es/", "http://example.org:80/es/", "http://a://b.com/fr/", "x" * 100_000 + "://c.com/de/",
        "http://x.net/a\nlogin", "http://notexample.org/es/", "http://example.org/ES/", "http://é.com/fr/"]


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r, v in (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
                 ("com/de/", "block")):
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best[0])):
            best = (r, v)
    other = any(re.search(r.regex.replace(r"\z", r"\Z"), host + path) for r in U.DEFAULT_RULES)
    return host, path, best and best[0], best[1] if best else "block" if other else "allow"


def test_every_url(spark):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, `to.ken` string, host string, rule string").repartition(3)
    got = U.judge(pages, URL_RULES)
    assert got.columns == ["page_id", "url", "to.ken", "host", "path", "rule", "verdict"]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {
        i: plain(u) for i, u, *_ in rows}


def test_rules_without_tokens_and_many_rules(spark, monkeypatch):
    rules = (U.UrlRule("any digit", "block", "[0-9]", ()), U.UrlRule("z", "allow", "/z/", ("z",), tier=1))
    pages = spark.createDataFrame([(1, "http://a/1"), (2, "http://a/b"), (3, "http://a/z/1")], "page_id long, url string")
    want = {1: "block", 2: "allow", 3: "allow"}
    assert {r.page_id: r.verdict for r in U.judge(pages, rules).collect()} == want
    monkeypatch.setattr(U, "BROADCAST_RULES", 0)
    assert {r.page_id: r.verdict for r in U.judge(pages, rules).collect()} == want


def test_no_rows(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []


def test_tokens_of_host_rules():
    assert U.host_rule("example.org", "/en/1", "block").tokens == ("example", "org", "en")
    assert U.host_rule("org", "/", "allow").tokens == ("org",)
