"""DuckDB SQL for the queries that SQL can express, written from their definitions.

Each computes the result the plain way: all words, all variants, all rules.
"""

from __future__ import annotations

from .license_scan import EQUIVALENT, known_texts
from .url_filter import DEFAULT_RULES

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

WARC = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes
           FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM p),
r AS (SELECT *, payload_bytes >= 1000 AND last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id AS again FROM m)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last_id END AS refers_to
FROM r"""

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT k, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY k),
s AS (SELECT doc_id, len(words) AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(cov.n, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters
      FROM w LEFT JOIN cov USING (k)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= 2 * n_words
       AND 10 * n_dup_lines <= 4 * greatest(1, n_lines) AND 10 * letters >= 6 * word_chars AS kept
FROM f"""

LINES = f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
l AS (SELECT doc_id, unnest(range(len(p))) AS no, unnest(p) AS raw FROM parts WHERE text IS NOT NULL),
t AS (SELECT doc_id, no, trim(raw, {_WS}) AS line FROM l),
d AS (SELECT line, min(doc_id * 1000000000 + no) AS place, string_split(line, ' ') AS w
      FROM t WHERE line <> '' GROUP BY line),
v AS (SELECT line, place, n, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:n]), ' ') AS v
      FROM (SELECT line, place, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= 10)),
swapped AS (SELECT line FROM (SELECT line, place, min(place) OVER (PARTITION BY n, i, v) AS least FROM v) WHERE least < place),
inserted AS (SELECT DISTINCT v.line AS longer, v.place AS lp, d.line AS shorter, d.place AS sp
             FROM v JOIN d ON v.v = d.line AND len(d.w) = v.n - 1 WHERE len(d.w) >= 10),
near AS (SELECT line FROM swapped UNION SELECT longer FROM inserted WHERE sp < lp
         UNION SELECT shorter FROM inserted WHERE lp < sp),
j AS (SELECT t.doc_id, t.no, d.place <> t.doc_id * 1000000000 + t.no AS exact,
             d.place = t.doc_id * 1000000000 + t.no AND near.line IS NOT NULL AS near
      FROM t JOIN d USING (line) LEFT JOIN near USING (line)),
g AS (SELECT doc_id, count(*) FILTER (exact) AS lines_exact, count(*) FILTER (near) AS lines_near,
             list(no) FILTER (exact OR near) AS gone FROM j GROUP BY doc_id)
SELECT doc_id, coalesce(lines_exact, 0) AS lines_exact, coalesce(lines_near, 0) AS lines_near,
       md5(CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(
           range(len(p)), lambda k: NOT list_contains(gone, k)), lambda k: p[k + 1]), chr(10)) END) AS text_md5
FROM parts LEFT JOIN g USING (doc_id)"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(x: str) -> str:
    """SQL for the canonical form, by lines."""
    out = (f"regexp_replace(lower({x}), '(?m)^[^a-z0-9\\n]*(?:copyright[^\\n]*(?:[0-9]{{4}}|\\(c\\)|©)|\\(c\\) |© "
           "|all rights reserved)[^\\n]*$', '', 'g')")
    out = f"regexp_replace(' ' || {out} || ' ', '[^a-z0-9\\n]+', ' ', 'g')"
    out = f"regexp_replace(replace({out}, chr(10), ' ' || chr(10) || ' '), ' +', ' ', 'g')"
    for a, b in EQUIVALENT:
        end = "" if b.endswith(" ") else " "
        out = f"replace({out}, ' {a}{end}', ' {b}{end}')"
    return out


def _flat(x: str) -> str:
    return f"trim(regexp_replace(replace({x}, chr(10), ' '), ' +', ' ', 'g'))"


LICENSES = f"""
WITH k AS (SELECT DISTINCT license, {_flat(_canonical('known'))} AS known FROM (VALUES
{", ".join(f"({_sql(i)}, {_sql(t)})" for i, t in known_texts())}) AS x(license, known)),
c AS (SELECT row_number() OVER () AS r, doc_id, {_canonical('text')} AS c FROM documents),
u AS (SELECT r, doc_id, {_flat('c')} AS whole, {_flat('c')} AS part FROM c
      UNION SELECT r, doc_id, {_flat('c')}, unnest(list_transform(string_split_regex(c, '\\n(?: *\\n)+'), lambda x: {_flat('x')})) FROM c
      UNION SELECT r, doc_id, {_flat('c')}, unnest(list_transform(string_split(c, chr(10)), lambda x: trim(x))) FROM c)
SELECT DISTINCT doc_id, license, CASE WHEN part = whole THEN 'document' ELSE 'part' END AS scope
FROM u JOIN k ON part = known WHERE part <> ''"""

_BLOCKED = " OR ".join(rf"regexp_matches(path, '(?i)/(?:[^/]*\.)?{r.tokens[0]}(?:/|\z)')" for r in DEFAULT_RULES)
URLS = rf"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_UP}, {_LOW}), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END AS verdict
FROM r"""

# op13: the published forms of credentials once more, as RE2 reads them
_ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
           r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_SECRETS = [("assign", _ASSIGN, 0), ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24),
            ("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", 0),
            ("github", r"(?:gho|ghp|ghr|ghs|ghu)_[A-Za-z0-9]{36,}", 0), ("slack", r"xox[abprs]-[-A-Za-z0-9]{10,}", 0),
            ("google", r"AIza[-A-Za-z0-9_]{35}", 0), ("stripe", r"(?:rk|sk)_live_[A-Za-z0-9]{16,}", 0),
            ("jwt", r"eyJ[-A-Za-z0-9_]{10,}\.eyJ[-A-Za-z0-9_]{10,}\.[-A-Za-z0-9_]{10,}", 0),
            ("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@", 0)]


def _matches(no: int, kind: str, pattern: str, least: int) -> str:
    """Start and end of each match: the lengths of what stands between matches and of the matches themselves."""
    p = _sql(pattern)
    ok = f"length(regexp_extract(f[i], {p}, 2)) >= 6" if kind == "assign" else f"length(f[i]) >= {least}"
    return f"""SELECT k, {no} AS no, '{kind}' AS kind, b AS s, b + length(f[i]) AS e FROM (
        SELECT k, f, i, (list_sum(list_transform(g[1:i], lambda x: length(x)))
                         + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0))::BIGINT AS b
        FROM (SELECT k, f, g, unnest(range(1, len(f) + 1)) AS i FROM (
            SELECT k, regexp_extract_all(t, {p}) AS f, string_split_regex(t, {p}) AS g FROM d))) WHERE {ok}"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_matches(i, *s) for i, s in enumerate(_SECRETS))}),
g AS (SELECT k, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < 3) AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) AS spans FROM m GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (k)"""

AUDIT = rf"""
WITH d AS (SELECT row_number() OVER () AS k, translate(coalesce(text, ''), {_UP}, {_LOW}) AS t, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
             sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, kept.term) AS lang_n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS lang_total, v
      FROM g JOIN kept ON g.lang = kept.lang JOIN v ON v.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
             1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q FROM s),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b USING (lang, term)
      WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50"""

NEGATIVES = """
WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""

SQL = {"op3_warc": WARC, "op4_quality_rules": QUALITY, "op5_line_dedup": LINES, "op7_license_scan": LICENSES,
       "op10_url_filter": URLS,
       "op11_source_audit": AUDIT, "op12_hard_negatives": NEGATIVES, "op13_secret_scan": SECRETS}
