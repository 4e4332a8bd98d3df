import pytest

from matchlake.llm import line_dedup as L
from tests.llm.conftest import prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows, min_words=10):
    """Kept text of each (doc_id, text), the plain way; rows by place."""
    lines = []
    for d, (i, t) in enumerate(rows):
        for n, raw in enumerate((t or "").split("\n") if t is not None else []):
            line = raw.strip(" \t\n\x0b\x0c\r")
            if line:
                lines.append((d, n, line, line.split(" ")))
    gone = set()
    for k, (d, n, line, w) in enumerate(lines):
        for _, _, other, v in lines[:k]:
            if line == other or (min(len(w), len(v)) >= min_words and abs(len(w) - len(v)) <= 1 and distance(w, v) <= 1):
                gone.add((d, n))
                break
    return [(i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone))
            for d, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    base = [prose(14, k).split(" ") for k in range(6)]
    out = []
    for d in range(60):
        lines = []
        for k in range(3):
            w = list(base[(d + k) % 6])
            kind, at = (d * 7 + k) % 5, (d * 5 + k * 3) % 14
            if kind == 1:
                w[at] = f"new{d}"
            elif kind == 2:
                del w[at]
            elif kind == 3:
                w.insert(at, f"more{d}")
            elif kind == 4:
                w[at], w[(at + 3) % 14] = f"two{d}", f"edits{d}"
            lines.append((" " if d % 4 == 0 else "") + " ".join(w))
        lines += ["short line", f"tail {d % 9}", "", " \t"]
        out.append((d, "\n".join(lines)))
    return out


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.text) for r in L.dedup_lines(docs).collect())
    assert got == plain(rows)


def test_template_lines_need_no_pairs(spark):
    """A thousand lines that differ in the same word: one stays."""
    rows = [(i, " ".join(["fixed"] * 6 + [f"n{i}"] + ["words"] * 6)) for i in range(1000)]
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("text <> ''").collect()
    assert [r.doc_id for r in got] == [0]


def test_edge_cases(edge_docs, edge_rows, no_docs):
    out = L.dedup_lines(edge_docs)
    assert out.columns == [*edge_docs.columns, "lines_exact", "lines_near"]
    got = sorted((str(r.doc_id), r.text) for r in out.collect() if r.doc_id not in (5, 8, None))
    rows = {str(r[0]): r[1] for r in edge_rows}
    for i, t in got:
        if i in ("1", "2", "3", "4", "7", "9", "10"):
            assert t == rows[i]
    texts = dict(got)
    assert texts["6"] == ""                              # one word more than 5's line
    assert texts["11"] == "a\nb\n\nc \n"                 # ' c' is 'c' again, the blank line stays
    fives = [r.text for r in out.where("doc_id = 5").collect()]
    assert fives == [rows["5"]] * 2                      # equal rows keep the same lines
    assert sorted(str(r.text) for r in out.where("doc_id IS NULL").collect()) == ["", "None"]
    assert L.dedup_lines(no_docs).collect() == []


def test_plan_has_no_python(small_docs):
    plan = L.dedup_lines(small_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_counts(spark):
    line = prose(12, 1)
    docs = spark.createDataFrame([(1, line), (2, line), (3, line + " more")], "doc_id long, text string")
    got = {r.doc_id: (r.lines_exact, r.lines_near, r.text) for r in L.dedup_lines(docs).collect()}
    assert got == {1: (0, 0, line), 2: (1, 0, ""), 3: (0, 1, "")}


def test_documents_of_many_lines(spark):
    lines = [f"line number {k}" for k in range(20_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join([*lines[1:], "own"]))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert got == {1: "\n".join(lines), 2: "own"}
