import corpus_pipeline as P
from matchlake.llm.common import cut
from tests.conftest import SF_SMALL
from tests.llm import test_line_dedup, test_ngram_join
from tests.llm.conftest import prose


def staged(spark, docs, folder):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(cut(stage(spark, out[-1], folder), f"test-{name}"))
    return out


def test_each_stage_against_the_plain_way(spark, small_docs):
    docs, clean, lined, unique, mixed, encoded = staged(spark, small_docs, SF_SMALL)
    for d in (clean, lined, unique, mixed):
        assert d.columns == docs.columns
    assert clean.count() < docs.count() and not clean.exceptAll(docs).collect()

    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    assert sorted((r.doc_id, r.text) for r in lined.collect()) == [
        (i, t) for i, t in test_line_dedup.plain(rows) if t.split()]
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    rows = [(r.doc_id, r.text) for r in lined.collect()]
    assert sorted(r.doc_id for r in unique.collect()) == sorted({c for _, c, _ in test_ngram_join.plain(rows)})
    assert not mixed.select("doc_id").exceptAll(unique.crossJoin(spark.range(3)).select("doc_id")).collect()
    assert sorted(r.doc_id for r in encoded.collect()) == sorted(r.doc_id for r in mixed.collect())
    assert P.run(spark, SF_SMALL).count() == encoded.count()


def test_planted_cases(spark, tmp_path):
    clean, other = prose(300, 1, 4000), prose(260, 2, 4000)
    near = clean.split(" ")
    near[100] = "changed"
    passage = prose(70, 3, 4000)
    rows = [(1, clean), (2, clean), (3, " ".join(near)), (4, other + "\n" + passage), (5, prose(200, 4, 4000) + "\n" + passage),
            (6, "buy now " * 100), (7, None), (8, prose(200, 5, 4000)), (8, prose(200, 5, 4000))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    path = f"file://{tmp_path}/documents.parquet"
    docs.write.parquet(path)
    _, quality, lines, unique, mixed, encoded = staged(spark, spark.read.parquet(path), str(tmp_path))
    assert sorted(r.doc_id for r in quality.collect()) == [1, 2, 3, 4, 5, 8, 8]
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert passage in texts[4] and passage not in texts[5] and sorted(texts) == [1, 4, 5, 8]
    assert sorted(r.doc_id for r in unique.collect()) == [1, 4, 5, 8]


def test_empty_table(spark, no_docs, tmp_path):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert [d.count() for d in staged(spark, docs, str(tmp_path))] == [0] * 6
