import os
import random

import pytest

from tests.conftest import SF_SMALL  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string, digest string, node string, row string"


def prose(n, seed=0, vocabulary=400):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, very long, repeated and tied rows; extra columns with names the operators use."""
    long = prose(60_000, 5, 5000)
    same = prose(80, 6)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b ", None, None), (4, long, "en", "a"),
            (5, same, "en", "b"), (5, same, "en", "b"), (None, same, "en", "b"), (None, None, None, None),
            (6, same + " end", "en", "b"), (7, "one two", "en", None), (8, "one two", "en", ""),
            (9, "x" * 200_000, "en", "b"), (10, "ünï çödé <|endoftext|> don't 12́ 　!", "de", "c"),
            (11, "a\nb\nb\n\nc \n c\n", "en", "a")]
    return [(i, t, g, s, None if t is None else len(t), "block", "digest", "node", "row") for i, t, g, s in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows, DOCS).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture()
def folder(tmp_path):
    return "file://" + os.path.join(str(tmp_path), "files")
