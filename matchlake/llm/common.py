"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import shared_dir

#: Fixed value: a word is a maximal run of anything but ASCII white space.
#: ``bytes.split()`` splits UTF-8 text into exactly these words.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


#: Rows of whole texts that a Python worker gets at once.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings and code that the operators' workers need.

    Rows here hold whole texts, so a worker gets fewer of them at once than
    Spark's default; a smaller setting stays.  The package is carried to the
    workers once per application, unless they find it on PYTHONPATH as the
    driver does.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _SHIPPED:
        return
    package = __package__.split(".")[0]
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), package), "zip", root, package))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends
    in files every executor can read, and later plans know the table's size."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text):
    """Number of words of a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def open_fs(uri: str):
    """(pyarrow file system, path) of a folder or file in a shared store."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + os.path.abspath(uri)
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str):
    """Open ``uri`` for writing under a name of this attempt and move it to its
    own name once complete: a lost or repeated task leaves no half a file.
    Contents follow from the input, so if another attempt has put the file
    there already, it holds the same bytes and stays."""
    from pyarrow import fs
    store, path = open_fs(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        yield out
    there = lambda: store.get_file_info(path).type != fs.FileType.NotFound
    if not there():
        try:
            store.move(part, path)
        except OSError:
            if not there():
                raise
    if store.get_file_info(part).type != fs.FileType.NotFound:
        store.delete_file(part)


def known_small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows (count
    a written table); left to a shuffle join beyond."""
    return F.broadcast(df) if df.count() <= most_rows else df
