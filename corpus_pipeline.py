"""From raw documents to token ids: quality rules, line dedup, near duplicates,
mixing sources, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet to the shared folder and
reread as the next one's ``docs``.  All but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.

Edge cases are those of the operators: null, empty and wordless texts break the
quality rules and go; a document left without words by the line dedup goes;
of rows that repeat, one stays; null sources and doc_ids take part.  A document
that the mix takes twice is two rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from matchlake.llm.common import cut, n_words, prepare, table
from matchlake.llm.queries import vocabulary

#: Text of a block in the last stage: smaller than the operator's own, as the
#: executors still hold memory of the stages before.
ENCODED_AT_ONCE = 4 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    prepare(spark)
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has already."""
    out = line_dedup.dedup_lines(docs).where(n_words(F.col("text")) > 0)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids, and digests of ids and decoded text."""
    return bpe.encode_decode(docs, vocabulary(), ["doc_id", "source"], bpe.ids_and_digests, bpe.IDS_AND_DIGESTS,
                             block_bytes=ENCODED_AT_ONCE)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_duplicates),
          ("source_mix", mix), ("bpe", encode)]

#: The mix draws at random, which SQL does not express; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
