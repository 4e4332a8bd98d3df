"""Registered queries of the numbered operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import shared_dir

from . import (ann, bpe, hard_negatives, license_scan, line_dedup, mixing, ngram_join, quality_rules, record_files, secret_scan, source_audit,
               url_filter, warc)
from .common import table
from .oracle import SQL as SQL

URL_RULES = (
    url_filter.host_rule("org", "/", "allow"),
    url_filter.host_rule("example.org", "/es/", "block"),
    url_filter.host_rule("example.org", "/en/1", "block"),
    url_filter.host_rule("com", "/fr/", "allow"),
    url_filter.host_rule("com", "/de/", "block"),
) + url_filter.DEFAULT_RULES


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.Index(vectors).search(vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("id")))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(table(spark, sf_dir, "pages"), shared_dir(spark, "llm", "warc"))
    return warc.read_warc(files, with_payload=False).select(
        F.expr("try_cast(id AS bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr("try_cast(refers_to AS bigint)").alias("refers_to"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "lines_exact", "lines_near", F.md5("text").alias("text_md5"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary(), ["doc_id"], bpe.digests, bpe.DIGESTS)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = record_files.write_records(
        table(spark, sf_dir, "documents"), shared_dir(spark, "llm", "records"), vocabulary())
    return record_files.read_records(manifest, with_ids=False)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ann, op2_source_mix, op3_warc, op4_quality_rules, op5_line_dedup, op6_bpe, op7_license_scan, op8_ngram_join,
        op9_record_files, op10_url_filter, op11_source_audit, op12_hard_negatives, op13_secret_scan)}


