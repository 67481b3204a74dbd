"""Registered queries of the operators in this subpackage, and their SQL where there is one.

Every query reads whole tables and works with the operators' own defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    byte_bpe, conversations, decontaminate, fingerprint, license_scan, merkle, ngram_join, quality, sharding, sql, substring_dedup,
    token_files, url_filter, warc,
)
from tripmill.sources.staging import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, beside its edited text's and the next document's."""
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur elsewhere, as a digest."""
    done = substring_dedup.cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return done.select("row.doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, and the bytes they decode to."""
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"))
    return byte_bpe.digests(byte_bpe.decode(encoded))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, and whether it is selected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select("doc_id", quality.grade().alias("grade"))
    scored = quality.score(docs, quality.fit(docs, ratings))
    selected = (F.col("tail_probability") >= quality.LEAST).alias("selected")
    return scored.select("row.doc_id", "expected_grade", "tail_probability", selected)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back."""
    folder = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that the sentences of every document name or grant."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written in packed files and read back."""
    folder = new_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder)
    return token_files.digests(token_files.read(spark, folder))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies that every document belongs to."""
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the Merkle tree of all, and whether it was tampered with."""
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, with shards of even bytes."""
    return sharding.documents(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    turns, lost = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.report(turns, gone=lost)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_fingerprint, op2_substring_dedup, op3_byte_bpe, op4_quality, op5_warc, op6_decontaminate, op7_token_files,
        op8_url_filter, op9_license_scan, op10_ngram_join, op11_merkle, op12_sharding, op13_conversations,
    )
    return {query.__name__: query for query in every}


def oracle_sql() -> dict[str, str]:
    return sql.SQL
