"""From documents to token ids: what is worth training on, once, without the benchmark.

Every stage works on all rows that its predecessor kept, which are written as Parquet in
between. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import byte_bpe, decontaminate, ngram_join, quality, substring_dedup
from tripmill.llm.blocks import shuffles_dropped, small_batches
from tripmill.sources.staging import staged, staging_scope

#: The whole chain can't be said in SQL: a fitted model and a tokenizer are part of it.
ORACLE_SQL = None

#: Near copies: words of a shingle and percent of shingles that two documents share. Wider
#: than the defaults of ``ngram_join``, which are those of op10.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels expects to be good. Null and empty texts are
    scored as texts without words, long ones whole, and every row on its own, repeated or not;
    without any label all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select("doc_id", quality.grade().alias("grade"))
    return quality.select(docs, quality.fit(docs, ratings))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest doc_id (null last).
    Texts without words are copies of nothing and all stay, of repeated rows one stays."""
    return ngram_join.keep_one(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur more than once; documents that
    have lost all their words stay, empty. ``n_chars`` becomes the length of what is left."""
    left = substring_dedup.remove(docs)
    if "n_chars" not in docs.columns:
        return left
    kind = docs.schema["n_chars"].dataType
    return left.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item, whatever their ids; null and empty
    texts stay, as do all documents where the benchmark is empty."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, ids, n_tokens, text_sha256): ids of each document, and the digest of
    the bytes that they decode to. Null and empty texts have no ids; every row gives a row.
    Written at once, a bounded number of texts at a time in a task."""
    size = F.size("ids").cast("long").alias("n_tokens")
    with small_batches(spark), shuffles_dropped(spark), staging_scope(spark):
        # written in between, so that a task has one Python process at a time; blocks and ids
        # go as soon as what was made of them is written
        with staging_scope(spark):
            ids = staged(byte_bpe.encode(docs), "pipeline-ids", "zstd", outlives=True)
        decoded = byte_bpe.decode(ids).select("doc_id", "ids", size, F.sha2("bytes", 256).alias("text_sha256"))
        return staged(decoded, "pipeline-decoded", "zstd", outlives=True)


STAGES = [
    ("quality", select_quality),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark", drop_benchmark_leaks),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
