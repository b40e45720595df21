"""From raw documents to token ids: five stages, each an operator over all that the last kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes each result as
Parquet in the shared folder and reads it back for the next one, so a stage that loses
executors is run again from a table and not from the start. All but the last keep the
columns of ``documents``, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, secrets, simhash, toxicity
from millrace.llm.queries import tokenizer_path
from millrace.session import scratch_path
from millrace.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier of confirmed toxic texts rejects."""
    labels = table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item or an edited copy of one."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows the text."""
    clean = secrets.redacted(docs, secrets.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", counted)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of token ids of every document, with digests of ids and decoded text."""
    return bpe.digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", redact_secrets),
    ("bpe_encoding", encode),
]

#: A trained classifier, hashes and merges of a vocabulary are no SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
