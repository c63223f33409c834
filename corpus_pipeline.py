"""Corpus pipeline: raw documents to training tokens, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet to the folder
that the cluster shares and reads them again as the next one's ``docs``. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lensmill.llm import byte_bpe, curriculum, jaccard_join, line_dedup, quality_ledger
from lensmill.llm.common import made, release, scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger rejects go."""
    return quality_ledger.keep(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go, and documents that are left with none."""
    return line_dedup.dedup(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar 5-word shingles (0.8 or more), the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix of sources takes them."""
    return curriculum.take(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the digest of what they decode to."""
    return byte_bpe.tokens_and_digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: SQL can't express the last stage (nor, at any useful speed, the similarity joins).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's scratch tables and its predecessor's rows are deleted once its own are written."""
    docs, others = table(spark, sf_dir, "documents"), made()
    for k, (_, stage) in enumerate(STAGES):
        out, path = stage(spark, docs, sf_dir), scratch(spark, f"stage-{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        release(spark, keep=[*others, path])
    return docs
