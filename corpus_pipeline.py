"""From raw documents to packed sequences: the stages of a training-data pipeline.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept; ``run`` writes each result as Parquet and reads it again,
so a lost executor costs at most the stage at work. All stages but the last
return the columns of ``documents``. Null texts count as empty; an empty table
passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablecheck.llm import decontamination, langid, packing, quality, simhash
from tablecheck.llm.queries import tokenizer
from tablecheck.sources.scratch import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, trained on the given labels."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with an accepted score."""
    return langid.keep_identified(docs)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.one_per_group(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their sequences and offsets."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("SimHash near-dedup", no_near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("best-fit packing", packed),
]

#: Classifiers, fingerprints and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
