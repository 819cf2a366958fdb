"""Corpus pipeline: the stages from raw documents to packed training sequences.

Every stage takes the rows that the one before kept and is written and read
again in between.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardweave.llm import boosted_quality, decontaminate, lines, packing, simhash
from cardweave.llm.store import stored


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return boosted_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of three-line windows that occurred before."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most 1,024."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("line_dedup", remove_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
