"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardweave.llm import (
    blob_ledger, boosted_quality, collocations, decontaminate, hard_negatives, html_density, line_quality, lines,
    packing, projection_forest, simhash, substrings, token_files)
from cardweave.llm.oracle import ORACLES  # noqa: F401  (read by the entry module)
from cardweave.llm.store import shared_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_density(spark: SparkSession, folder: str) -> DataFrame:
    return html_density.extract_main_text(_table(spark, folder, "pages"))


def op2_line_first_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.judge_documents(_table(spark, folder, "documents"), cleaned=False)


def op3_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    versions = blob_ledger.update_ledger(_table(spark, folder, "documents"), path)
    return blob_ledger.secret_report(blob_ledger.spans_by_row(versions, path))


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return decontaminate.leak_report(leaks)


def op5_boosted_quality(spark: SparkSession, folder: str) -> DataFrame:
    return boosted_quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    token_files.write_token_files(_table(spark, folder, "documents"), path,
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, folder, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.dedup_substrings(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, counts=("n_lines", "n_removed"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine_hard_negatives(vectors)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine_collocations(_table(spark, folder, "documents"))


def op13_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    return projection_forest.nearest_neighbours(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_density": op1_html_density,
    "op2_line_first_quality": op2_line_first_quality,
    "op3_blob_ledger": op3_blob_ledger,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_boosted_quality": op5_boosted_quality,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_token_files": op7_token_files,
    "op8_vector_packing": op8_vector_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_projection_forest": op13_projection_forest,
}
