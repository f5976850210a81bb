"""The driver queries of the llm operators: whole tables, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.alignment import align_documents
from arrivals.llm.common import read_documents
from arrivals.llm.decontam import leak_pairs
from arrivals.llm.hmm import language_model_scores
from arrivals.llm.language import identify_languages
from arrivals.llm.licenses import scan_licenses
from arrivals.llm.lines import dedup_lines
from arrivals.llm.mixing import mix
from arrivals.llm.near_dedup import near_duplicates
from arrivals.llm.prefix_trie import rebuilt_trie
from arrivals.llm.quality import COUNTS, clean_lines
from arrivals.llm.recompression import remove_repeated_words
from arrivals.llm.suffixes import remove_repeated_bytes
from arrivals.llm.token_files import read_token_files, write_token_files
from arrivals.session import scratch_path


def op1_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir))


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(read_documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines with a word, removed lines, and the SHA-256 of what is left."""
    return dedup_lines(read_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(read_documents(spark, sf_dir))


def op6_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents and the items they hold."""
    return leak_pairs(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(read_documents(spark, sf_dir)).select("doc_id", *COUNTS, "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(read_documents(spark, sf_dir))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_documents(spark, sf_dir))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents and returns what they hold."""
    path = scratch_path(spark, "token-files")
    write_token_files(read_documents(spark, sf_dir), path)
    return read_token_files(spark, path, with_ids=False)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    return rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bag_minhash": op1_bag_minhash,
    "op2_hmm_scores": op2_hmm_scores,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_latent_decontamination": op6_latent_decontamination,
    "op7_bigru_language": op7_bigru_language,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_recompression": op10_recompression,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}
