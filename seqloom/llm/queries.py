"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import align, chunks, fingerprint, html_mincut, mixing, packing, partenum, pivots, radix, rl_index, secrets, toxicity, trie
from seqloom.llm.common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op4_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl_index.remove_repeats(read(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.main_text(read(spark, sf_dir, "pages"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(read(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read(spark, sf_dir, "embeddings"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_report(read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(read(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.copies(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_run_length_index": op4_run_length_index,
    "op5_secret_scans": op5_secret_scans,
    "op6_html_extraction": op6_html_extraction,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_token_alignment": op11_token_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": mixing.ORACLE_SQL,
    "op5_secret_scans": secrets.ORACLE_SQL,
    "op10_ngram_jaccard_join": partenum.ORACLE_SQL,
    "op12_exact_dedup": radix.ORACLE_SQL,
    "op13_prefix_trie": trie.ORACLE_SQL,
}
