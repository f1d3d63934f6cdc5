"""Corpus preparation in five stages, each one operator of ``seqloom.llm`` over all its predecessor kept.

``run`` applies STAGES to the documents table; every stage's rows are written as Parquet in the shared
folder and read again as the next one's ``docs``. All stages but the last return the columns of documents.

Nulls in any column, empty and very long texts, repeated rows, rows that share an id, and further columns of any name are allowed in every
stage; each says what becomes of them. An empty table passes all stages and gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import mixing, packing, partenum, secrets, toxicity
from seqloom.llm.common import read, stage


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that multiple-instance learning predicts toxic go. Every row is scored by its text; null and empty texts stay."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id.

    Rows that repeat it with a text of the group all stay, and so do rows without an id, null and wordless texts.
    """
    return partenum.drop_near_copies(docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark and n_chars follows; every row stays, repeated ones too; null texts are unchanged."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source up to its share of the token budget, each used once at most; a share's last one keeps its first tokens.

    Null sources and languages are keys of their own. Ties of the seeded order follow doc_id. Rows without tokens come only where their source is taken whole.
    """
    return mixing.take(docs, mixing.Mix(percent=90, max_epochs=1))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences. Null and empty texts are their end token; every row is a document, its id passed on, null or not."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", toxic_out), ("near_copies", near_copies_out), ("secrets", secrets_out), ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
