"""A pipeline from documents to token files.

Toxic documents go, one document of each group of near-copies stays, documents with passages
of the benchmark go, sources are mixed to their target weights, and the mix is written as
packed token ids.  Each stage is written to the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexigrove.llm.common import materialise
from lexigrove.llm.decontamination import remove_contaminated
from lexigrove.llm.mixing import mix_documents
from lexigrove.llm.near_dedup import drop_near_duplicates
from lexigrove.llm.queries import table, tokenizer_path
from lexigrove.llm.token_ids import token_table
from lexigrove.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the lexicon is learned from the labelled ones that aren't held out."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-copies, with its smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"), size=10, mode="documents")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mix_documents(docs, weights=(5, 2, 1), max_epochs=3)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, as the token files have them."""
    # workers hold what earlier stages left them, so the encoder remembers less than by itself
    return token_table(docs, tokenizer_path(), end_id=2, special_as_text=False, remembered=150_000, at_once=2_000_000)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: Learned scores and token files can't be expressed in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
