"""A training corpus from raw documents: rules, near duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm._spark import load, written
from palimpsest.llm.decontaminate import drop_contaminated
from palimpsest.llm.near_dedup import keep_one
from palimpsest.llm.packing import retrieval_pack
from palimpsest.llm.quality import keep_good
from palimpsest.llm.secrets import redact
from palimpsest.llm.token_counts import VOCABULARY, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return retrieval_pack(docs, vocabulary_path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: SQL can't express the tokenizer of the last stage; tests look for what each stage has to have removed, and for packing at its ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of documents.

    Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns: as each stage's operator says.
    """
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
