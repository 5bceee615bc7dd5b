"""From raw documents to packed training sequences: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberline.llm import decontaminate, langid, ngram_join, packing, pii
from emberline.llm.session import save, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; no-letter texts and texts between two languages go."""
    return langid.keep_identified(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word-shingle Jaccard similarity of 0.8 or more."""
    return ngram_join.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exactly or within its edit budget."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and where each stands in which sequence."""
    return packing.op9_packing(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", join_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Compression, edit distance and tokenization have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
