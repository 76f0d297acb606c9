"""A training corpus from ``documents``: toxicity, line dedup, near copies, mixing, packing.

Every stage gets all that its predecessor kept, as a written table, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyframe.llm import line_dedup, mixing, packing, simhash, toxicity
from skyframe.llm.plans import CHAIN, tokenizer_files
from skyframe.plans.registry import query, table
from skyframe.session import written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject as toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), CHAIN, "toxic")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Their lines, without those that three documents or more hold, except in the last of these."""
    return line_dedup.without_repeated_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash links, then keys, of five-word shingles; both checked at similarity 0.8)."""
    return simhash.without_near_copies(docs, words=5, similarity=0.8)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 1024 tokens."""
    return packing.packed_sequences(docs, **tokenizer_files())


STAGES = [
    ("toxicity", clean),
    ("line dedup", without_repeated_lines),
    ("near copies", one_of_each),
    ("mixing", mixture),
    ("packing", sequences),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer have no SQL; the stages have brute-force tests


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's rows written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
