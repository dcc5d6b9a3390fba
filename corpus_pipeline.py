"""A training corpus from the raw documents: five stages, each one of the operators in ``tripyard.llm``.

Every stage takes (spark, docs, sf_dir) and gives the next one's documents; all but the
last return the columns of ``documents``.  :func:`run` writes each stage's rows to the
shared folder and reads them back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripyard.llm import decontam, jaccard_join, packing, repetition, toxicity
from tripyard.llm.common import TEXT_ROWS, stored, table
from tripyard.llm.queries import tokenizer_paths

#: Learnt models and iterative joins have no SQL; the stages are tested against brute-force versions.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition limits."""
    return repetition.passing(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents one row, with the smallest id."""
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences of 1,024."""
    return packing.pack_documents(docs, *tokenizer_paths())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_repetitive),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name, TEXT_ROWS)
    return STAGES[-1][1](spark, rows, sf_dir)
