"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripyard.llm import (
    brown_lm,
    collocations,
    decontam,
    filter_audit,
    jaccard_join,
    license_index,
    packing,
    quality_fm,
    repetition,
    site_tree,
    toxicity,
    url_rules,
    warc,
)
from tripyard.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The rules that op9 applies: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def tokenizer_paths() -> tuple[str, str]:
    """The tokenizer file of the production parameters and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows a page, each with its whole record: headers, and the source's metadata or the converted text."""
    return warc.derive_pages(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_brown_lm": op3_brown_lm,
    "op4_decontamination": op4_decontamination,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_main_text": op8_main_text,
    "op9_url_rules": op9_url_rules,
    "op10_repetition": op10_repetition,
    "op11_license_scan": op11_license_scan,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}
