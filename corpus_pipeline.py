"""Corpus pipeline over ``documents``: each stage keeps documents and hands them on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm.common import documents, written
from eventide.llm.exact_dedup import drop_exact_duplicates
from eventide.llm.language_id import keep_identified
from eventide.llm.mixing import mix
from eventide.llm.near_dedup import drop_near_duplicates
from eventide.llm.queries import token_digest, tokenizer

ORACLE_SQL = None
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; the models learn from this stage's input."""
    return keep_identified(docs.select(*COLUMNS))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_duplicates(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, a row for each copy."""
    return mix(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, a row for each copy."""
    return token_digest(docs, *tokenizer())


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mixing),
    ("byte-level BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
