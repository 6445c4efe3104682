"""A training corpus from raw documents: language, lines, near-duplicates, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floatlake.llm import decontaminate, language, lines, similar
from floatlake.llm.common import Workspace, finished_tables
from floatlake.llm.queries import pack, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or a likely language go."""
    return language.in_known_language(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat elsewhere."""
    return lines.with_kept_lines(docs)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word shingles, similarity 0.8."""
    return similar.first_of_similar(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of up to 1024 tokens."""
    return pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_first_of_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Hash models, tokens and walks are no SQL: tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written and read again by the next.

    What a stage itself has written on the way is deleted once its rows are.
    """
    workspace = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with finished_tables():
            docs = workspace.save(stage(spark, docs, sf_dir), name)
    return docs
