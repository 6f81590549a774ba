"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents that the stage before it kept, and all but the last return their columns. Empty and
repeated rows and NULLs follow the rules of the operators that the stages call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelyard.llm import decontaminate, langid, line_dedup, near_dups, packing
from parcelyard.llm.common import keep, table

# Beside what the stages before have left in an executor's JVM and workers; a token query alone remembers ten times as many.
WORDS_REMEMBERED = 50_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters stay, in whatever language and also with no model; those without text or letters go."""
    return langid.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand, equal or one edit away, earlier in the corpus go; documents left without a line go too."""
    return line_dedup.keep_first_lines(docs, stored=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return near_dups.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word passage of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens."""
    return packing.pack_documents(docs, words=WORDS_REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify), ("lines", dedup_lines), ("near-duplicates", dedup_documents),
    ("decontamination", decontaminated), ("packing", pack),
]

# SQL can't learn a language model, hash shingles or tokenize; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the scratch folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = keep(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
