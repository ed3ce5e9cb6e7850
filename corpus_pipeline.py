"""From raw documents to packed training sequences.

``STAGES`` are applied in order; what a stage returns is written as Parquet
and read again as the next one's documents.  All but the last keep the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, lang_kn, ngram_join, packing, quality_gbt
from ledgerlake.llm.components import written
from ledgerlake.llm.queries import LANGUAGE_LEARN, QUALITY_LEARN, table

#: Words that a tokenising worker remembers (some 20 MB), beside what the earlier stages have left in its memory.
REMEMBER = 170_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_gbt.keep_good(docs, table(spark, sf_dir, "labels"), QUALITY_LEARN)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return lang_kn.keep_identified(docs, LANGUAGE_LEARN)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return ngram_join.keep_one(docs, k=5, threshold=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs, remember=REMEMBER)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", pack)]

# Trained models, components and tokenisers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
