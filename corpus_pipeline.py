"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of
``documents``; the last returns one row per packed piece. SQL can express neither sketches, subset sums nor packing, so there is no
``ORACLE_SQL``; the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import exact_dedup, mixing, near_dup, packing, quality_rules
from lakeloom.llm.helpers import store
from lakeloom.sources.tables import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and every certified cutoff of their language.

    A missing or empty text has no words and goes. Rows without id, and rows given twice, are judged each by itself; a missing language is
    one of its own. Without labels the base rules alone decide. Other columns, whatever their names, pass through.
    """
    return quality_rules.keep_good(docs, Tables(spark, sf_dir)["labels"])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest doc_id.

    A missing text equals an empty one. A row without id stays only where no other has its text; of rows given twice one stays.
    """
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the one with the smallest doc_id.

    Texts without words, missing ones too, are one class. A row without id stays only where its class has no other; of rows given
    twice one stays.
    """
    return near_dup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights: a document appears as often as the mix takes it.

    A missing source is one of its own, after all others. Texts without words have size 0 and are not taken. Rows given twice are
    two documents.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece in sequences of at most 2048 tokens.

    A missing or empty text is the single id 0. Rows given twice are packed twice; a missing id is kept as it is.
    """
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dup", near), ("mixing", mix), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = Tables(spark, sf_dir)["documents"]
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
