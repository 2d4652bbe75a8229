"""From raw documents to packed training sequences, one stage after the other.

Rejected by language identification: texts without a letter, and texts of which no language has half of the words.
Then one row of each group of equal texts stays (the largest doc_id), one of each class of near-duplicates (the
smallest doc_id); of what is left, passages of 50 words and more that a smaller doc_id has too are cut out; the
rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewright.llm import exact, langid, neardup, packing, substring
from pricewright.llm.common import documents, stored
from pricewright.llm.queries import BYTE_BPE


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs)


def near_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.cleaned(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("language identification", language),
    ("exact dedup", equal_texts),
    ("near-duplicates", near_texts),
    ("substring dedup", passages),
    ("best-fit packing", packed),
]
ORACLE_SQL = None  # neither the language model nor the packing can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; what each stage returns is written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
