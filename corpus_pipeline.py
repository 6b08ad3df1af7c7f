"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. A lost executor costs at most the stage at hand. An empty table
gives an empty result at every stage, and columns of any other name pass through the first four.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from genpulse.llm.common import documents, stored
from genpulse.llm.exact_dedup import one_of_equals
from genpulse.llm.near_dedup import one_of_each
from genpulse.llm.packing import pack
from genpulse.llm.pii import mask
from genpulse.llm.quality_rules import good_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality passes; the rest go. Null and empty texts fail; rows of one
    text share a verdict, whatever their identifiers."""
    return good_documents(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts: that of the largest identifier. Null and empty
    texts are equal; rows of a null identifier stay only where their group has no other."""
    return one_of_equals(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least identifier. Rows of null
    identifiers, and rows that share one but not the text, are documents of their own; texts
    without words are near to nothing and stay."""
    return one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data masked and n_chars counted anew; null texts stay null."""
    return mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences. A null text is packed as an empty one, its end token alone."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Trained taggers and cost-balanced packing have no SQL form; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
