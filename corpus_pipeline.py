"""Corpus pipeline: language ID, near-duplicate join, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before; all but the
last return the columns of documents, whatever other columns are called (helper columns get free
names). run() applies them to documents of sf_dir.

Defined results: a null text has no language and goes in the first stage; a null doc_id comes
before all others; rows of one doc_id are one node of near duplicates (they stay or go together)
and are repeated alike by the mix; of a group the smallest doc_id stays, of repeated passages the
first by doc_id, then by a hash of the text; rows equal in both are one document to the repeated
passages; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagos.llm import op1_packing, op5_jaccard_join, op6_language, op8_mixing, op10_suffix_array
from pelagos.session import materialize, release, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or whose language holds less than half of them, go."""
    return op6_language.kept_languages(docs, op6_language.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles at a similarity of 0.8: the smallest doc_id of each group stays."""
    return op5_jaccard_join.first_of_groups(docs, op5_jaccard_join.Rule(5, 80, 100))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that occurs earlier are cut."""
    return op10_suffix_array.clean(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their target weights."""
    return op8_mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of nearly full token windows."""
    return op1_packing.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None  # a classifier and BPE are in it; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
