"""
From raw documents to packed training sequences, stage by stage.

Each stage takes all that the one before kept and, but for the last, gives rows with the columns of
documents, whatever their names. Null and empty texts pass all stages as empty texts and are packed as their end
mark. Rows without an id are judged like others; of those with near copies, and of rows equal in id and text,
one stays. Very long texts are read whole. Ties go as the operators' docstrings say. An empty table, and
empty labels or benchmark items, give each stage what it has to work on and no error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import decontaminate, near_duplicates, packing, privacy, quality
from tallybrook.llm.base import remove_stored, stored, table, tables_so_far


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return quality.resampled(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on shingles of five words."""
    return near_duplicates.unique_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return privacy.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences."""
    return packing.report(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", privacy_stage),
    ("best-fit packing", packing_stage),
]

# Trained weights, MinHash and token ids are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written for itself is removed once the next one's input is there."""
    docs, first = table(spark, sf_dir, "documents"), tables_so_far()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        remove_stored(spark, first, keep=1)
        first = tables_so_far() - 1
    return docs
