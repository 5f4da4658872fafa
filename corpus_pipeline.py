"""From raw documents to token files, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``.
Between stages the documents are written as Parquet below the cluster's shared
checkpoint folder, so a lost executor costs one stage's tasks at most.

Every stage takes any documents: nulls in any column, empty and very long texts,
rows that repeat or share an id, further columns whose names the operators use
themselves, and no rows at all (then it returns none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, mixing, quality, simhash, token_files
from strata.llm.common import ship, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose posterior says good.  Null and
    blank texts fail the base rule; equal rows are judged alike; of no documents
    none is kept."""
    ship(spark)
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: one row of the group's
    smallest id (null where none of them has an id).  Texts without words are a group
    of their own; repeated rows are one group."""
    ship(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window.  Null texts have none; repeated rows
    stay or go together; an empty benchmark takes nothing away."""
    ship(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and fractional repetitions towards the sources' target weights, one row
    per repetition.  Texts without words are not taken; a null source is a source;
    rows that repeat or share an id are taken one by one."""
    ship(spark)
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row per written document, in ascending order of
    ids.  Null texts are empty documents, which hold the end id alone; repeated rows
    are documents of their own."""
    ship(spark)
    return token_files.token_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix_sources),
    ("token-ID output", token_output),
]

# Expectation-maximisation, components and coding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            docs = written(docs, f"pipeline-{k}")
        docs = stage(spark, docs, sf_dir)
    return docs
