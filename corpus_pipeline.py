"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Quality rules drop documents; near-dedup keeps one of each group; substring dedup cuts repeated passages from texts;
the secret scan replaces secrets in texts; packing fills token sequences. All stages but the last return the columns
of documents. Stages work on what their predecessor kept.

Defined results: rows with null, empty or blank texts have no words and go with the quality rules; rows with a null doc_id
pass the dedup stages unchanged; of repeated rows, and of rows that share the least doc_id of a group, all stay; texts of
any length are worked on whole; extra columns are kept, up to packing; an empty table gives no rows. Each operator's
docstring has the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomsift.llm import common, near_dup, packing, quality, secrets, substring


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.remove(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring", substring_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: The stages' models and components have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
