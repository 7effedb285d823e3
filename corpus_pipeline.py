"""A training corpus from documents: quality rules, exact copies, near copies, source mix, packing.

Nulls, empty and long texts, ties, repeated rows, empty tables and further columns are treated as the operators'
docstrings say. In short: rows of null or empty text fail the quality rules, so no later stage sees one; rows that
share doc_id and text stay together through exact copies and near copies (the verdict is the id's), and the mix draws
once for all of them; rows without a doc_id can only be dropped by the quality rules or for an equal text with an id;
a table without rows gives none. Further columns of documents are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layoutspark.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from layoutspark.llm.common import materialize, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packing(docs)


#: Each but the last returns the columns of documents.
STAGES = [("quality_rules", good), ("exact_dedup", distinct), ("ngram_join", apart), ("mixing", mixed), ("packing", packed)]

#: Isolation forests, similarity joins and packing can't be said in SQL; a test holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
