"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet before
the next stage reads it. All but the last keep the columns of documents. Quality rules drop whole
documents, line dedup shortens texts, near-dedup keeps one document of each group of near copies (0.8 of
their five-word shingles), decontamination drops documents that hold a benchmark item, and packing lays out what is left.

Null texts count as empty and go at the first stage; repeated rows of documents are copies of each
other, so near-dedup keeps one; empty tables pass through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from admill.llm import decontam, line_templates, near_copies, packing, quality
from admill.llm.common import scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.drop_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Components of near copies, seeded alignment and packing are not SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
