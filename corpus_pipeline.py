"""The corpus pipeline: quality, recurring lines, near duplicates, benchmark passages, packing.

Each stage works on all that its predecessor kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plotkeep.llm import decontaminate, line_templates, packing, quality_crf, superminhash
from plotkeep.llm.scratch import kept


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.accepted(docs, quality_crf.train(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs in different surroundings."""
    return line_templates.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return superminhash.one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024 ids, as pieces of documents with their ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packing", pack),
]

# A fitted classifier, signatures and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
