"""The corpus pipeline: quality rules, line deduplication, near-duplicate removal, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor
kept, and returns a DataFrame; all but the last return the columns of ``documents``.
Null columns, empty texts, repeated rows and extra columns are handled as the
operators document; an empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import materialize
from vigil.llm.line_dedup import dedup_lines_of
from vigil.llm.packing import pack
from vigil.llm.quality import keep_good
from vigil.llm.queries import BYTE_BPE
from vigil.llm.simhash import near_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more are cut out of the texts."""
    return dedup_lines_of(docs, min_words=50)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup(docs, shingle=4, max_bits=4)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 1024."""
    return pack(docs, BYTE_BPE, capacity=1024, end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the fingerprints nor the tokenizer: tests/llm compares the stages
#: with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
