"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, source mixing, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import line_dedup, mixing, packing, quality_rules, simhash
from tillstream.llm.common import table, written
from tillstream.llm.queries import token_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, unchanged."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the line chunks that occur before it."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (that of the smallest doc_id), unchanged."""
    return simhash.keep_one(docs).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in training order."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs, token_file())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", mixture),
    ("packing", packed),
]

#: Fingerprints (XXH64) and token ids have no SQL form; the tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
