"""A training corpus from ``documents``: good documents, one of each near-duplicate group, free of
benchmark passages, mixed to target weights, dealt into shards.

Each stage gets all rows that the one before kept, judges them on their own, and returns the
columns of ``documents``; the last one adds shard and slot. Mixing repeats documents, so a doc_id
may come more than once in the result.

Edge cases: null, blank and short texts fail the quality rules; texts of any length are judged whole; of rows
equal in doc_id and text one stays before mixing; null ids and sources are values like any other; an empty table
gives an empty table; extra columns are kept, but ``shard`` and ``slot`` of the input give way to the new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import decontaminate, mixing, quality, sharding, shingles
from logweave.llm.common import stage
from logweave.llm.queries import MAX_EPOCHS, SHARDS, WEIGHTS


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingles.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, WEIGHTS, MAX_EPOCHS)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.number(sharding.assign(docs.drop("shard", "slot"), "doc_id", SHARDS), ["doc_id", "source", "n_chars"])


STAGES = [
    ("quality rules", good_documents),
    ("simhash and shingle near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("source mixing", mixed_sources),
    ("sharding", in_shards),
]

#: SQL has no XXH64, so the second stage cannot be written in it; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
