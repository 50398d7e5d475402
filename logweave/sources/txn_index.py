"""Where the transactions of a log lie, kept beside it as the log grows.

``<log>/_spans`` has, for each data file, the first and last offset of every transaction in it, and one row
without ``txn_id`` for the file itself, so a file without transactions is known to be described.
:meth:`TopicLog.append` and :meth:`TopicLog.describe` add the rows of new files.

A reader of committed records needs two small things: per partition the first offset of a transaction that is
not decided, and which of the aborted transactions lie in what it reads. Both come from the spans and the
markers; the log is read once, for the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.plans.small import settle
from logweave.schema import TP
from logweave.session import exists
from logweave.sources.isolation import last_stable_offsets
from logweave.sources.manifest import files, read_files

SCHEMA = "file string, topic string, partition int, txn_id string, first_offset long, last_offset long"


def _stored(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, f"{path}/_spans"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/_spans")


def _undescribed(spark: SparkSession, path: str) -> DataFrame:
    known = _stored(spark, path).where(F.col("txn_id").isNull()).select("file")
    return files(spark, path).join(known, "file", "left_anti")


def summarise(entries: DataFrame) -> DataFrame:
    """The spans of each ``file`` of ``entries``: one hash aggregate, the row without ``txn_id`` from its groups."""
    per = entries.groupBy("file", *TP, "txn_id").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    outer = F.explode(F.when(F.col("txn_id").isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.array("txn_id", F.lit(None))))
    both = per.select("file", *TP, outer.alias("txn_id"), "first_offset", "last_offset")
    return both.groupBy("file", *TP, "txn_id").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))


def extend(spark: SparkSession, path: str) -> None:
    """Describe the files that have no rows yet. Files that two writers describe at once have equal rows twice."""
    if exists(spark, path):
        new = summarise(read_files(spark, path, _undescribed(spark, path)))
        new.coalesce(1).write.mode("append").parquet(f"{path}/_spans")


def spans(spark: SparkSession, path: str, chosen: Column | None = None) -> DataFrame:
    """(topic, partition, txn_id, first_offset, last_offset) per file, of all files there are, described or not;
    of the topic-partitions that ``chosen`` selects. Evaluated once if it is small."""
    chosen = F.lit(True) if chosen is None else chosen
    there = files(spark, path).join(_stored(spark, path), "file", "left")
    there = settle(there.where(F.col("topic").isNull() | (F.col("txn_id").isNotNull() & chosen)))
    missing, known = there.where(F.col("topic").isNull()).select("file", "full"), there.drop("file", "full")
    if not missing.isEmpty():
        known = known.unionByName(summarise(read_files(spark, path, missing)).drop("file"))
    return known.where(F.col("txn_id").isNotNull() & chosen)


def stable_offsets(spans: DataFrame, txns: DataFrame) -> DataFrame:
    """``isolation.last_stable_offsets`` from the spans."""
    return last_stable_offsets(spans.select(*TP, "txn_id", F.col("first_offset").alias("offset")), txns)


def aborted_within(spans: DataFrame, txns: DataFrame, stable: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(txn_id) of the aborted transactions that a reader meets: in the partitions of ``spans``, below the stable
    offset, at or after the start. All others of the markers need not be compared with any record."""
    met = spans.join(stable, TP, "left").where(F.col("stable_offset").isNull() | (F.col("first_offset") < F.col("stable_offset")))
    if starts is not None:
        met = met.join(starts.select(*TP, "start_offset"), TP, "left")
        met = met.where(F.col("start_offset").isNull() | (F.col("last_offset") >= F.col("start_offset")))
    return txns.where(F.col("state") == "aborted").select("txn_id").distinct().join(met.select("txn_id"), "txn_id", "left_semi")
