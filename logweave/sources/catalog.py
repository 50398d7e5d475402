"""What a log contains: topics, partitions, offset bounds, time lookup, committed positions, lag."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.plans.small import attach, settle
from logweave.schema import TP


def list_partitions(log: DataFrame, topic: str | None = None) -> DataFrame:
    """Distinct ``(topic, partition)``; an unknown ``topic`` is an error."""
    found = log.select(*TP).distinct()
    if topic is None:
        return found
    found = found.where(F.col("topic") == topic)
    if found.isEmpty():
        raise ValueError(f"unknown topic {topic!r}")
    return found


def topic_bounds(log: DataFrame) -> DataFrame:
    """Begin offset, end offset (last + 1) and entry count per partition, control entries included."""
    return log.groupBy(*TP).agg(
        F.min("offset").alias("begin_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("entries"),
    )


def _first_at_or_after(limit: Column) -> Column:
    return F.min(F.when(F.col("timestamp") >= limit, F.col("offset")))


def offsets_for_time(log: DataFrame, at: datetime | str) -> DataFrame:
    """Per partition the earliest offset stamped at or after ``at``, else the end offset.

    The time filter reaches the scan; ends are looked up only in partitions without such an entry.
    """
    late = log.where(F.col("timestamp") >= F.lit(at).cast("timestamp"))
    found = late.groupBy(*TP).agg(F.min("offset").alias("start_offset"))
    located = settle(list_partitions(log).join(found, TP, "left"))
    rest = located.where(F.col("start_offset").isNull()).select(*TP)
    ends = attach(log.select(*TP, "offset"), rest, TP, "left_semi").groupBy(*TP).agg((F.max("offset") + 1).alias("start_offset"))
    return located.where(F.col("start_offset").isNotNull()).unionByName(ends)


def offsets_for_times(log: DataFrame, targets: DataFrame) -> DataFrame:
    """Lookup with an own time per partition: ``targets(topic, partition, target)``.

    Null where no entry is late enough. Partitions without a target are left out.
    """
    return (
        attach(log.select(*TP, "offset", "timestamp"), targets, TP, "inner")
        .groupBy(*TP)
        .agg(_first_at_or_after(F.col("target")).alias("found_offset"))
    )


def latest_commits(commits: DataFrame, group: str) -> DataFrame:
    """The newest committed offset per partition of ``commits(group_id, topic, partition,
    commit_offset, commit_no)``."""
    return (
        commits.where(F.col("group_id") == group)
        .groupBy(*TP)
        .agg(F.max_by("commit_offset", "commit_no").alias("commit_offset"))
    )


def consumer_lag(
    log: DataFrame | None, commits: DataFrame, group: str, reset: str = "earliest", bounds: DataFrame | None = None
) -> DataFrame:
    """Bounds, committed offset (null if none), position and lag = end - position per partition.
    ``bounds``: of the same selection, from the manifest; then the log is not needed."""
    fallback = {"earliest": "begin_offset", "latest": "end_offset"}[reset]
    bounds = topic_bounds(log) if bounds is None else bounds
    position = F.coalesce("commit_offset", fallback)
    return (
        bounds.join(latest_commits(commits, group), TP, "left")
        .withColumn("position", position)
        .withColumn("lag", F.col("end_offset") - F.col("position"))
        .drop("entries")
    )
