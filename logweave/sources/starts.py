"""Where reading starts: reset policy, committed offsets, explicit seeks, timestamps, resolvers.

Every function here produces a start map ``(topic, partition, start_offset)``;
:func:`read_from` applies one to a log. Functions that need begin and end of the partitions take
``bounds``, what ``TopicLog.bounds`` says of the same selection; then the log is not read for them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.plans.small import bounded, local, salted
from logweave.schema import TP
from logweave.sources.catalog import latest_commits, list_partitions, offsets_for_time, topic_bounds

#: Start maps up to this many partitions become a filter that reaches the parquet scan.
LITERAL_PARTITIONS = 128


def _literal(starts: list[dict]) -> Column:
    """``(topic, partition)`` and offset limits as one predicate of literals."""
    by_limit: dict[tuple[str, int], list[int]] = {}
    for row in starts:
        by_limit.setdefault((row["topic"], row["start_offset"]), []).append(row["partition"])
    parts = [
        (F.col("topic") == topic) & F.col("partition").isin(*partitions) & (F.col("offset") >= limit)
        for (topic, limit), partitions in by_limit.items()
    ]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def read_from(log: DataFrame, starts: DataFrame, unlisted: str | None = None) -> DataFrame:
    """Entries at or past the start offset of their partition; of several offsets given for one
    partition the smallest counts.

    ``unlisted`` says what happens to partitions the map does not name: ``drop``, the default for
    a bounded log, or ``read`` from their first entry, the default for a stream, where they are
    partitions that appeared after the map was made.

    A small start map turns into literals: the scan then skips directories and row groups.
    Otherwise the map is joined - broadcast within the checked limit, salted beyond it.
    """
    unlisted = unlisted or ("read" if log.isStreaming else "drop")
    if unlisted not in ("read", "drop"):
        raise ValueError(f"unknown policy {unlisted!r} for unlisted partitions")
    starts = starts.groupBy(*TP).agg(F.min("start_offset").alias("start_offset"))
    table = bounded(starts)
    if table is not None and table.num_rows <= LITERAL_PARTITIONS:
        rows = table.to_pylist()
        past = _literal(rows)
        return log.where(past if unlisted == "drop" else past | ~_listed(rows))
    how = "left" if unlisted == "read" else "inner"
    joined = log.join(local(starts, table), TP, how) if table is not None else salted(log, starts, TP, how)
    return joined.where(F.col("offset") >= F.coalesce("start_offset", F.lit(0))).select(*log.columns)


def _listed(starts: list[dict]) -> Column:
    by_topic: dict[str, list[int]] = {}
    for row in starts:
        by_topic.setdefault(row["topic"], []).append(row["partition"])
    parts = [(F.col("topic") == topic) & F.col("partition").isin(*partitions) for topic, partitions in by_topic.items()]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def reset_starts(log: DataFrame, reset: str = "earliest", bounds: DataFrame | None = None) -> DataFrame:
    """Begin (``earliest``) or end (``latest``) of every partition. The begin is written as 0, which
    lies at or before every entry, so that only the directories are read for it."""
    if reset == "earliest":
        return (list_partitions(log) if bounds is None else bounds.select(*TP)).withColumn("start_offset", F.lit(0).cast("long"))
    if reset != "latest":
        raise ValueError(f"unknown reset policy {reset!r}")
    return _bounds(log, bounds).select(*TP, F.col("end_offset").alias("start_offset"))


def _bounds(log: DataFrame, bounds: DataFrame | None) -> DataFrame:
    return topic_bounds(log) if bounds is None else bounds


def seek_to_beginning(log: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    return reset_starts(log, "earliest", bounds)


def seek_to_end(log: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    return reset_starts(log, "latest", bounds)


def resume(log: DataFrame, commits: DataFrame, group: str, reset: str = "earliest", bounds: DataFrame | None = None) -> DataFrame:
    """The committed offset (already the *next* one to read), else the reset policy."""
    return (
        reset_starts(log, reset, bounds)
        .withColumnRenamed("start_offset", "fallback")
        .join(latest_commits(commits, group), TP, "left")
        .select(*TP, F.coalesce("commit_offset", "fallback").alias("start_offset"))
    )


def seek(log: DataFrame, offset: int | DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """One explicit offset for all partitions, or a map ``(topic, partition, start_offset)``;
    partitions the map does not name stay at their begin.

    Negative offsets, offsets past the end and partitions that the log does not have are errors; the
    end itself is allowed.
    """
    bounds = _bounds(log, bounds)
    if isinstance(offset, DataFrame):
        named = offset.groupBy(*TP).agg(F.min("start_offset").alias("start_offset"))
        starts = bounds.join(named, TP, "full").withColumn("start_offset", F.coalesce("start_offset", "begin_offset"))
    else:
        starts = bounds.withColumn("start_offset", F.lit(offset).cast("long"))
    wrong = F.col("end_offset").isNull() | (F.col("start_offset") < 0) | (F.col("start_offset") > F.col("end_offset"))
    message = F.concat(
        F.lit("cannot seek "), "topic", F.lit("-"), "partition", F.lit(" to "), "start_offset"
    )
    checked = F.when(wrong, F.raise_error(message).cast("long")).otherwise(F.col("start_offset"))
    return starts.select(*TP, checked.alias("start_offset"))


def seek_to_timestamp(log: DataFrame, at: datetime | str) -> DataFrame:
    """Per partition the first entry stamped at or after ``at`` (else the end). Later entries
    are read even when their own stamp is earlier."""
    return offsets_for_time(log, at)


def resolve(log: DataFrame, resolver: Callable[[DataFrame], DataFrame], bounds: DataFrame | None = None) -> DataFrame:
    """A user function from ``(topic, partition, begin_offset, end_offset, position)`` to a
    start map, applied when partitions are assigned. Partitions it leaves out start at their position."""
    assigned = _bounds(log, bounds).drop("entries").withColumn("position", F.col("begin_offset"))
    chosen = resolver(assigned).select(*TP, F.col("start_offset").alias("chosen"))
    return assigned.join(chosen, TP, "left").select(
        *TP, F.coalesce("chosen", "position").alias("start_offset")
    )
