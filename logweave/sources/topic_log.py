"""A topic log: parquet files laid out as ``topic=<name>/partition=<n>``.

Selecting topics or partitions is a filter on directory columns, so Spark lists and reads only
the directories that match. Each file holds a run of offsets in order, which gives the parquet
row-group statistics their use when an offset filter is pushed down.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from logweave.plans.small import bounded, relation, settle
from logweave.schema import LOG, LOG_COLUMNS, TP
from logweave.sources import isolation, manifest, txn_index
from logweave.sources.starts import read_from


def selection(
    topics: Iterable[str] | None = None,
    pattern: str | None = None,
    assignment: Iterable[tuple[str, int]] | None = None,
) -> Column:
    """The predicate of one subscription; exactly one way of naming it must be used.

    ``pattern`` has to match the whole topic name. ``assignment`` lists topic-partitions.
    """
    given = [name for name, v in (("topics", topics), ("pattern", pattern), ("assignment", assignment)) if v is not None]
    if len(given) != 1:
        raise ValueError(f"give exactly one of topics, pattern, assignment (got {given or 'none'})")
    if topics is not None:
        return F.col("topic").isin(*list(topics))
    if pattern is not None:
        re.compile(pattern)
        return F.col("topic").rlike(f"^(?:{pattern})$")
    wanted: dict[str, list[int]] = {}
    for topic, partition in assignment:
        wanted.setdefault(topic, []).append(partition)
    parts = [(F.col("topic") == t) & F.col("partition").isin(*p) for t, p in wanted.items()]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


class TopicLog:
    """The log stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, topics=None, pattern=None, assignment=None) -> DataFrame:
        """All entries of the selected topic-partitions, control entries included."""
        frame = self.spark.read.schema(LOG).parquet(self.path)
        return frame.where(selection(topics, pattern, assignment)).select(*LOG_COLUMNS)

    def all(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.path).select(*LOG_COLUMNS)

    def reader(self, max_files: int | None = None) -> DataStreamReader:
        reader = self.spark.readStream.schema(LOG)
        return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)

    def read_stream(self, topics=None, pattern=None, assignment=None, max_files: int | None = None) -> DataFrame:
        """The streaming form of :meth:`read`. ``max_files`` bounds one micro-batch; topics that
        start to match a pattern later are picked up when their directories appear."""
        return self.reader(max_files).parquet(self.path).where(selection(topics, pattern, assignment))

    def append(self, entries: DataFrame) -> None:
        """Write entries whose offsets are already assigned (see ``operators.send``), in offset order
        inside every file, and describe the new files in the manifest."""
        entries.sortWithinPartitions(*TP, "offset").write.mode("append").partitionBy(*TP).parquet(self.path)
        self.describe()

    def describe(self) -> None:
        """Add the files that others wrote to the manifest and to the index of transactions (see
        ``sources.manifest`` and ``sources.txn_index``)."""
        manifest.extend(self.spark, self.path)
        txn_index.extend(self.spark, self.path)

    def _described(self, topics=None, pattern=None, assignment=None) -> DataFrame:
        rows = manifest.described(self.spark, self.path)
        everything = topics is pattern is assignment is None
        return rows if everything else rows.where(selection(topics, pattern, assignment))

    def bounds(self, topics=None, pattern=None, assignment=None) -> DataFrame:
        """``catalog.topic_bounds`` of the selection (default: all), from the manifest."""
        return manifest.bounds(self._described(topics, pattern, assignment))

    def offsets_for_times(self, targets: DataFrame) -> DataFrame:
        """``catalog.offsets_for_times`` by the time index: ``targets(topic, partition, target)``."""
        return manifest.first_at_or_after(self.spark, self.path, self._described(), targets)

    def read_committed(self, txns: DataFrame, topics=None, pattern=None, assignment=None, starts: DataFrame | None = None) -> DataFrame:
        """``isolation.read(..., "read_committed", starts)`` of the selection. Open and aborted transactions come
        from the index, so the log is read once, from the start map on."""
        spans = txn_index.spans(self.spark, self.path, selection(topics, pattern, assignment))
        few = bounded(txns.select("txn_id", "state"))
        markers = txns if few is None else relation(txns.select("txn_id", "state"), few)
        stable = settle(txn_index.stable_offsets(spans, markers))
        if few is None:
            aborted = txn_index.aborted_within(spans, markers, stable, starts)
        else:
            aborted = markers.where(F.col("state") == "aborted").select("txn_id")
        entries = self.read(topics, pattern, assignment)
        return isolation.read_committed(entries if starts is None else read_from(entries, starts), markers, stable, aborted)


def kafka_options(
    servers: str,
    topics=None,
    pattern=None,
    assignment=None,
    starting: str | dict | None = None,
    by_timestamp: bool = False,
    isolation: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")`` that select the same records.

    ``starting`` is ``"earliest"``, ``"latest"`` or ``{topic: {partition: offset_or_millis}}``.
    """
    import json

    selection(topics, pattern, assignment)
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": "true"}
    if topics is not None:
        options["subscribe"] = ",".join(topics)
    elif pattern is not None:
        options["subscribePattern"] = pattern
    else:
        wanted: dict[str, list[int]] = {}
        for topic, partition in assignment:
            wanted.setdefault(topic, []).append(partition)
        options["assign"] = json.dumps(wanted)
    if starting is not None:
        key = "startingOffsetsByTimestamp" if by_timestamp else "startingOffsets"
        options[key] = starting if isinstance(starting, str) else json.dumps(
            {t: {str(p): o for p, o in parts.items()} for t, parts in starting.items()}
        )
    if isolation is not None:
        options["kafka.isolation.level"] = isolation
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options
