"""Transactional visibility.

A transaction is decided by its marker, a row ``(txn_id, state)`` with state ``committed`` or
``aborted``; without one it is still open. Markers and aborted records are never delivered to a
read-committed reader, and nothing at or past the first record of an open transaction is,
in that partition, not even records outside any transaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.plans.small import attach
from logweave.schema import TP
from logweave.sources.starts import read_from


def read_uncommitted(log: DataFrame) -> DataFrame:
    """All data entries."""
    return log.where(~F.col("is_control"))


def last_stable_offsets(log: DataFrame, txns: DataFrame) -> DataFrame:
    """``(topic, partition, stable_offset)`` for partitions with an open transaction.

    Open transactions are found per transaction (one row per id and partition after a partial
    aggregate), so records do not go through the join.
    """
    decided = txns.where(F.col("state").isin("committed", "aborted")).select("txn_id")
    begun = (
        log.where(F.col("txn_id").isNotNull())
        .groupBy("txn_id", *TP)
        .agg(F.min("offset").alias("first_offset"))
    )
    return (
        begun.join(decided, "txn_id", "left_anti")
        .groupBy(*TP)
        .agg(F.min("first_offset").alias("stable_offset"))
    )


def read_committed(log: DataFrame, txns: DataFrame, stable: DataFrame | None = None, aborted: DataFrame | None = None) -> DataFrame:
    """Entries a read-committed reader gets. ``stable``: the result of :func:`last_stable_offsets` if the
    caller has it already; ``aborted``: the aborted transactions (txn_id) that ``log`` can hold. Over a
    stored log ``TopicLog.read_committed`` takes both from its index."""
    if stable is None:
        stable = last_stable_offsets(log, txns)
    if aborted is None:
        aborted = txns.where(F.col("state") == "aborted").select("txn_id").distinct()
    visible = (
        attach(read_uncommitted(log), stable, TP)
        .where(F.col("stable_offset").isNull() | (F.col("offset") < F.col("stable_offset")))
        .drop("stable_offset")
    )
    return attach(visible, aborted, ["txn_id"], "left_anti").select(*log.columns)


def read(
    log: DataFrame, txns: DataFrame | None = None, isolation: str = "read_uncommitted", starts: DataFrame | None = None
) -> DataFrame:
    """The selected topic-partitions as a reader of that level gets them, from the positions of a
    start map on if one is given. ``log`` must be the whole selection: an open transaction that
    began before the start holds back what follows it all the same, so stable offsets are found
    first and the start is applied afterwards."""
    if starts is not None:
        return read_from(read(log, txns, isolation), starts)
    if isolation == "read_uncommitted":
        return read_uncommitted(log)
    if isolation == "read_committed":
        if txns is None:
            raise ValueError("read_committed needs the transaction markers")
        return read_committed(log, txns)
    raise ValueError(f"unknown isolation level {isolation!r}")
