"""Commit offsets from acknowledgements, in-order mode.

``acks(member_id, topic, partition, offset, ack_seq, ack_time)`` has one row per acknowledged
record; ``ack_seq`` is the order in which the member acknowledged and unique per member. The
commit of a partition is its *last acknowledged* offset + 1, which is not always the largest:
acknowledging an offset implies all earlier ones.

Each policy only decides which *cycle* an acknowledgement belongs to. A cycle commits the
partitions acknowledged in it. Commits are taken to complete at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.plans.ordered import Running, div, positions, running
from logweave.plans.small import attach
from logweave.schema import TP
from logweave.session import slice_width

LAST = F.max_by  # the value at the greatest acknowledgement number


def first_acks(acks: DataFrame) -> DataFrame:
    """One row per record: only the first acknowledgement of a record counts."""
    keys = ["member_id", *TP, "offset"]
    rest = [c for c in acks.columns if c not in keys]
    first = F.min_by(F.struct(*rest), "ack_seq").alias("__first")
    return acks.groupBy(*keys).agg(first).select(*keys, *[F.col("__first")[c].alias(c) for c in rest]).select(*acks.columns)


def commit_in_order(acks: DataFrame) -> DataFrame:
    """Commit per partition over all acks, and whether it lies below an offset acked earlier."""
    last = LAST("offset", "ack_seq")
    return acks.groupBy(*TP).agg(
        (last + 1).alias("commit_offset"), (F.max("offset") > last).alias("regressed")
    )


def final_commit(acks: DataFrame) -> DataFrame:
    """What closing commits when nothing was committed before: :func:`commit_in_order`."""
    return commit_in_order(acks).drop("regressed")


def _per_cycle(cycled: DataFrame, cycle: list[str]) -> DataFrame:
    return cycled.groupBy("member_id", *cycle, *TP).agg(
        (LAST("offset", "ack_seq") + 1).alias("commit_offset"), F.count(F.lit(1)).alias("acks")
    )


def commit_by_size(acks: DataFrame, n: int) -> DataFrame:
    """A cycle per ``n`` acks of a member over all its partitions; the rest commits on close."""
    ranked = positions(acks, ["member_id"], ["ack_seq"], "__rank")
    return _per_cycle(ranked.withColumn("commit_no", div(F.col("__rank"), n)), ["commit_no"])


def interval_start(time: Column, interval: str, origin: str = "0 seconds") -> Column:
    """Start of the commit interval ``time`` falls into; ``origin`` shifts the ticks."""
    return F.window(time, interval, startTime=origin)["start"]


def commit_by_interval(acks: DataFrame, interval: str, origin: str = "0 seconds") -> DataFrame:
    """A cycle per interval in which something was acknowledged. A stream with a watermark on
    ``ack_time`` is grouped by the window itself, so closed intervals are appended and forgotten."""
    if acks.isStreaming:
        window = F.window("ack_time", interval, startTime=origin).alias("__w")
        cycles = acks.groupBy("member_id", window, *TP).agg((LAST("offset", "ack_seq") + 1).alias("commit_offset"), F.count(F.lit(1)).alias("acks"))
        return cycles.select("member_id", F.col("__w")["start"].alias("tick"), *TP, "commit_offset", "acks")
    ticked = acks.withColumn("tick", interval_start(F.col("ack_time"), interval, origin))
    return _per_cycle(ticked, ["tick"])


def commit_by_size_or_interval(acks: DataFrame, n: int, interval: str, origin: str = "0 seconds") -> DataFrame:
    """Whichever comes first. A tick commits what is open and restarts the count; a commit by
    size does not move the ticks. Hence a cycle is (tick, n-th group inside the tick)."""
    ticked = acks.withColumn("tick", interval_start(F.col("ack_time"), interval, origin))
    slices = [div(F.col("ack_seq"), slice_width(acks.sparkSession))]
    ranked = positions(ticked, ["member_id", "tick"], ["ack_seq"], "__rank", slices)
    return _per_cycle(ranked.withColumn("commit_no", div(F.col("__rank"), n)), ["tick", "commit_no"])


def commit_each(calls: DataFrame) -> DataFrame:
    """Manual commits. ``calls`` are acks with a flag ``commit``; a commit call carries every
    partition acknowledged since the previous commit call of the member, itself included.
    Acks after the last call are left for :func:`final_commit` (``commit_no`` = -1)."""
    flagged = F.col("commit").cast("long")
    cycles = running(
        calls, ["member_id"], ["ack_seq"], [Running("commit_no", "sum", flagged, inclusive=False)]
    )
    grouped = _per_cycle(cycles, ["commit_no"])
    made = calls.groupBy("member_id").agg(F.count_if("commit").alias("__made"))
    open_cycle = F.col("commit_no") >= F.col("__made")
    return (
        attach(grouped, made, ["member_id"], spread=["commit_no"])
        .withColumn("commit_no", F.when(open_cycle, F.lit(-1)).otherwise(F.col("commit_no")))
        .drop("__made")
    )


def poll_batches(log: DataFrame, n: int, member: Column) -> DataFrame:
    """``batch_id``: the records of a member in polls of ``n``, by offset, then partition.

    A run of offsets holds one record per partition and offset. Slices are narrower by the
    number of partitions, so that one of them stays within the slice width.
    """
    partitions = log.select(*TP).distinct().count()
    width = max(1, slice_width(log.sparkSession) // max(1, partitions))
    ranked = positions(
        log.withColumn("member_id", member), ["member_id"], ["offset", *TP], "delivery_seq", [div(F.col("offset"), width)]
    )
    return ranked.withColumn("batch_id", div(F.col("delivery_seq"), n))


def auto_ack_commits(batched: DataFrame) -> DataFrame:
    """After a batch everything in it is acknowledged: commit = last offset in the batch + 1."""
    return batched.groupBy("member_id", "batch_id", *TP).agg(
        (F.max("offset") + 1).alias("commit_offset"), F.count(F.lit(1)).alias("records")
    )


def txn_offsets(batched: DataFrame) -> DataFrame:
    """Offsets that travel inside the transaction of each batch (last delivered + 1)."""
    return batched.groupBy("member_id", "batch_id", *TP).agg(
        (LAST("offset", "delivery_seq") + 1).alias("commit_offset")
    )
