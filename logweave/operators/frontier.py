"""Commit offsets from acknowledgements in any order: the gap-free frontier.

A partition may commit only up to the longest run of *delivered* offsets that are all
acknowledged. Acknowledgements beyond the first missing one are deferred. Offsets are not
assumed to be contiguous, because control entries take up offsets that are never delivered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.plans.small import attach
from logweave.schema import TP, TPO


def mark_acked(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """``delivered`` plus ``acked``. Acks of offsets that were not delivered have no effect.

    The join key contains the offset, so a hot partition spreads over all tasks.
    """
    acked = acks.select(*TPO).distinct().withColumn("acked", F.lit(True))
    return delivered.join(acked, TPO, "left").withColumn("acked", F.coalesce("acked", F.lit(False)))


def commit_frontier(marked: DataFrame, revoked: DataFrame | None = None) -> DataFrame:
    """Per partition of ``marked(topic, partition, offset, acked)``: the commit offset (null =
    nothing to commit) and the number of deferred acks. ``revoked(topic, partition)`` drop out.

    Two aggregates with map-side combine. The first one reads only unacknowledged records and
    yields one row per partition.
    """
    if revoked is not None:
        marked = attach(marked, revoked.select(*TP).distinct(), TP, "left_anti")
    gaps = marked.where(~F.col("acked")).groupBy(*TP).agg(F.min("offset").alias("__gap"))
    ready = F.col("acked") & (F.col("__gap").isNull() | (F.col("offset") < F.col("__gap")))
    return (
        attach(marked, gaps, TP)
        .groupBy(*TP)
        .agg(
            (F.max(F.when(ready, F.col("offset"))) + 1).alias("commit_offset"),
            F.count_if(F.col("acked") & (F.col("offset") > F.col("__gap"))).alias("deferred_count"),
        )
    )


def deferred_pause(frontier: DataFrame, max_deferred: int, member) -> DataFrame:
    """Deferred acks per member over all its partitions, and whether that pauses delivery
    (reaching the limit pauses)."""
    return (
        frontier.withColumn("member_id", member)
        .groupBy("member_id")
        .agg(F.sum("deferred_count").alias("deferred_total"))
        .withColumn("would_pause", F.col("deferred_total") >= max_deferred)
    )


def in_flight(marked: DataFrame, member) -> DataFrame:
    """Delivered, acknowledged and still unacknowledged records per member."""
    return (
        marked.withColumn("member_id", member)
        .groupBy("member_id")
        .agg(
            F.count(F.lit(1)).alias("delivered"),
            F.count_if("acked").alias("acknowledged"),
            F.count_if(~F.col("acked")).alias("in_flight"),
        )
    )
