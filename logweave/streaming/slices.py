"""Gap-free commits from a stream with keyed state: work follows what changes, not what is pending.

The offsets of a partition are cut into slices of ``BITS``. The state of a slice is two bit maps, which
offsets were delivered and which of those are acknowledged; a batch touches only the slices it has events
for, and slices are keys of their own, so a hot partition is spread over all tasks. A slice without
unfinished records leaves the state at once. What remains is one row per slice at or behind the first gap
of its partition, from which the commit offset follows by two small aggregates.

The state lives in the state store of the query (``spark.sql.streaming.stateStore.providerClass``; the
RocksDB provider keeps it out of the heap) and is restored from the query's checkpoint.

Deliveries of a partition come in offset order from batch to batch, in any order inside one.
Acknowledgements of records that were not delivered, or are done, have no effect; repeated events neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logweave.plans.ordered import div
from logweave.plans.small import attach
from logweave.schema import TP
from logweave.session import ship_package
from logweave.streaming.runs import BatchFunction, overwrite, previous, store_state

BITS = 4096

#: Of one slice: its first unfinished offset, how many records are acknowledged before and behind it,
#: the greatest of those before (all of them where nothing is unfinished), and whether the state is new.
SUMMARY = "topic string, partition int, slice long, first_open long, acked_before long, max_before long, acked_behind long, fresh boolean"
_MAPS = "delivered binary, acked binary"
_VALUES = ["first_open", "acked_before", "max_before", "acked_behind"]


def _advance(bits: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, fresh = key[2] * bits, not state.exists
        delivered, acked = (
            [np.zeros(bits, bool)] * 2 if fresh else [np.unpackbits(np.frombuffer(m, np.uint8))[:bits].astype(bool) for m in state.get]
        )
        delivered, asked = delivered.copy(), np.zeros(bits, bool)
        for frame in frames:
            at, is_ack = frame["offset"].to_numpy() - first, frame["is_ack"].to_numpy(bool)
            delivered[at[~is_ack]] = True
            asked[at[is_ack]] = True
        acked = acked | (asked & delivered)
        if not delivered.any():
            return
        unfinished, done = np.flatnonzero(delivered & ~acked), np.flatnonzero(acked)
        if len(unfinished):
            state.update(tuple(np.packbits(m).tobytes() for m in (delivered, acked)))
        elif state.exists:
            state.remove()
        before = done[done < unfinished[0]] if len(unfinished) else done
        yield pd.DataFrame(
            {
                "topic": [key[0]],
                "partition": [key[1]],
                "slice": [key[2]],
                "first_open": pd.array([first + unfinished[0] if len(unfinished) else None], "Int64"),
                "acked_before": [len(before)],
                "max_before": pd.array([first + before[-1] if len(before) else None], "Int64"),
                "acked_behind": [len(done) - len(before)],
                "fresh": [fresh],
            }
        )

    return run


def slice_changes(events: DataFrame, bits: int = BITS) -> DataFrame:
    """From a stream of ``(kind, topic, partition, offset)``, kind ``delivered`` or ``acked``: the new
    summary of every slice that a batch touches (update mode)."""
    ship_package(events.sparkSession)
    keyed = events.where(F.col("kind").isin("delivered", "acked")).select(
        *TP, div(F.col("offset"), bits).alias("slice"), "offset", (F.col("kind") == "acked").alias("is_ack")
    )
    return keyed.groupBy(*TP, "slice").applyInPandasWithState(_advance(bits), SUMMARY, _MAPS, "update", GroupStateTimeout.NoTimeout)


def frontier_of(slices: DataFrame) -> DataFrame:
    """Per partition of slice summaries: its first slice with a gap (null: none), the commit offset and
    the number of deferred acknowledgements."""
    gaps = slices.where("first_open is not null").groupBy(*TP).agg(F.min("slice").alias("gap_slice"))
    behind = F.col("slice") > F.col("gap_slice")
    return (
        attach(slices, gaps, TP)
        .groupBy(*TP)
        .agg(
            F.min("gap_slice").alias("gap_slice"),
            (F.max(F.when(~F.coalesce(behind, F.lit(False)), F.col("max_before"))) + 1).alias("commit_offset"),
            F.sum(F.when(behind, F.col("acked_before")).otherwise(0) + F.col("acked_behind")).alias("deferred_count"),
        )
    )


def keyed_frontier(path: str) -> BatchFunction:
    """Sink of :func:`slice_changes`: ``<path>/commits`` holds, per batch, the commit offset and the
    deferred count of the partitions that have unfinished or changed slices.

    The batch is evaluated once; everything after that reads stored tables, so a repeated batch
    writes the same again.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = previous(spark, f"{path}/slices", batch_id)
        now = batch
        if held is not None:
            # a slice whose state had left goes on where its last row ended
            old = held.select(*TP, "slice", F.struct(*_VALUES).alias("__old"))
            both = batch.withColumn("__new", F.lit(True)).join(old, [*TP, "slice"], "full")
            is_new, goes_on = F.col("__new").isNotNull(), F.col("fresh") & F.col("__old").isNotNull()
            merged = {
                "first_open": F.col("first_open"),
                "acked_before": F.col("acked_before") + F.when(goes_on, F.col("__old.acked_before")).otherwise(0),
                "max_before": F.when(goes_on, F.greatest("max_before", "__old.max_before")).otherwise(F.col("max_before")),
                "acked_behind": F.col("acked_behind"),
            }
            now = both.select(*TP, "slice", *[F.when(is_new, v).otherwise(F.col(f"__old.{c}")).alias(c) for c, v in merged.items()])
        store_state(now.select(*TP, "slice", *_VALUES), f"{path}/changed", batch_id)
        changed = spark.read.parquet(f"{path}/changed/batch_id={batch_id}")
        store_state(frontier_of(changed), f"{path}/partitions", batch_id)
        partitions = spark.read.parquet(f"{path}/partitions/batch_id={batch_id}")
        overwrite(partitions.drop("gap_slice"), f"{path}/commits", batch_id)
        rest = attach(changed, partitions.select(*TP, "gap_slice"), TP, "inner").where("slice >= gap_slice")
        store_state(rest.drop("gap_slice"), f"{path}/slices", batch_id)

    return each
