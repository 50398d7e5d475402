"""Operators with state between micro-batches.

State is a small table per batch in the shared folder: batch ``n`` reads what ``n - 1`` left and
writes its own version, overwriting it if the batch is repeated; the last two versions stay. All work inside a batch is the
bounded operator, so a hot partition or sender is as spread out as it is there.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.operators.frontier import commit_frontier, mark_acked
from logweave.operators.records import partition_states, process_by_partition
from logweave.operators.send import assign_offsets, send_results, to_entries
from logweave.operators.transactions import anchored_windows
from logweave.plans.ordered import div, positions
from logweave.plans.small import attach
from logweave.schema import TP, TPO
from logweave.sources import isolation
from logweave.streaming.runs import BatchFunction, overwrite, previous, store_state


def frontier(path: str) -> BatchFunction:
    """Gap-free commits from a stream of ``(kind, topic, partition, offset)``, kind
    ``delivered`` or ``acked``.

    State: delivered records at or past the frontier and whether they are acknowledged; its size
    is the number of unfinished and deferred records. ``<path>/commits`` holds, per batch, the
    commit offset where the frontier moved and the deferred count of every partition.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delivered = batch.where(F.col("kind") == "delivered").select(*TPO)
        acks = batch.where(F.col("kind") == "acked").select(*TPO)
        fresh = mark_acked(delivered, acks)
        held = previous(spark, f"{path}/pending", batch_id)
        if held is not None:
            newly = acks.distinct().withColumn("__now", F.lit(True))
            again = held.join(newly, TPO, "left").select(*TPO, (F.col("acked") | F.col("__now").isNotNull()).alias("acked"))
            fresh = again.unionByName(fresh)
        store_state(fresh, f"{path}/marked", batch_id)
        marked = spark.read.parquet(f"{path}/marked/batch_id={batch_id}")
        result = commit_frontier(marked)
        overwrite(result, f"{path}/commits", batch_id)
        stored = spark.read.parquet(f"{path}/commits/batch_id={batch_id}").select(*TP, "commit_offset")
        rest = attach(marked, stored, TP).where(
            F.col("commit_offset").isNull() | (F.col("offset") >= F.col("commit_offset"))
        )
        store_state(rest.drop("commit_offset"), f"{path}/pending", batch_id)

    return each


def read_committed(path: str, txns: Callable[[], DataFrame]) -> BatchFunction:
    """Read-committed delivery of a stream of log entries; ``txns()`` reads the markers so far.

    ``<path>/visible`` gets every committed entry once, in the batch in which nothing before it
    in its partition is undecided any more. The state is what is still held back.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = previous(spark, f"{path}/held", batch_id)
        store_state(batch if held is None else batch.unionByName(held), f"{path}/candidates", batch_id)
        candidates = spark.read.parquet(f"{path}/candidates/batch_id={batch_id}")
        markers = txns()
        store_state(isolation.last_stable_offsets(candidates, markers), f"{path}/stable", batch_id)
        stable = spark.read.parquet(f"{path}/stable/batch_id={batch_id}")
        overwrite(isolation.read_committed(candidates, markers, stable), f"{path}/visible", batch_id)
        waiting = attach(candidates, stable, TP, "inner").where(F.col("offset") >= F.col("stable_offset"))
        store_state(waiting.drop("stable_offset"), f"{path}/held", batch_id)

    return each


def latest_frontier(commits: DataFrame) -> DataFrame:
    """From ``<path>/commits``: per partition the last commit and the deferred count now."""
    return commits.groupBy(*TP).agg(
        F.max("commit_offset").alias("commit_offset"),
        F.max_by("deferred_count", "batch_id").alias("deferred_count"),
    )


def anchored(path: str, millis: int, time: str = "timestamp") -> BatchFunction:
    """Anchored transaction windows over a stream of requests in time order per sender.

    ``<path>/windows`` holds the requests with their window; the state is one row per sender.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = previous(spark, f"{path}/senders", batch_id)
        overwrite(anchored_windows(batch, millis, time, carry), f"{path}/windows", batch_id)
        done = spark.read.parquet(f"{path}/windows/batch_id={batch_id}")
        ms = F.unix_millis(time)
        state = F.struct(
            F.when(F.col("closes"), ms).otherwise(F.col("window_start")).alias("after"),
            (F.col("txn_no") + F.col("closes").cast("long")).alias("windows"),
        )
        now = done.groupBy("sender_id").agg(F.max_by(state, F.struct(ms, F.col("seq"))).alias("s")).select("sender_id", "s.*")
        if carry is not None:
            idle = carry.join(now, "sender_id", "left_anti")
            now = now.unionByName(idle)
        store_state(now, f"{path}/senders", batch_id)

    return each


def commits_by_size(path: str, n: int) -> BatchFunction:
    """Commit cycles of ``n`` acks per member over a stream of acks in ``ack_seq`` order.

    ``<path>/cycles`` holds partial cycles per batch; :func:`whole_cycles` puts them together.
    The state is the number of acks per member.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = previous(spark, f"{path}/members", batch_id)
        ranked = positions(batch, ["member_id"], ["ack_seq"], "__rank").withColumn("seen", F.lit(0).cast("long"))
        if carry is not None:
            ranked = attach(ranked.drop("seen"), carry, ["member_id"], spread=["ack_seq"])
        at = F.col("__rank") + F.coalesce("seen", F.lit(0))
        cycles = (
            ranked.withColumn("commit_no", div(at, n))
            .groupBy("member_id", "commit_no", *TP)
            .agg(
                F.max_by("offset", "ack_seq").alias("last_offset"),
                F.max("ack_seq").alias("ack_seq"),
                F.count(F.lit(1)).alias("acks"),
            )
        )
        overwrite(cycles, f"{path}/cycles", batch_id)
        counts = spark.read.parquet(f"{path}/cycles/batch_id={batch_id}").groupBy("member_id").agg(F.sum("acks").alias("seen"))
        both = counts if carry is None else carry.unionByName(counts)
        store_state(both.groupBy("member_id").agg(F.sum("seen").alias("seen")), f"{path}/members", batch_id)

    return each


def send(path: str, acks: str = "all") -> BatchFunction:
    """Sending as a stream: requests arrive in ``seq`` order, and offsets go on where the batch before
    ended. ``<path>/entries`` holds the log entries and ``<path>/results`` a result per request; a
    repeated batch writes the same ones again. The state is the end offset of every partition.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends = previous(spark, f"{path}/ends", batch_id)
        overwrite(assign_offsets(batch, ends), f"{path}/sent", batch_id)
        sent = spark.read.schema(batch.schema.add("offset", "long")).parquet(f"{path}/sent/batch_id={batch_id}")
        overwrite(to_entries(sent), f"{path}/entries", batch_id)
        overwrite(send_results(sent, acks), f"{path}/results", batch_id)
        now = sent.where(F.col("offset").isNotNull()).groupBy(*TP).agg((F.max("offset") + 1).alias("end_offset"))
        both = now if ends is None else ends.unionByName(now)
        store_state(both.groupBy(*TP).agg(F.max("end_offset").alias("end_offset")), f"{path}/ends", batch_id)

    return each


def by_partition(
    path: str,
    step: Callable[[pd.DataFrame, object], pd.DataFrame],
    schema: T.StructType | str,
    summary: Callable[[pd.DataFrame], object],
    combine: Callable[[object, object], object],
    initial: object = None,
) -> BatchFunction:
    """``records.process_by_partition`` over a stream whose partitions arrive in offset order.

    ``<path>/rows`` holds what ``step`` returns; the state is one JSON value per partition.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        opening = previous(batch.sparkSession, f"{path}/states", batch_id)
        overwrite(process_by_partition(batch, step, schema, summary, combine, initial, opening=opening), f"{path}/rows", batch_id)
        store_state(partition_states(batch, summary, combine, initial, opening), f"{path}/states", batch_id)

    return each


def whole_cycles(partial: DataFrame) -> DataFrame:
    return partial.groupBy("member_id", "commit_no", *TP).agg(
        (F.max_by("last_offset", "ack_seq") + 1).alias("commit_offset"), F.sum("acks").alias("acks")
    )
