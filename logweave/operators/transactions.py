"""Transactions over bounded request tables: grouping, outcome, entries with markers.

Requests carry ``sender_id, seq, txn_no`` besides the columns of ``operators.send``.
Transactions of one sender run strictly one after the other. The first one that fails is
aborted and the later ones never start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators.send import assign_offsets, to_entries
from logweave.plans.chains import hits
from logweave.plans.ordered import div, positions
from logweave.plans.small import attach
from logweave.schema import TP
from logweave.session import slice_width


def count_windows(requests: DataFrame, n: int) -> DataFrame:
    """``txn_no``: consecutive requests of a sender in groups of ``n``."""
    ranked = positions(requests, ["sender_id"], ["seq"], "__rank")
    return ranked.withColumn("txn_no", div(F.col("__rank"), n)).drop("__rank")


def anchored_windows(
    requests: DataFrame, millis: int, time: str = "timestamp", carry: DataFrame | None = None
) -> DataFrame:
    """``txn_no`` by age: the first request at or past the deadline is the last one of its
    window, and the next deadline is its own time plus ``millis``.

    The first deadline counts from the first request of the sender, or from ``carry``
    (``sender_id, after`` in epoch millis, ``windows`` closed so far) when a stream continues.
    Also adds ``closes`` (this request ends its window) and ``window_start`` (epoch millis).
    Requests are in time order; equal times go by ``seq``.
    """
    stamped = requests.withColumn("__ms", F.unix_millis(time))
    nodes = stamped.groupBy("sender_id", "__ms").agg(F.min("seq").alias("__first"))
    per_ms = hits(
        nodes, ["sender_id"], "__ms", near=0, far=millis, first_hits=False, carry=carry, keep=["__first"]
    )
    closes = F.col("is_hit") & (F.col("seq") == F.col("__first"))
    after_close = F.col("is_hit") & (F.col("seq") != F.col("__first"))
    out = stamped.join(per_ms, ["sender_id", "__ms"]).withColumns(
        {
            "txn_no": F.col("hits_before") + after_close.cast("long"),
            "closes": closes,
            "window_start": F.when(after_close, F.col("__ms")).otherwise(F.col("last_hit")),
        }
    )
    if carry is not None:
        out = attach(out, carry.select("sender_id", "windows"), ["sender_id"], spread=["seq"]).withColumn(
            "txn_no", F.col("txn_no") + F.coalesce("windows", F.lit(0))
        )
    return out.select(*requests.columns, "txn_no", "closes", "window_start")


def txn_status(requests: DataFrame) -> DataFrame:
    """State per transaction: committed, aborted or not_started, with its request count."""
    per_txn = requests.groupBy("sender_id", "txn_no").agg(
        F.count(F.lit(1)).alias("requests"),
        F.bool_or(F.col("error").isNotNull()).alias("__bad"),
        F.max("seq").alias("last_seq"),
    )
    first_abort = per_txn.where("__bad").groupBy("sender_id").agg(F.min("txn_no").alias("__abort"))
    state = (
        F.when(F.col("__abort").isNull() | (F.col("txn_no") < F.col("__abort")), "committed")
        .when(F.col("txn_no") == F.col("__abort"), "aborted")
        .otherwise("not_started")
    )
    return (
        attach(per_txn, first_abort, ["sender_id"], spread=["txn_no"])
        .withColumn("state", state)
        .drop("__abort", "__bad")
    )


def txn_id(sender: Column, number: Column) -> Column:
    return F.concat_ws("-", sender.cast("string"), number.cast("string"))


def send_transactional(requests: DataFrame, ends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(entries, markers)`` of a run of transactions.

    Started transactions write their accepted requests, then one control entry in every
    partition they touched. ``markers(txn_id, state)`` is what a read-committed reader needs.
    In an aborted transaction only requests before the failure were sent.
    """
    status = txn_status(requests)
    started = status.where(F.col("state") != "not_started").select("sender_id", "txn_no", "last_seq", "state")
    first_bad = (
        requests.where(F.col("error").isNotNull()).groupBy("sender_id").agg(F.min("seq").alias("__cut"))
    )
    sent = (
        attach(requests, first_bad, ["sender_id"], spread=["seq"])
        .where(F.col("__cut").isNull() | (F.col("seq") < F.col("__cut")))
        .drop("__cut")
        .withColumns({"txn_id": txn_id(F.col("sender_id"), F.col("txn_no")), "is_control": F.lit(False)})
    )
    touched = sent.groupBy("sender_id", "txn_no", "txn_id", *TP).agg(F.max("timestamp").alias("timestamp"))
    control = touched.join(started.drop("state"), ["sender_id", "txn_no"]).select(
        "sender_id",
        "txn_no",
        "txn_id",
        *TP,
        "timestamp",
        F.col("last_seq").alias("seq"),
        F.lit(True).alias("is_control"),
        F.lit(None).cast("string").alias("error"),
    )
    both = sent.unionByName(control, allowMissingColumns=True)
    slices = [div(F.col("seq"), slice_width(requests.sparkSession))]
    entries = to_entries(assign_offsets(both, ends, ("seq", "is_control"), slices))
    markers = started.select(txn_id(F.col("sender_id"), F.col("txn_no")).alias("txn_id"), "state")
    return entries, markers
