"""At-most-once commit ledgers, exactly-once outcomes and delivery audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.operators.transactions import txn_status
from logweave.plans.chains import hits
from logweave.plans.small import attach
from logweave.schema import TP


def at_most_once_ledger(log: DataFrame, ahead: int, contiguous: bool | None = None) -> DataFrame:
    """How each offset is committed *before* its record is dispatched.

    With ``c`` the last committed value (-1 at the start): ``offset >= c`` commits and waits
    (``sync``); else ``c - offset >= ahead div 2`` commits without waiting (``async``); else
    nothing is committed (``none``). A commit stores ``offset + ahead + 1``. Commits are taken
    to complete at once. ``committed`` is the value in force when the record is dispatched.

    Without offset gaps the previous record always commits, so ``c = offset + ahead`` and the
    ledger is a projection. With gaps a record may commit nothing and decisions form a chain,
    which is walked block by block. Which of the two holds is looked up, one aggregate over the
    offsets; ``contiguous=False`` walks without looking, ``contiguous=True`` insists on no gaps and
    raises if there are any.
    """
    if contiguous is not False:
        spans = log.groupBy(*TP).agg((F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("gaps"))
        gaps = spans.agg(F.max("gaps")).first()[0] or 0
        if gaps and contiguous:
            raise ValueError("offsets have gaps: control entries, or a filtered log")
        contiguous = not gaps
    value = F.col("offset") + ahead + 1
    if contiguous:
        first = log.groupBy(*TP).agg(F.min("offset").alias("__first"))
        waits = F.lit(ahead == 0) | (F.col("offset") == F.col("__first"))
        return attach(log.select(*TP, "offset"), first, TP).select(
            *TP, "offset", F.when(waits, "sync").otherwise("async").alias("kind"), value.alias("committed")
        )
    walked = hits(
        log.select(*TP, "offset"), TP, "offset", near=ahead + 1 - ahead // 2, far=ahead + 1, first_hits=True
    )
    late = F.col("last_hit").isNull() | (F.col("offset") >= F.col("last_hit") + ahead + 1)
    kind = F.when(~F.col("is_hit"), "none").when(late, "sync").otherwise("async")
    committed = F.when(F.col("is_hit"), value).otherwise(F.col("last_hit") + ahead + 1)
    return walked.select(*TP, "offset", kind.alias("kind"), committed.alias("committed"))


def commit_ahead_undo(ledger: DataFrame) -> DataFrame:
    """Partitions committed further than dispatched when the member closes, and the offset
    they are set back to: last dispatched + 1."""
    return (
        ledger.groupBy(*TP)
        .agg((F.max("offset") + 1).alias("rewind_to"), F.max_by("committed", "offset").alias("committed"))
        .where(F.col("committed") > F.col("rewind_to"))
    )


def exactly_once_outcome(batched: DataFrame, failed) -> DataFrame:
    """State of each batch of a read-process-write loop in which records where ``failed`` holds
    abort their batch; the loop ends there. One row per member and batch."""
    return txn_status(
        batched.select(
            F.col("member_id").alias("sender_id"),
            F.col("delivery_seq").alias("seq"),
            F.col("batch_id").alias("txn_no"),
            F.when(failed, F.lit("ProcessingError")).alias("error"),
        )
    ).withColumnsRenamed({"sender_id": "member_id", "txn_no": "batch_id", "requests": "records"})


def delivery_audit(log: DataFrame, dispatched: DataFrame, commits: DataFrame) -> DataFrame:
    """What a crash costs per partition: records processed but not committed are delivered
    again, records committed but never dispatched are lost.

    ``dispatched(topic, partition, offset)``, ``commits(topic, partition, commit_offset)``.
    """
    done = dispatched.select(*TP, "offset").distinct().withColumn("__done", F.lit(True))
    seen = log.select(*TP, "offset").join(done, [*TP, "offset"], "left")
    committed = F.col("offset") < F.coalesce(F.col("commit_offset"), F.lit(0))
    return (
        attach(seen, commits.select(*TP, "commit_offset"), TP)
        .groupBy(*TP)
        .agg(
            F.count_if(F.col("__done").isNotNull() & ~committed).alias("redelivered"),
            F.count_if(F.col("__done").isNull() & committed).alias("lost"),
        )
    )
