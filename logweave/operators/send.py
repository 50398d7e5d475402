"""Sending: offsets, results, error policies, ordered chains.

A request row has ``sender_id, seq, topic, partition, timestamp, key, value, headers``,
a ``correlation`` of any type that is not part of the log entry, and ``error``: null, or the
name of the exception this send meets (see :func:`check_topics`). One sender sends one request
at a time in ``seq`` order; ``seq`` is a counter, unique over the requests of a sender.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.plans.ordered import Running, div, running
from logweave.plans.small import attach
from logweave.schema import LOG_COLUMNS, TP
from logweave.session import slice_width

# Exception names that always stop a sender.
FATAL = ["AuthenticationException", "ProducerFencedException"]
UNKNOWN_TOPIC = "InvalidTopicException"


def check_topics(requests: DataFrame, topics: Iterable[str]) -> DataFrame:
    """Requests to a topic that does not exist fail; an error already set is kept."""
    missing = F.when(~F.col("topic").isin(*topics), F.lit(UNKNOWN_TOPIC))
    known = F.col("error") if "error" in requests.columns else F.lit(None).cast("string")
    return requests.withColumn("error", F.coalesce(known, missing))


def assign_offsets(
    requests: DataFrame, ends: DataFrame | None = None, order: Sequence[str] = ("seq",), slice_by=None, senders: int = 1
) -> DataFrame:
    """``requests`` plus ``offset``: end offset of the partition + arrival rank.

    Failed requests get null and take up no offset. ``ends(topic, partition, end_offset)``
    describes a log that already has entries. Senders that count for themselves may use one
    ``seq`` several times in a partition; then the sender decides, and ``senders``, the number of
    them, narrows the slices accordingly.
    """
    if "sender_id" in requests.columns and "sender_id" not in order:
        width = max(1, slice_width(requests.sparkSession) // senders)
        slice_by = slice_by or [div(F.col(order[0]).cast("long"), width)]
        order = (*order, "sender_id")
    sent = F.col("error").isNull()
    ranked = running(
        requests, TP, order, [Running("__rank", "sum", sent.cast("long"), inclusive=False)], slice_by
    )
    base = F.lit(0).cast("long")
    if ends is not None:
        ranked = attach(ranked, ends.select(*TP, F.col("end_offset").alias("__end")), TP, spread=["seq"])
        base = F.coalesce("__end", base)
    return ranked.withColumn("offset", F.when(sent, base + F.col("__rank"))).select(*requests.columns, "offset")


def to_entries(sent: DataFrame) -> DataFrame:
    """Log entries of the requests that got an offset; the correlation stays behind."""
    defaults = {
        "timestampType": F.lit(0),
        "txn_id": F.lit(None).cast("string"),
        "is_control": F.lit(False),
    }
    missing = {n: c for n, c in defaults.items() if n not in sent.columns}
    return sent.where(F.col("offset").isNotNull()).withColumns(missing).select(*LOG_COLUMNS)


def send_results(sent: DataFrame, acks: str = "all") -> DataFrame:
    """One result per request: metadata or exception, never both. Without broker
    acknowledgement (``acks="0"``) the offset is not known and reads -1."""
    ok = F.col("error").isNull()
    offset = F.lit(-1).cast("long") if acks == "0" else F.col("offset")
    return sent.select(
        "correlation",
        F.when(ok, F.col("topic")).alias("topic"),
        F.when(ok, F.col("partition")).alias("partition"),
        F.when(ok, offset).alias("offset"),
        F.when(ok, F.col("timestamp")).alias("timestamp"),
        F.col("error").alias("exception"),
    )


def _before_first(requests: DataFrame, bad) -> DataFrame:
    """Per sender the requests before the first ``bad`` one."""
    cut = requests.where(bad).groupBy("sender_id").agg(F.min("seq").alias("__cut"))
    return (
        attach(requests, cut, ["sender_id"], spread=["seq"])
        .where(F.col("__cut").isNull() | (F.col("seq") < F.col("__cut")))
        .drop("__cut")
    )


def stop_on_error(requests: DataFrame) -> DataFrame:
    """What a sender delivers when its first failure ends the sequence. The failed request
    itself yields no result: the sequence errors instead."""
    return _before_first(requests, F.col("error").isNotNull())


def continue_on_error(requests: DataFrame) -> DataFrame:
    """What a sender attempts when failures are only recorded: everything, up to a fatal error."""
    return _before_first(requests, F.col("error").isin(*FATAL))


def send_status(requests: DataFrame) -> DataFrame:
    """The overall outcome per sender: counts over what was attempted, which ends with the first
    fatal error, and the first error (null = success)."""
    fatal = requests.where(F.col("error").isin(*FATAL)).groupBy("sender_id").agg(F.min("seq").alias("__cut"))
    requests = attach(requests, fatal, ["sender_id"], spread=["seq"])
    requests = requests.where(F.col("__cut").isNull() | (F.col("seq") <= F.col("__cut"))).drop("__cut")
    failed = F.col("error").isNotNull()
    counts = requests.groupBy("sender_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("failed")
    )
    first = requests.where(failed).groupBy("sender_id").agg(F.min_by("error", "seq").alias("first_error"))
    return counts.join(first, "sender_id", "left")


def fire_and_forget(requests: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Entries of a send whose failures are ignored and whose results nobody reads."""
    return to_entries(assign_offsets(continue_on_error(requests), ends))


def correlate(requests: DataFrame, results: DataFrame, on: str = "correlation") -> DataFrame:
    """Results next to their requests. ``results`` of different partitions arrive in any order."""
    renamed = results.select(
        F.col(on), *[F.col(c).alias(f"result_{c}") for c in results.columns if c != on]
    )
    return requests.join(renamed, on, "left")


def remaining(requests: DataFrame, results: DataFrame, on: str = "correlation") -> DataFrame:
    """Requests without a successful result: what a resumed send still has to deliver."""
    return requests.join(results.where(F.col("exception").isNull()).select(on), on, "left_anti")


def chain(links: Sequence[DataFrame]) -> DataFrame:
    """Several sends of one sender in declaration order, as one request table with ``link_no``.

    A failure ends its link at the failed request and cancels all later links.
    """
    union = None
    for number, link in enumerate(links):
        numbered = link.withColumn("link_no", F.lit(number))
        union = numbered if union is None else union.unionByName(numbered)
    here = F.struct("link_no", "seq")
    cut = union.where(F.col("error").isNotNull()).groupBy("sender_id").agg(F.min(here).alias("__cut"))
    return (
        attach(union, cut, ["sender_id"], spread=["seq"])
        .where(F.col("__cut").isNull() | (here < F.col("__cut")))
        .drop("__cut")
    )


def assign_chain_offsets(chained: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Offsets of a :func:`chain`: link order first, then request order."""
    slices = [F.col("link_no"), div(F.col("seq"), slice_width(chained.sparkSession))]
    return assign_offsets(chained, ends, ("link_no", "seq"), slices)


def run_chain(append: Callable[[DataFrame], None], steps: Sequence[DataFrame | Callable[[], None]]) -> int:
    """Run sends and other tasks in order; the first failing step cancels the later ones.

    ``append`` stores one link. Returns the number of completed steps.
    """
    for step in steps:
        append(step) if isinstance(step, DataFrame) else step()
    return len(steps)


def source_ledger(results: DataFrame) -> DataFrame:
    """Ids of any external source that are committed: those whose send succeeded."""
    return results.where(F.col("exception").isNull()).select("correlation")
