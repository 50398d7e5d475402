"""Throughput, latency and integrity statistics.

``sends(sender_id, seq, start_ms, end_ms, bytes)`` has one row per completed send; the latency
is ``end_ms - start_ms``. Sums are kept in integers, so results do not depend on task order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators.transactions import anchored_windows
from logweave.plans.ordered import Running, div, running
from logweave.plans.quantiles import histogram, nearest_rank, summarise
from logweave.schema import TP

MIB = 1048576.0

# The percentiles reported for producers and for end-to-end latency.
PRODUCER_PERCENTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p999": 0.999}
LATENCY_PERCENTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99, "p999": 0.999}

#: Latencies kept at most, and messages per progress report.
SAMPLE_SIZE = 500000
BLOCK_MESSAGES = 5000


def _latency() -> Column:
    return F.col("end_ms") - F.col("start_ms")


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records"),
        F.sum("bytes").alias("__bytes"),
        F.sum(_latency()).alias("__latency"),
        F.max(_latency()).alias("max_latency_ms"),
    ]


def _rates(elapsed_ms: Column) -> dict[str, Column]:
    elapsed = elapsed_ms.cast("double")
    return {
        "records_per_sec": F.lit(1000.0) * F.col("records") / elapsed,
        "mb_per_sec": F.lit(1000.0) * F.col("__bytes") / elapsed / F.lit(MIB),
        "avg_latency_ms": F.col("__latency") / F.col("records").cast("double"),
    }


def window_throughput(sends: DataFrame, millis: int = 5000, time: str | None = None) -> DataFrame:
    """Count, rates and latency per fixed window of completion time (windows from the epoch).

    A stream that names its event-time column ``time`` (the end of the send, with a watermark)
    is grouped by that column's window, so closed windows can be appended and forgotten.
    """
    if time is not None:
        window = F.window(time, f"{millis} milliseconds").alias("__w")
        summed = sends.groupBy(window).agg(*_sums()).withColumn("window_start_ms", F.unix_millis(F.col("__w")["start"]))
        return summed.withColumns(_rates(F.lit(millis))).drop("__w", "__bytes", "__latency")
    start = F.col("end_ms") - F.pmod(F.col("end_ms"), F.lit(millis))
    return (
        sends.groupBy(start.alias("window_start_ms"))
        .agg(*_sums())
        .withColumns(_rates(F.lit(millis)))
        .drop("__bytes", "__latency")
    )


def anchored_throughput(sends: DataFrame, millis: int = 5000) -> DataFrame:
    """The same per reporting window of a sender: a window ends at the first completion at
    least ``millis`` after its start, and the next one starts there. A window that has not
    ended is not reported."""
    timed = sends.withColumn("__end", F.timestamp_millis("end_ms"))
    windows = anchored_windows(timed, millis, time="__end")
    closed = F.max(F.when(F.col("closes"), F.col("end_ms"))).alias("__closed")
    return (
        windows.groupBy("sender_id", F.col("txn_no").alias("window_no"))
        .agg(*_sums(), F.min("window_start").alias("window_start_ms"), closed)
        .where(F.col("__closed").isNotNull())
        .withColumn("elapsed_ms", F.col("__closed") - F.col("window_start_ms"))
        .withColumns(_rates(F.col("elapsed_ms")))
        .drop("__bytes", "__latency", "__closed")
    )


def totals(sends: DataFrame) -> DataFrame:
    """The whole run in one row."""
    return (
        sends.agg(*_sums(), (F.max("end_ms") - F.min("start_ms")).alias("elapsed_ms"))
        .withColumns(_rates(F.col("elapsed_ms")))
        .drop("__bytes", "__latency")
    )


def latency_percentiles(sends: DataFrame, percentiles: dict[str, float] = PRODUCER_PERCENTILES) -> DataFrame:
    return nearest_rank(sends.withColumn("latency_ms", _latency()), "latency_ms", percentiles)


def sample_latencies(sends: DataFrame, n: int, size: int = SAMPLE_SIZE) -> DataFrame:
    """Every k-th send of a run of ``n``, k = n div min(n, size)."""
    step = max(1, n // max(1, min(n, size)))
    return sends.where(F.col("seq") % step == 0)


def payload_bytes() -> Column:
    """Key plus value length; a null counts as nothing."""
    return F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))


def consumer_progress(consumed: DataFrame, block: int = BLOCK_MESSAGES) -> DataFrame:
    """Progress of every member after each ``block`` messages (the last block may be short).

    ``consumed(member_id, delivery_seq, bytes, time_ms)``; ``delivery_seq`` counts the messages of
    a member from 0, so blocks are plain groups and only they are put in order.
    """
    blocks = consumed.groupBy("member_id", div(F.col("delivery_seq"), block).alias("block_no")).agg(
        F.count(F.lit(1)).alias("block_messages"), F.max("time_ms").alias("time_ms"), F.sum(F.col("bytes").cast("long")).alias("__own")
    )
    summed = running(
        blocks, ["member_id"], ["block_no"], [Running("messages", "sum", F.col("block_messages")), Running("__bytes", "sum", F.col("__own"))]
    )
    return summed.withColumns({"mb": F.col("__bytes") / F.lit(MIB), "block_mb": F.col("__own") / F.lit(MIB)}).drop("__bytes", "__own")


def consumer_totals(log: DataFrame, elapsed_ms: Column | None = None) -> DataFrame:
    """Messages, MB and rates of everything consumed; elapsed defaults to the time span read."""
    span = F.unix_millis(F.max("timestamp")) - F.unix_millis(F.min("timestamp"))
    elapsed = (span if elapsed_ms is None else F.max(elapsed_ms)).alias("elapsed_ms")
    seconds = F.col("elapsed_ms").cast("double") / F.lit(1000.0)
    return (
        log.agg(F.count(F.lit(1)).alias("messages"), F.sum(payload_bytes()).alias("__bytes"), elapsed)
        .withColumn("total_mb", F.col("__bytes") / F.lit(MIB))
        .withColumns(
            {"mb_per_sec": F.col("total_mb") / seconds, "messages_per_sec": F.col("messages") / seconds}
        )
        .drop("__bytes")
    )


def latency_summary(sent: DataFrame, received: DataFrame, on: str, by: Sequence[str] = ()) -> DataFrame:
    """End-to-end latency of ``sent(on, sent_ms)`` and ``received(on, received_ms)``:
    message count, average and nearest-rank percentiles."""
    joined = sent.join(received, on).withColumn("latency_ms", F.col("received_ms") - F.col("sent_ms"))
    summary = summarise(histogram(joined, "latency_ms", by), "latency_ms", LATENCY_PERCENTILES, by)
    return summary.withColumnsRenamed({"n": "messages", "mean": "avg_latency_ms"})


def integrity_check(sent: DataFrame, received: DataFrame, on: str, payload: str) -> DataFrame:
    """Messages not received as often as sent and unchanged, with the reason and one flag per fault:
    a message can be received too often *and* changed. Copies of one message are combined before
    the shuffle."""
    return (
        integrity_flags(sent, received, on, payload)
        .where(F.col("missing") | F.col("unexpected") | F.col("duplicate") | F.col("mismatched"))
        .withColumn(
            "status",
            F.when(F.col("missing"), "missing").when(F.col("unexpected"), "unexpected").when(F.col("duplicate"), "duplicate").otherwise("mismatched"),
        )
        .select(on, "sent", "received", "status")
    )


def integrity_flags(sent: DataFrame, received: DataFrame, on: str, payload: str) -> DataFrame:
    """Per message how often it was sent and received, and whether copies are ``missing``,
    ``unexpected`` (never sent), ``duplicate`` or ``mismatched`` (some copy has another payload)."""
    sides = sent.select(on, F.col(payload).alias("__sent"), F.lit(None).cast(sent.schema[payload].dataType).alias("__got"), F.lit(1).alias("__s"), F.lit(0).alias("__r"))
    other = received.select(on, F.lit(None).cast(sent.schema[payload].dataType).alias("__sent"), F.col(payload).alias("__got"), F.lit(0).alias("__s"), F.lit(1).alias("__r"))
    differs = ~(F.col("__lo").eqNullSafe(F.col("__want")) & F.col("__hi").eqNullSafe(F.col("__want")))
    flags = {
        "missing": F.col("received") < F.col("sent"),
        "unexpected": F.col("sent") == 0,
        "duplicate": (F.col("sent") > 0) & (F.col("received") > F.col("sent")),
        "mismatched": (F.col("sent") > 0) & (F.col("received") > 0) & differs,
    }
    return (
        sides.unionByName(other)
        .groupBy(on)
        .agg(
            F.sum("__s").alias("sent"),
            F.sum("__r").alias("received"),
            F.max("__sent").alias("__want"),
            F.min("__got").alias("__lo"),
            F.max("__got").alias("__hi"),
        )
        .withColumns(flags)
        .select(on, "sent", "received", *flags)
    )


# Fixed value: a new latency below this many milliseconds always passes.
SMALL_LATENCY_MS = 5.0


def compare_runs(base: DataFrame, new: DataFrame, on: Sequence[str], max_percent: float) -> DataFrame:
    """Two runs ``(on, records_per_sec, latency_ms)``: loss of throughput and gain of latency in
    percent of the base, and whether each is within ``max_percent``."""
    b = base.select(*on, F.col("records_per_sec").alias("base_rate"), F.col("latency_ms").alias("base_latency"))
    n = new.select(*on, F.col("records_per_sec").alias("new_rate"), F.col("latency_ms").alias("new_latency"))
    slower = (F.col("base_rate") - F.col("new_rate")) * 100.0 / F.col("base_rate")
    later = (F.col("new_latency") - F.col("base_latency")) * 100.0 / F.col("base_latency")
    return b.join(n, list(on)).withColumns(
        {
            "rate_loss_percent": slower,
            "latency_gain_percent": later,
            "rate_ok": slower <= max_percent,
            "latency_ok": (later <= max_percent) | (F.col("new_latency") < SMALL_LATENCY_MS),
        }
    )


def partition_counts(log: DataFrame) -> DataFrame:
    """Records per partition, per topic and in total (nulls mark the totals)."""
    counted = log.groupBy(*TP).agg(F.count(F.lit(1)).alias("records"))
    return counted.rollup(*TP).agg(F.sum("records").alias("records"))
