"""Counters of running streams, by client id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logweave.operators.stats import payload_bytes
from logweave.streaming.runs import BatchFunction, overwrite, read_batches

PREFIX = "client:"


def observed(stream: DataFrame, client_id: str) -> DataFrame:
    """Count records and payload bytes of ``stream`` while it runs; one registration per client."""
    return stream.observe(
        PREFIX + client_id,
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(payload_bytes()), F.lit(0)).alias("bytes"),
    )


def count_batches(path: str, client_id: str) -> BatchFunction:
    """Counters for the whole run: every micro-batch stores its records and payload bytes, however
    many progress reports the session retains."""

    def each(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(payload_bytes()), F.lit(0)).alias("bytes"))
        overwrite(counted.select(F.lit(client_id).alias("client_id"), "*"), path, batch_id)

    return each


def counted(spark: SparkSession, path: str, tags: dict[str, str] | None = None) -> DataFrame:
    """What :func:`count_batches` stored: one row per client and micro-batch that had records."""
    table = read_batches(spark, path).where("records > 0")
    return table.withColumns({k: F.lit(v) for k, v in (tags or {}).items()})


class Lifecycle(StreamingQueryListener):
    """Callbacks for streams that start, advance and end: ``on_event(kind, query_name, detail)``."""

    def __init__(self, on_event: Callable[[str, str | None, object], None]):
        self._tell = on_event
        self._names: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name
        self._tell("started", event.name, None)

    def onQueryProgress(self, event) -> None:
        self._tell("progress", event.progress.name, event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._tell("terminated", self._names.pop(str(event.id), None), event.exception)
