"""Starting streams and sinks that survive a replayed micro-batch.

After a failure Spark repeats the last micro-batch under the same ``batch_id``. Every sink here
writes into a folder named after that id and overwrites it, so a repeat changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweave.schema import TP
from logweave.session import exists, remove

BatchFunction = Callable[[DataFrame, int], None]


def batch_dir(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below ``path``, in order; nothing if it does not exist. No file is read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not exists(spark, path):
        return []
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop)
    return sorted(status.getPath().getName() for status in found)


def batches_in(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a folder below ``path``, in order."""
    return sorted(int(n.partition("=")[2]) for n in names_in(spark, path) if n.startswith("batch_id="))


def overwrite(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_dir(path, batch_id))


def store_state(df: DataFrame, path: str, batch_id: int) -> None:
    """:func:`overwrite` for state: this version and the one before stay, in case the batch is
    repeated; older ones go."""
    overwrite(df, path, batch_id)
    remove(df.sparkSession, batch_dir(path, batch_id - 2))


def previous(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the batch before ``batch_id`` stored; ``None`` for the first batch."""
    return spark.read.parquet(batch_dir(path, batch_id - 1)) if batch_id > 0 else None


def start(stream: DataFrame, each: BatchFunction, checkpoint: str, mode: str = "append", **trigger) -> StreamingQuery:
    """Run ``each(batch, batch_id)`` on every micro-batch (default: all data there is, then stop)."""
    return (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(stream: DataFrame, each: BatchFunction, checkpoint: str) -> int:
    """Run bounded micro-batches until nothing waits, stop, and return the number of the last batch (-1: none).
    For sources that bound their batches themselves (``sources.offset_stream``)."""
    query = start(stream, each, checkpoint, processingTime="0 seconds")
    try:
        query.processAllAvailable()
        progress = query.lastProgress
        return -1 if progress is None else progress["batchId"]
    finally:
        query.stop()


def to_files(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Continuous receive into parquet files, each record once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def batches_to(path: str) -> BatchFunction:
    """Store micro-batches apart; reading ``path`` gives the records with their ``batch_id``.
    Empty batches leave nothing."""

    def each(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, path, batch_id)

    return each


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def newest(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Results of a stream in update mode: the version of each key from its latest batch."""
    rest = [c for c in versions.columns if c not in keys and c != "batch_id"]
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("__r"))
        .select(*keys, *[F.col("__r")[c].alias(c) for c in rest])
    )


def commit_batches(path: str) -> BatchFunction:
    """Auto-acknowledgement as a table: what each micro-batch commits per partition."""

    def each(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch.groupBy(*TP).agg((F.max("offset") + 1).alias("commit_offset")), path, batch_id)

    return each


def sink_then_commit(writer: BatchFunction, attempts: int = 3, pause_seconds: float = 1.0) -> BatchFunction:
    """Write to an external store; the source position advances only after success. ``writer``
    is tried a bounded number of times and may therefore see a batch more than once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                return writer(batch, batch_id)
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(pause_seconds)

    return each


def fan_out(*branches: BatchFunction) -> BatchFunction:
    """Several independent writers over one read of each micro-batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for branch in branches:
                branch(batch, batch_id)
        finally:
            batch.unpersist()

    return each
