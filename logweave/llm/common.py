"""Helpers shared by the text operators: words, staged tables, sizes."""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import new_dir, remove, ship_package

#: Characters between words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def size_in_words(text: Column) -> Column:
    """Number of words, without keeping an array that filters out the empty ends."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+")
    ends = (F.element_at(parts, 1) == "").cast("long")
    last = F.when(F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("long")).otherwise(F.lit(0))
    return (F.size(parts) - ends - last).cast("long")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again: the plan above runs once,
    and what follows does not depend on executors that computed it."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[staged] = path
    return staged


#: Where :func:`stage` wrote the tables that are still in use.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def drop(*tables: DataFrame) -> None:
    """Removes staged tables that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, _paths.pop(table))


def drop_shuffles(spark: SparkSession) -> None:
    """Spark's cleaner deletes the shuffle files of finished steps only after a garbage collection of the driver,
    which a driver with little to do rarely makes: it is asked for one."""
    spark.sparkContext._jvm.System.gc()


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts, to choose a number of partitions."""
    return df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def parts_for(total_bytes: int, part_bytes: int) -> int:
    """So many partitions that each holds about ``part_bytes``; 12 at least."""
    return max(12, -(-total_bytes // part_bytes))


def python_ready(spark: SparkSession) -> None:
    """Python workers can import this package from here on."""
    ship_package(spark)


#: A staged table is broadcast up to this many bytes of rows.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column | None = None) -> DataFrame:
    """``df``, a staged table, with a broadcast hint if its rows measure at most
    ``BROADCAST_BYTES``; beyond that the join is an ordinary shuffle join."""
    width = (row_bytes if row_bytes is not None else F.lit(0)) + 16 * len(df.columns)
    total = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else unchanged. Texts of ASCII characters only take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(key: str, text: str) -> Column:
    """A name for a row that is never null: its key and a hash of its text. Equal rows share it."""
    return F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("-")), F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit("")))))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, so that a task copies few texts at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
        pa.default_memory_pool().release_unused()
