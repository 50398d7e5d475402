"""Jump consistent hashing: stable keys to shards without a ring table.

The shard is a function of the key and the number of shards. Growing from ``n`` to ``m`` shards
moves ``1 - n/m`` of the keys, all of them into the new shards.

Edge cases: a null key hashes like the number ``NULL_KEY``; other than integer keys are hashed
with ``xxhash64`` first; equal rows get the same shard and different slots; a null or empty text has
no bytes of its own and texts of any length are measured whole; an empty table gives an empty table; columns of the input keep their values, and names this operator adds must not be
among them (``ValueError``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import python_ready, stage

NULL_KEY = -1
#: Fixed values of the published algorithm.
MULTIPLIER = np.uint64(2862933555777941757)
#: Rows of one shard that a single task numbers.
SLICE_ROWS = 500_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key, all keys at once: in each turn the keys whose next jump is still
    inside the shards move there."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    home = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(active):
            state[active] = state[active] * MULTIPLIER + np.uint64(1)
            high = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
            jump = ((home[active] + 1) * (float(1 << 31) / high)).astype(np.int64)
            inside = jump < shards
            active = active[inside]
            home[active] = jump[inside]
    return home.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a bigint column as a column; numpy on whole Arrow batches."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64), shards))

    return jump(F.coalesce(key, F.lit(NULL_KEY)))


def key_column(df: DataFrame, key: str) -> Column:
    integral = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    return F.col(key).cast("long") if integral else F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key)))


def assign(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` plus the shard of each row."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    python_ready(df.sparkSession)
    return df.withColumn(name, shard_of(key_column(df, key), shards))


def number(df: DataFrame, order: list[str], shard: str = "shard", name: str = "slot") -> DataFrame:
    """``df`` plus a gapless number from 0 inside each shard.

    A shard may hold more rows than one task can sort, so it is cut into slices by a hash of
    ``order``; slice sizes give the first number of each slice, and only slices are sorted. Rows
    equal in ``order`` are interchangeable.
    """
    rows = df.count()
    slices = max(1, -(-rows // SLICE_ROWS))
    spread = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    keys = [shard, "__slice"]
    before = Window.partitionBy(shard).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        spread.withColumn("__row", F.row_number().over(inside))
        .join(starts, keys)
        .withColumn(name, F.col("__start") + F.col("__row") - 1)
        .select(*df.columns, name)
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum, shard, slot and the shard with one more of every row; the text stays
    behind, so that only narrow rows are shuffled."""
    body = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    narrow = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    sharded = stage(assign(assign(narrow, key, shards), key, shards + 1, "grown_shard"), "shards")
    return number(sharded, [key, "text_crc32", "size"])
