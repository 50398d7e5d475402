"""Joining a per-key table to a log without shuffling the log, when the table is small enough.

Offset maps, commit tables and per-sender results usually have one row per partition or per
sender. :func:`attach` measures that instead of assuming it: the table is evaluated once, up to
a row limit. Within the limit it becomes a local relation and is broadcast. Beyond it the join
is a shuffle whose key carries a salt, so one hot partition is still spread over many tasks.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 << 20
SALTS = 64


def bounded(df: DataFrame, max_rows: int = MAX_ROWS) -> pa.Table | None:
    """The rows of ``df`` if there are at most ``max_rows`` of them, else ``None``."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > MAX_BYTES:
        return None
    return table


def relation(df: DataFrame, table: pa.Table) -> DataFrame:
    """The rows of ``table`` as a relation with the schema of ``df``; from Arrow data, so Spark
    holds it in the plan instead of running a job for it."""
    return df.sparkSession.createDataFrame(table, df.schema)


def local(df: DataFrame, table: pa.Table) -> DataFrame:
    return F.broadcast(relation(df, table))


def settle(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``df`` evaluated once and kept as a local relation if it is small, else ``df`` itself.
    For per-partition results that a plan refers to several times."""
    table = bounded(df, max_rows)
    return df if table is None else relation(df, table)


def attach(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = MAX_ROWS,
    spread: list[str] | None = None,
) -> DataFrame:
    """``big.join(small, on, how)`` for left, inner, left_semi and left_anti.

    ``spread`` names columns of ``big`` that vary inside one key (default: ``offset`` when
    present, else all columns); their hash picks the salt beyond the broadcast limit.
    """
    table = bounded(small, max_rows)
    if table is not None:
        return big.join(local(small, table), on, how)
    return salted(big, small, on, how, spread)


def salted(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", spread: list[str] | None = None
) -> DataFrame:
    """Shuffle join on ``on`` plus a salt: ``small`` is repeated per salt, ``big`` is not. A key that
    contains the offset belongs to one record and needs no salt."""
    if "offset" in on:
        return big.join(small, on, how)
    if spread is None:
        spread = ["offset"] if "offset" in big.columns else big.columns
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*on, "__salt"], how).drop("__salt")
