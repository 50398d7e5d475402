"""Exact nearest-rank percentiles from a distributed histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.plans.ordered import Running, running

#: Buckets per doubling of the value; neighbours differ by about one percent.
STEPS = 64


def log_bucket(value: Column) -> Column:
    """A bucket number that never decreases with ``value``; needs no statistics of the data."""
    size = F.floor(F.log2(F.abs(value) + 1) * STEPS)
    return F.when(value < 0, -size).otherwise(size)


def histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by, value, n)``: how often each non-null value occurs."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def nearest_rank(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per ``by`` group with ``sorted[floor(p * n)]`` (0-based) for each named ``p``.

    ``p * n`` is computed in double precision. Equal values are counted before any shuffle;
    the running count goes over distinct values in log-spaced slices, so neither a frequent
    value nor a long tail ends up in one task.
    """
    return summarise(histogram(df, value, by), value, probabilities, by).drop("n", "mean")


def summarise(
    counted: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Count ``n``, ``mean`` and nearest ranks of a :func:`histogram` of integers."""
    groups = list(by) or ["__all"]
    if not by:
        counted = counted.withColumn("__all", F.lit(0))
    ranked = running(
        counted,
        groups,
        [value],
        [
            Running("__cum", "sum", F.col("n")),
            Running("__total", "total", F.col("n")),
            Running("__sum", "total", F.col(value) * F.col("n")),
        ],
        slice_by=[log_bucket(F.col(value).cast("double"))],
    )
    picks = [
        F.min(F.when(F.col("__cum") > F.floor(F.lit(p) * F.col("__total").cast("double")), F.col(value))).alias(name)
        for name, p in probabilities.items()
    ]
    whole = [F.max("__total").alias("n"), (F.max("__sum") / F.max("__total")).alias("mean")]
    return ranked.groupBy(*groups).agg(*whole, *picks).drop("__all")
