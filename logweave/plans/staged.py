"""Intermediate tables in the shared folder: the plan above runs once and survives lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logweave.session import new_dir


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
