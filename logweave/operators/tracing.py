"""Trace headers, span reports and client counters.

A span row has ``trace_id, record_id, span_type`` (``sender`` or ``receiver``), ``topic`` and
``client_id``. Span names are ``<topic> publish`` and ``<topic> receive``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.headers import header, last_header, with_headers
from logweave.operators.stats import payload_bytes


def inject_trace(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Append one header per entry of ``values`` to every record."""
    return df.withColumn("headers", with_headers(F.col("headers"), *[header(k, v) for k, v in values.items()]))


def extract_trace(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """One text column per ``{column: header key}``; the last header of a key counts."""
    return df.withColumns({name: last_header(F.col("headers"), key) for name, key in keys.items()})


def span_name() -> Column:
    verb = F.when(F.col("span_type") == "sender", "publish").otherwise("receive")
    return F.concat_ws(" ", F.col("topic"), verb)


def trace_report(spans: DataFrame) -> DataFrame:
    """Spans per trace, name, type and client."""
    return spans.groupBy("trace_id", span_name().alias("span_name"), "span_type", "client_id").agg(
        F.count(F.lit(1)).alias("spans")
    )


def unmatched_spans(spans: DataFrame) -> DataFrame:
    """Records published but not received, or received but not published, per trace."""
    sent, got = F.count_if(F.col("span_type") == "sender"), F.count_if(F.col("span_type") == "receiver")
    return (
        spans.groupBy("trace_id", "record_id")
        .agg(sent.alias("__sent"), got.alias("__got"))
        .groupBy("trace_id")
        .agg(
            F.count_if(F.col("__got") == 0).alias("unreceived"),
            F.count_if(F.col("__sent") == 0).alias("unpublished"),
        )
    )


def client_metrics(df: DataFrame, client: Column, tags: dict[str, str] | None = None) -> DataFrame:
    """Records and payload bytes per client id, with fixed user tags as columns."""
    return (
        df.groupBy(client.alias("client_id"))
        .agg(F.count(F.lit(1)).alias("records"), F.sum(payload_bytes()).alias("bytes"))
        .withColumns({k: F.lit(v) for k, v in (tags or {}).items()})
    )
