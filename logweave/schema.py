"""Column layouts shared by the whole package.

The log envelope uses the column names of Spark's own ``kafka`` source, so a query written
against a file-backed log runs unchanged against a live topic.
"""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

#: One row per log entry. ``topic`` and ``partition`` are directory columns, hence last.
LOG = T.StructType(
    [
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
        T.StructField("txn_id", T.StringType()),
        T.StructField("is_control", T.BooleanType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
    ]
)

#: The columns that identify one ordered log.
TP = ["topic", "partition"]

#: The columns that identify one record.
TPO = ["topic", "partition", "offset"]

LOG_COLUMNS = LOG.fieldNames()

#: Transaction markers: one row per decided transaction.
TXNS = T.StructType([T.StructField("txn_id", T.StringType()), T.StructField("state", T.StringType())])
