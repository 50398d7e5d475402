"""Report lines of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp format of a report line.
REPORT_TIME = "HH:mm:ss:SSS z dd MMM yyyy"


def format_record(topic: Column, partition: Column, offset: Column, timestamp: Column, key: Column, value: Column) -> Column:
    return F.format_string(
        "topic-partition=%s-%d offset=%d timestamp=%s key=%s value=%s",
        topic, partition, offset, F.date_format(timestamp, REPORT_TIME), key, value,
    )
