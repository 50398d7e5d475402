"""Which partition a record goes to and which timestamp it carries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_integer_key(partition: Column, key: Column, partitions: int) -> Column:
    """An explicit partition wins, else ``key mod partitions``."""
    return F.coalesce(partition, F.pmod(key, F.lit(partitions))).cast("int")


def route_hashed_key(partition: Column, key: Column, partitions: int) -> Column:
    """As above for any key type, by 64-bit hash. This is not the hash of the log client."""
    return F.coalesce(partition, F.pmod(F.xxhash64(key), F.lit(partitions))).cast("int")


def send_time(timestamp: Column, at: Column | None = None, log_append: bool = False) -> Column:
    """The request's own timestamp or, without one, the send time ``at`` (default: now).
    Topics that stamp on append always take the send time."""
    now = F.current_timestamp() if at is None else at
    return now if log_append else F.coalesce(timestamp, now)
