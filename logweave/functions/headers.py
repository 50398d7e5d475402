"""Record headers: an ordered list of (key, bytes) pairs where keys may repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.schema import HEADERS


def header(key: str | Column, value: Column) -> Column:
    """One header whose value is the UTF-8 form of ``value``."""
    name = F.lit(key) if isinstance(key, str) else key
    return F.struct(name.alias("key"), F.encode(value.cast("string"), "UTF-8").alias("value"))


def with_headers(headers: Column, *extra: Column) -> Column:
    """``headers`` (null counts as empty) followed by ``extra``; existing ones are kept."""
    empty = F.array().cast(HEADERS)
    return F.concat(F.coalesce(headers, empty), F.array(*extra).cast(HEADERS))


def last_header_bytes(headers: Column, key: str) -> Column:
    """The last value stored under ``key``; null when there is none."""
    matching = F.filter(headers, lambda h: h["key"] == key)
    return F.try_element_at(matching, F.lit(-1))["value"]


def last_header(headers: Column, key: str) -> Column:
    """As :func:`last_header_bytes`, read as UTF-8."""
    return F.make_valid_utf8(last_header_bytes(headers, key).cast("string"))
