"""Exact line dedup: lines that several documents share stay in the first of them only.

Hashes of all line keys go through a once-seen and a twice-seen Bloom filter. In a second pass only
lines whose hash is in the twice-seen filter are shuffled, as 128-bit digests with their document;
grouping them confirms which keys several documents hold and which document is the first.

Edge cases: a null or empty text is one empty line; lines are split at \\n only; texts and lines of
any length are taken whole; rows that share a doc_id (null counts as the largest) are one document;
a line repeated inside one document only is kept; an empty table gives an empty table; extra
columns are kept, and names this operator adds must not be among them (``ValueError``).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.bloom import Suspects, packed, seen_twice, segments_for
from logweave.llm.common import python_ready, small_batches, stage

LEAST_CHARS = 10
LAST = (1 << 63) - 1


def line_key(line: bytes, least: int = LEAST_CHARS) -> bytes | None:
    """The key of a line, or None if it is too short to be compared."""
    key = line.strip().lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return key


def keys_of(text: bytes | None, least: int) -> set[bytes]:
    return {k for k in (line_key(x, least) for x in (text or b"").split(b"\n")) if k is not None}


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def hash_keys(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def suspected(rows: DataFrame, least: int) -> Suspects:
    """The twice-seen filter over the keys of all documents (__doc, __text)."""
    lines = rows.agg(F.sum(F.length("__text") - F.length(F.replace("__text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = segments_for(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield packed(hash_keys([k for t in batch.column(0) for k in keys_of(t.as_py(), least)]), segments)

    return seen_twice(rows.select(F.col("__text").cast("binary")).mapInArrow(run, "segment int, hashes binary"), segments)


def repeated_lines(rows: DataFrame, least: int) -> DataFrame:
    """(__doc, drop): digests of the keys that each document loses."""
    found = rows.sparkSession.sparkContext.broadcast(suspected(rows, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = keys_of(text.as_py(), least)
                keys += own
                docs += [doc] * len(own)
            again = np.flatnonzero(found.value.has(hash_keys(keys)))
            yield pa.record_batch(
                [pa.array([docs[i] for i in again], pa.int64()), pa.array([digest(keys[i]) for i in again], pa.binary())], ["doc", "key"]
            )

    suspects = stage(rows.select("__doc", F.col("__text").cast("binary")).mapInArrow(run, "doc long, key binary"), "suspects")
    confirmed = suspects.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    lost = suspects.join(confirmed.select("key", "first"), "key").where("doc <> first")
    return lost.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("key").alias("__drop"))


def dedup_lines(docs: DataFrame, least: int = LEAST_CHARS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the remaining text, plus n_lines and n_dropped."""
    if clash := {"n_lines", "n_dropped"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} exist")
    python_ready(docs.sparkSession)
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    rows = docs.select(doc.alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    whole = docs.withColumn("__doc", doc).join(repeated_lines(rows, least), "__doc", "left").drop("__doc")
    rest = [c for c in docs.columns if c != text]
    schema = whole.select(*rest, F.col(text)).schema.add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            kept, n, dropped = [], [], []
            for body, drop in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
                lines = (body.as_py() or b"").split(b"\n")
                gone = set(drop.as_py() or ())
                stay = [x for x in lines if (k := line_key(x, least)) is None or digest(k) not in gone] if gone else lines
                kept.append(b"\n".join(stay))
                n.append(len(lines))
                dropped.append(len(lines) - len(stay))
            columns = [*batch.columns[: len(rest)], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.record_batch(columns, schema.fieldNames())

    return whole.select(*rest, F.col(text).cast("binary"), "__drop").mapInArrow(run, schema).select(*docs.columns, "n_lines", "n_dropped")
