"""Repeated byte strings by a distributed, sparse suffix array.

Every ``length``-byte string has an *anchor*: the position, among its first ``WINNOW``, of the
smallest hash of eight bytes (the last such). Equal strings have equal anchors, so it is enough to
sort the suffixes that start at anchors, about one in a hundred, each with the bytes before it
that strings with this anchor may start with.

Two Bloom filters first drop anchors whose next bytes, the part common to all strings with that
anchor, occur once. The other suffixes are dealt into buckets by splitters on their leading bytes,
drawn from a sample. A bucket sorts its suffixes by multikey quicksort, and the bytes before them
likewise, and reads from common prefix lengths which strings repeat. Leading bytes so frequent
that splitters repeat are dealt over several buckets; what does not repeat inside one of them is
compared across their boundaries by a grouping of 128-bit digests, to which each bucket adds the
strings that do repeat, once. So no bucket grows with a hot string.

Edge cases: null and empty texts, and texts shorter than ``length``, lose nothing; texts of any
length are taken whole, and matches never cross texts; rows equal in id and text repeat each
other; a null id is an id; an empty table gives an empty table; extra columns are kept, and names
this operator adds must not be among them (``ValueError``). What is left is bytes, as a cut may
fall inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweave.llm.bloom import Suspects, packed, seen_twice, segments_for
from logweave.llm.common import python_ready, row_key, small_batches, stage, text_bytes

LENGTH, WINNOW, GRAM = 400, 192, 8
#: Bytes worked on at once, and of one very long text.
CHUNK, PIECE = 1 << 19, 1 << 23
LEAD, BUCKET_BYTES = 32, 8 << 20
#: A task goes through so many buckets, one after the other, and writes one file.
BUCKETS_A_TASK = 4
#: Splitters come from one document in SAMPLE_ONE_IN, and from SAMPLE_ROWS suffixes at most.
SAMPLE_ONE_IN, SAMPLE_ROWS = 16, 20_000
POSITION = np.uint64((1 << 24) - 1)


class Anchor(NamedTuple):
    """Strings that start at ``first`` to ``last`` of text ``row`` have their anchor at ``at``; all
    positions are inside ``buffer``, which starts at ``base`` of the text."""

    row: int
    buffer: bytes
    base: int
    at: int
    first: int
    last: int


def pieces(texts: list[bytes | None], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset, bytes) of about CHUNK bytes; pieces of one text overlap so that every
    string of ``length`` starts in exactly one."""
    group, size = [], 0
    for row, text in enumerate(texts):
        if text is None or len(text) < length:
            continue
        for offset in range(0, len(text) - length + 1, PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if size and size + len(part) > CHUNK:
                yield group
                group, size = [], 0
            group.append((row, offset, part))
            size += len(part)
    if group:
        yield group


def anchors(texts: list[bytes | None], length: int = LENGTH, winnow: int = WINNOW) -> Iterator[Anchor]:
    for group in pieces(texts, length):
        whole = b"".join(part for _, _, part in group)
        n = len(whole)
        grams = np.ndarray((n - GRAM + 1,), "<u8", whole, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams &= ~POSITION
        grams |= POSITION - np.arange(len(grams), dtype=np.uint64)
        least, span = grams, 1
        while span * 2 <= winnow:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(grams) - winnow + 1], least[winnow - span : winnow - span + len(grams) - winnow + 1])
        place = (POSITION - (least & POSITION)).astype(np.int64)
        start = 0
        for row, offset, part in group:
            of = place[start : start + len(part) - length + 1]
            cuts = np.flatnonzero(np.diff(of)) + 1
            firsts = np.concatenate(([0], cuts))
            lasts = np.concatenate((cuts - 1, [len(of) - 1]))
            for at, first, last in zip((of[firsts] - start).tolist(), firsts.tolist(), lasts.tolist()):
                yield Anchor(row, part, offset, at, first, last)
            start += len(part)


def common_hash(a: Anchor, length: int, winnow: int) -> int:
    """Hash of the bytes that all strings with this anchor share."""
    return xxhash.xxh64_intdigest(a.buffer[a.at : a.at + length - winnow + 1])


def lead_bytes(length: int, winnow: int) -> int:
    """Bytes that choose a bucket: equal strings must share them, wherever their anchor is."""
    return min(LEAD, length - winnow + 1)


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of the rows of ``keys`` (unsigned, most significant column first): three-way partition
    by one column; the equal part goes on with the next. Short parts are sorted as byte strings."""
    n, depth_end = keys.shape
    as_bytes = keys.astype(">u8")
    out, at = np.empty(n, np.int64), 0
    stack = [(np.arange(n), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= 24:
            part = sorted(rows.tolist(), key=lambda i: as_bytes[i, depth:].tobytes()) if len(rows) > 1 else rows
            out[at : at + len(rows)] = part
            at += len(rows)
            continue
        column = keys[rows, depth]
        pivot = np.sort(column[:: max(1, len(rows) // 9)])[4]
        equal = column == pivot
        if depth + 1 == depth_end and equal.all():
            out[at : at + len(rows)] = rows
            at += len(rows)
            continue
        less = column < pivot
        for part, d in ((rows[~(less | equal)], depth), (rows[equal], min(depth + 1, depth_end - 1)), (rows[less], depth)):
            if len(part):
                stack.append((part, d))
    return out


def sorted_runs(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the texts, padded to ``width``, and the length that each shares with the next."""
    width += -width % 8
    raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
    order = multikey_quicksort(raw.view(">u8").astype(np.uint64))
    shared = np.empty(max(0, len(texts) - 1), np.int64)
    for i in range(0, len(shared), 8192):
        here = raw[order[i : i + 8193]]
        differ = here[1:] != here[:-1]
        shared[i : i + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, shared


def repeated_strings(left: list[bytes], right: list[bytes], length: int = LENGTH) -> np.ndarray:
    """For every suffix (row) and number of bytes taken from before its anchor (column): whether
    that string occurs at another row too. A row offers columns ``length - len(right)`` to
    ``len(left)``; two rows hold the same string if they share enough bytes on both sides."""
    n, most = len(left), max(map(len, left)) + 1
    order_r, shared_r = sorted_runs(right, length)
    order_l, shared_l = sorted_runs([x[::-1] for x in left], most)
    fewest, last = length - np.fromiter(map(len, right), np.int64, n), np.fromiter(map(len, left), np.int64, n)
    found = np.zeros((n, most), bool)
    id_r, id_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for taken in range(most):
        id_r[order_r] = np.concatenate(([0], np.cumsum(shared_r < length - taken)))
        id_l[order_l] = np.concatenate(([0], np.cumsum(shared_l < taken)))
        rows = np.flatnonzero((fewest <= taken) & (taken <= last))
        _, where, count = np.unique(id_r[rows] * n + id_l[rows], return_inverse=True, return_counts=True)
        found[rows, taken] = count[where] > 1
    return found


def spans_of(found: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) in the text for every run of repeated strings of a row."""
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, least = np.nonzero(edges == 1)
    _, beyond = np.nonzero(edges == -1)
    return row, at[row] - beyond + 1, at[row] - least + length


def suspects(rows: DataFrame, length: int, winnow: int) -> Suspects:
    segments = segments_for(2 * text_bytes(rows, "__text") // (winnow + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            hashes = [common_hash(a, length, winnow) for a in anchors([t.as_py() for t in batch.column(0)], length, winnow)]
            yield packed(np.array(hashes, np.uint64), segments)

    return seen_twice(rows.select("__text").mapInArrow(run, "segment int, hashes binary"), segments)


def repeated_spans(rows: DataFrame, length: int = LENGTH, winnow: int = WINNOW) -> DataFrame:
    """(__key, start, end) over ``rows`` (__key, __text as binary): bytes covered by repeated strings."""
    spark = rows.sparkSession
    twice = spark.sparkContext.broadcast(suspects(rows, length, winnow))
    splitters = splitters_of(rows, twice, length, winnow)
    n_buckets, lead = len(splitters) + 1, lead_bytes(length, winnow)
    split_at = np.array(splitters, f"S{lead}")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keys = batch.column(0).to_pylist()
            for some in found_again([t.as_py() for t in batch.column(1)], twice.value, length, winnow):
                leads = np.array([a.buffer[a.at : a.at + lead] for a in some], f"S{lead}")
                low, high = np.searchsorted(split_at, leads, "left"), np.searchsorted(split_at, leads, "right")
                tie = np.array([xxhash.xxh32_intdigest(f"{keys[a.row]}:{a.base + a.at}") for a in some], np.int64)
                columns = [
                    pa.array(low + tie % (high - low + 1), pa.int32()),
                    pa.array(high > low),
                    pa.array([keys[a.row] for a in some]),
                    pa.array([a.base + a.at for a in some], pa.int64()),
                    pa.array([a.buffer[a.first : a.at] for a in some], pa.binary()),
                    pa.array([a.buffer[a.at : a.last + length] for a in some], pa.binary()),
                ]
                yield pa.record_batch(columns, ["bucket", "hot", "key", "at", "left", "right"])

    def in_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if buckets[lo] != current and held:
                        yield from compare(held)
                        held = []
                    current = buckets[lo]
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from compare(held)

    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        hot = table.column("hot").to_numpy()
        for cold in (True, False):
            own = table.filter(pa.array(hot != cold))
            if not own.num_rows:
                continue
            keys, at = own.column("key").to_pylist(), own.column("at").to_numpy()
            left, right = own.column("left").to_pylist(), own.column("right").to_pylist()
            found = repeated_strings(left, right, length)
            row, start, end = spans_of(found, at, length)
            yield spans([keys[i] for i in row], start, end, [None] * len(row))
            if not cold:
                yield from across_boundaries(found, keys, at.tolist(), left, right)

    def across_boundaries(found, keys, at, left, right) -> Iterator[pa.RecordBatch]:
        """Strings that no other row of this bucket holds, with their place; and without one, each
        string that repeats here, as a witness for the other buckets."""
        witnesses: set[bytes] = set()
        for k, p, x, y, here in zip(keys, at, left, right, found):
            whole, starts, digests = x + y, [], []
            for taken in range(length - len(y), len(x) + 1):
                digest = xxhash.xxh3_128_digest(whole[len(x) - taken : len(x) - taken + length])
                if here[taken]:
                    witnesses.add(digest)
                else:
                    starts.append(p - taken)
                    digests.append(digest)
            if starts:
                yield spans([k] * len(starts), np.array(starts), np.array(starts) + length, digests)
        yield spans([None] * len(witnesses), np.zeros(len(witnesses)), np.zeros(len(witnesses)), list(witnesses))

    def spans(keys: list[str], start: np.ndarray, end: np.ndarray, digests: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(keys, pa.string()), pa.array(np.asarray(start, np.int64)), pa.array(np.asarray(end, np.int64)), pa.array(digests, pa.binary())], ["key", "start", "end", "digest"])

    dealt = rows.select("__key", "__text").mapInArrow(deal, "bucket int, hot boolean, key string, at long, left binary, right binary")
    results = stage(
        dealt.repartition(-(-n_buckets // BUCKETS_A_TASK), "bucket").sortWithinPartitions("bucket").mapInArrow(in_bucket, "key string, start long, end long, digest binary"),
        "spans",
    )
    across = results.where("digest is not null")
    again = across.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    single = across.where("key is not null").join(again, "digest").select(*results.columns)
    sure = results.where("digest is null").unionByName(single)
    return sure.select(F.col("key").alias("__key"), "start", "end")


def found_again(texts: list[bytes | None], twice: Suspects, length: int, winnow: int) -> Iterator[list[Anchor]]:
    """Anchors of the texts that the filter knows, in lists of bounded size."""
    some: list[Anchor] = []

    def tested() -> list[Anchor]:
        has = twice.has(np.array([common_hash(a, length, winnow) for a in some], np.uint64))
        return [a for a, x in zip(some, has.tolist()) if x]

    for a in anchors(texts, length, winnow):
        some.append(a)
        if len(some) == 8192:
            if kept := tested():
                yield kept
            some = []
    if some and (kept := tested()):
        yield kept


def splitters_of(rows: DataFrame, twice, length: int, winnow: int) -> list[bytes]:
    """Leading bytes that cut the suspects into buckets of about BUCKET_BYTES, equal ones included.
    They decide how evenly buckets fill and nothing else."""
    lead = lead_bytes(length, winnow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keys = batch.column(0).to_pylist()
            for some in found_again([t.as_py() for t in batch.column(1)], twice.value, length, winnow):
                yield pa.record_batch(
                    [
                        pa.array([a.buffer[a.at : a.at + lead] for a in some], pa.binary()),
                        pa.array([xxhash.xxh64_intdigest(f"{keys[a.row]}:{a.base + a.at}") >> 1 for a in some], pa.int64()),
                        pa.array([a.last - a.first + length for a in some], pa.int64()),
                    ],
                    ["lead", "draw", "size"],
                )

    some = rows.where(F.pmod(F.xxhash64("__key", F.lit("sample")), F.lit(SAMPLE_ONE_IN)) == 0)
    sample = stage(some.select("__key", "__text").mapInArrow(run, "lead binary, draw long, size long"), "suffix-sample")
    total = (sample.agg(F.sum("size")).first()[0] or 0) * SAMPLE_ONE_IN
    leads = sorted(bytes(r.lead) for r in sample.orderBy("draw").limit(SAMPLE_ROWS).select("lead").collect())
    buckets = max(12, -(-total // BUCKET_BYTES))
    return [leads[i * len(leads) // buckets] for i in range(1, buckets)] if len(leads) >= buckets else sorted(set(leads))


def remove_repeats(docs: DataFrame, length: int = LENGTH, winnow: int = WINNOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus kept (bytes), n_bytes, n_removed, n_spans and removed (start and end of each
    maximal run of removed bytes)."""
    added = {"kept": "binary", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "removed": "array<struct<start:long,end:long>>"}
    if clash := set(added) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} exist")
    if winnow + GRAM > length:
        raise ValueError("winnow is too long for length")
    python_ready(docs.sparkSession)
    named = docs.withColumn("__key", row_key(key, text))
    rows = named.select("__key", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    spans = repeated_spans(rows, length, winnow).groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    joined = named.join(spans, "__key", "left").select(*docs.columns, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__bytes"), "__spans")
    schema = StructType([*docs.schema, *StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in added.items()))])
    rest = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[tuple] = []
            for body, found in zip(batch.column(rest), batch.column(rest + 1)):
                data, merged, keep, at = body.as_py(), [], [], 0
                for span in found.as_py() or ():
                    if merged and span["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], span["end"])
                    else:
                        merged.append(span)
                for span in merged:
                    keep.append(data[at : span["start"]])
                    at = span["end"]
                kept = b"".join([*keep, data[at:]])
                out.append((kept, len(data), len(data) - len(kept), len(merged), merged))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch([*batch.columns[:rest], *columns], schema.fieldNames())

    return joined.mapInArrow(run, schema)
