"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint has a bit set where more than half of the hashes of a text's word shingles have it.
Fingerprints that differ in ``radius`` bits at most are linked. Cut into ``b`` blocks of bits, two
linked fingerprints agree in at least ``b - radius`` whole blocks, so every choice of that many
blocks gives a table whose equal keys are the candidates; ``b`` grows with the number of different
fingerprints so that keys stay selective. Within one key, fingerprints are stored bit plane by bit
plane: one machine word holds one bit of 64 of them. A query adds up the differences of 64
distances at once in carry-save counters and drops a block of 64 as soon as all of them exceed
the radius. A key's links leave the task as a spanning forest, never as all pairs.

Edge cases: null and blank texts have fingerprint 0 and link like any other; texts are processed
whole, of any length; equal texts and repeated rows share one fingerprint, compared once; a null
doc_id is a document too, but no component is named after it (null if no other is reachable); an
empty table gives an empty table; extra columns are ignored by :func:`near_duplicates` and kept by
:func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import python_ready, row_key, small_batches, stage
from logweave.llm.components import connect, spanning_labels

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints a task compares with each other at once; larger keys are cut into tiles.
TILE = 16_384
#: Mean number of different fingerprints that a table's key may hold if they were even.
PER_KEY = 64
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    items = text.lower().split() if text else []
    if not items:
        return 0
    joined = b" ".join(items)
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    width = min(width, len(items))
    first, last = starts[: len(items) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last)), np.uint64, len(first))
    return int(majority(hashes).view("<u8")[0])


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that more than half of the hashes have, as eight bytes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a bigint) of every row."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            values = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, fp long").withColumnRenamed("key", key)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows, one per bit; a word holds that bit of 64 consecutive values."""
    padded = np.concatenate([values, np.zeros(-len(values) % 64, np.uint64)])
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def sliced_pairs(queries: np.ndarray, values: np.ndarray, radius: int = RADIUS, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs (query, value) whose bits differ in ``radius`` places at most."""
    planes = bit_planes(values)
    n_words = planes.shape[1]
    valid = np.full(n_words, ONES)
    if len(values) % 64:
        valid[-1] = np.uint64((1 << (len(values) % 64)) - 1)
    n_counters = radius.bit_length() + 1
    for begin in range(0, len(queries), block):
        some = queries[begin : begin + block]
        q, w = np.repeat(np.arange(len(some)), n_words), np.tile(np.arange(n_words), len(some))
        counters = [np.zeros(len(q), np.uint64) for _ in range(n_counters)]
        over = np.zeros(len(q), np.uint64)
        for bit in range(64):
            carry = planes[bit][w] ^ (np.uint64(0) - ((some >> np.uint64(bit)) & np.uint64(1)))[q]
            for c in counters:
                both = c & carry
                c ^= carry
                carry = both
            over |= carry
            if bit % 8 == 7:
                alive = (beyond(counters, over, radius) & valid[w]) != valid[w]
                if not alive.all():
                    q, w, over, counters = q[alive], w[alive], over[alive], [c[alive] for c in counters]
                if not len(q):
                    break
        if len(q):
            near = ~beyond(counters, over, radius) & valid[w]
            hits = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, column = np.nonzero(hits)
            yield begin + q[row], w[row] * 64 + column


def beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Where a vertical counter exceeds ``radius``, as bits."""
    greater, equal = over.copy(), ~over
    for place in reversed(range(len(counters))):
        if radius >> place & 1:
            equal = equal & counters[place]
        else:
            greater |= equal & counters[place]
            equal = equal & ~counters[place]
    return greater


def masks_for(n: int, radius: int) -> list[int]:
    """The tables for ``n`` different fingerprints: the bits each of them keys on."""
    blocks = radius + 1
    while blocks < 64 and n >> (64 * (blocks - radius) // blocks) > PER_KEY and comb(blocks + 1, radius) <= 500:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def tile_links(keys: np.ndarray, sides: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of every run of equal keys: side 0 with itself, or side 1 against side 2."""
    out_a, out_b = [], []
    edges = np.flatnonzero(np.diff(keys)) + 1
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
        if hi - lo < 2:
            continue
        v, side = values[lo:hi], sides[lo:hi]
        left, right = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
        pairs = ((left[i], right[j]) for i, j in sliced_pairs(v[left], v[right], radius)) if len(left) and len(right) else ()
        labels = spanning_labels(hi - lo, pairs)
        linked = np.flatnonzero(labels != np.arange(hi - lo))
        out_a.append(v[linked])
        out_b.append(v[labels[linked]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def links(distinct: DataFrame, radius: int = RADIUS, tile: int | None = None) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct`` (fp) within ``radius`` bits."""
    tile = tile or TILE
    masks = F.array(*[F.lit(signed(m)) for m in masks_for(distinct.count(), radius)])
    entries = distinct.select("fp", F.posexplode(masks).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("k"))
    sizes = entries.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / tile).cast("int")
    member = entries.join(sizes, ["t", "k"]).withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    # A row of chunk i meets chunk j in tile (min, max); in its own tile it is on both sides.
    tiled = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        F.xxhash64("t", "k", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
        "fp",
    )
    python_ready(distinct.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            rest = [c[cut:] for c in cols]
            yield emit([c[:cut] for c in cols])
        if rest is not None:
            yield emit(rest)

    def emit(cols: list[np.ndarray]) -> pa.RecordBatch:
        a, b = tile_links(cols[0], cols[1], cols[2].view(np.uint64), radius)
        return pa.record_batch([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def classes(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every different fingerprint of ``prints`` (key, fp)."""
    first = prints.groupBy("fp").agg(F.min(key).alias("first"))
    distinct = stage(first, "distinct-prints")
    named = connect(links(distinct.select("fp"), radius))
    labelled = distinct.join(named.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    return labelled.join(least, "component").select("fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, fingerprint as 16 hex digits, component_id (smallest key reachable)."""
    prints = stage(fingerprints(docs, key, text), "prints")
    return prints.join(classes(prints, key), "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest key of every group of near duplicates, with its columns; of rows with
    that key the one with the smallest text hash, and of rows equal in both any one."""
    named = docs.withColumn("__row", row_key(key, text))
    rank = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col("__row").alias("row"))
    prints = stage(fingerprints(named.select(rank.alias("__id"), text), "__id", text), "prints")
    stays = stage(classes(prints, "__id").select(F.col("component_id")["row"].alias("__row")).distinct(), "stays")
    kept = named.join(stays, "__row", "left_semi")
    repeated = prints.groupBy(F.col("__id")["row"].alias("__row")).count().where("count > 1").select("__row")
    repeated = stage(repeated.join(stays, "__row", "left_semi"), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, "__row", "left_semi").dropDuplicates(["__row"])
        kept = kept.join(repeated, "__row", "left_anti").unionByName(once)
    return kept.select(*docs.columns)
