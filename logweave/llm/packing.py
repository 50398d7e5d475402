"""Documents packed into sequences of bounded length: best-two-fit over piece lengths.

A document is its token ids and an end id; only longer ones are cut, into pieces of ``limit`` ids.
A sequence is filled greedily, longest fitting piece first. Then, while room is left, its smallest
piece goes back if two unpacked pieces together fill the expanded gap more tightly.

Pieces of one length are interchangeable, so the plan needs the number of pieces of each length
only: at most ``limit`` counts whatever the size of the corpus. A sequence found for the counts is
repeated while they last, which gives patterns with multiplicities; their number depends on
``limit`` alone. Tasks number their pieces of each length while they encode, sums of the tasks
before make that a number over all pieces, and the number says pattern, copy and place. So no text,
no id and no piece is shuffled or sorted.

Edge cases: a null text is empty and has the end id only; texts of any length are encoded whole;
rows that share a doc_id or are equal are packed each on their own; an empty table gives no piece;
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import broadcast_if_small, python_ready, small_batches, stage
from logweave.llm.tokenbin import encoder


class Pattern(NamedTuple):
    """``times`` equal sequences, each with ``pieces`` (length, how many), longest first."""

    times: int
    pieces: list[tuple[int, int]]


def fill(left: np.ndarray, limit: int) -> Counter:
    """The lengths of one sequence, taken out of the counts ``left`` (index: length)."""
    taken, gap = Counter(), limit

    def take(length: int, n: int) -> None:
        nonlocal gap
        left[length] -= n
        taken[length] += n
        gap -= n * length

    while len(fits := np.flatnonzero(left[: gap + 1])):
        longest = int(fits[-1])
        take(longest, min(int(left[longest]), gap // longest))
    while gap:
        smallest = min(x for x, n in taken.items() if n)
        there = np.flatnonzero(left[: gap + smallest])
        # for every length the longest one that fits beside it
        at = np.searchsorted(there, gap + smallest - there, side="right") - 1
        beside = np.where(at >= 0, there[at], 0) if len(there) else there
        good = (beside > there) | ((beside == there) & (left[there] > 1))
        total = np.where(good, there + beside, 0)
        if not len(total) or total.max() <= smallest:
            break
        best = int(total.argmax())
        take(smallest, -1)
        for length in (int(there[best]), int(beside[best])):
            take(length, 1)
    return Counter({x: n for x, n in taken.items() if n})


def plan(counts: np.ndarray, limit: int) -> list[Pattern]:
    """Patterns that use up ``counts`` (index: length, 1 to ``limit``)."""
    counts, patterns = counts.copy(), []
    while counts.any():
        taken = fill(counts.copy(), limit)
        times = min(int(counts[x]) // n for x, n in taken.items())
        for x, n in taken.items():
            counts[x] -= times * n
        patterns.append(Pattern(times, sorted(taken.items(), reverse=True)))
    return patterns


class Places(NamedTuple):
    """Of each range of piece numbers of one length, ordered by (length, number): where its pieces go."""

    key: np.ndarray  # length << 44 | first number
    first: np.ndarray
    each: np.ndarray  # pieces of this length in a sequence
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern], limit: int) -> Places:
        given, rows, sequence = [0] * (limit + 1), [], 0
        for times, pieces in patterns:
            offset = 0
            for length, n in pieces:
                rows.append((length << 44 | given[length], given[length], n, sequence, offset))
                given[length] += times * n
                offset += n * length
            sequence += times
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        at = np.searchsorted(self.key, length << 44 | number, side="right") - 1
        past = number - self.first[at]
        return self.sequence[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def pieces(docs: DataFrame, tokenizer: str, end_id: int, limit: int, by_word: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged: (doc_id, piece, start, length, ids, task, number). ``ids`` are little-endian unsigned
    32-bit integers, ``number`` counts the pieces of this length of the task before."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids", "task", "number"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, given = encoder(tokenizer, by_word), TaskContext.get().taskAttemptId(), [0] * (limit + 1)
        for batch in small_batches(batches):
            out = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode.ids(body.as_py())
                ids.append(end_id)
                whole = np.frombuffer(ids, ids.typecode).astype("<u4")
                for i, start in enumerate(range(0, len(whole), limit)):
                    part = whole[start : start + limit]
                    out.append((doc_id, i, start, len(part), part.tobytes(), task, given[len(part)]))
                    given[len(part)] += 1
            yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)] if out else [pa.array([], kind) for kind in kinds], names)

    schema = "doc_id long, piece int, start long, length long, ids binary, task long, number long"
    return stage(rows.mapInArrow(run, schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, end_id: int, limit: int, by_word: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece and its place."""
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, end_id, limit, by_word, key, text)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counted = stage(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(limit + 1, np.int64)
    for length, n in counted.groupBy("length").agg(F.sum("n")).collect():  # at most ``limit`` rows
        counts[length] = n
    places = spark.sparkContext.broadcast(Places.of(plan(counts, limit), limit))
    base = stage(counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "numbers")
    numbered = cut.join(broadcast_if_small(base), ["task", "length"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids", (F.col("base") + F.col("number")).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.value.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.record_batch([*batch.columns[:5], *map(pa.array, found)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: (sequence_id, length, ids, doc_ids, offsets), in the order of offsets."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda done, x: done + x["length"])
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select("sequence_id", length.alias("length"), joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
