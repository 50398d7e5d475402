"""Which 64-bit hashes were seen twice: two Bloom filters, once-seen and twice-seen.

The hash space is cut into segments. Tasks send their hashes, packed, to the segment's task, which
streams them through a once-seen filter; a hash that is already there enters the twice-seen one.
Only the twice-seen filters are gathered. Their total size is bounded by ``MAX_BITS`` whatever the
input; beyond about 20 million hashes more of them become suspects by mistake, and none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each expected hash, bits of one segment, probes, and bits of all twice-seen filters.
BITS_PER_HASH, SEGMENT_BITS, PROBES, MAX_BITS = 12, 1 << 20, 4, 1 << 28


def segments_for(hashes: int) -> int:
    """A power of two; every segment has ``SEGMENT_BITS``."""
    wanted = min(MAX_BITS, max(SEGMENT_BITS, hashes * BITS_PER_HASH))
    return 1 << (-(-wanted // SEGMENT_BITS) - 1).bit_length()


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return (hashes >> np.uint64(48)) % np.uint64(segments)


def probes(hashes: np.ndarray) -> np.ndarray:
    """Bit places of each hash in its segment, one column per probe; from other bits than its segment."""
    step = ((hashes >> np.uint64(24)) & np.uint64(0xFFFFFF)) | np.uint64(1)
    return ((hashes & np.uint64(0xFFFFFF))[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(SEGMENT_BITS)


class Bloom:
    def __init__(self, data: bytes | None = None):
        self.bits = np.zeros(SEGMENT_BITS // 8, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        at = probes(hashes).ravel()
        np.bitwise_or.at(self.bits, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = probes(hashes)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


class Suspects:
    """The gathered twice-seen filters: segment number to bytes."""

    def __init__(self, parts: dict[int, bytes], segments: int):
        self.parts, self.segments = parts, segments
        self.filters: dict[int, Bloom] | None = None

    def __reduce__(self):
        return Suspects, (self.parts, self.segments)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.filters is None:
            self.filters = {k: Bloom(v) for k, v in self.parts.items()}
        found = np.zeros(len(hashes), bool)
        home = segment_of(hashes, self.segments)
        order = np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.diff(home[order])) + 1
        for at in np.split(order, edges):
            if len(at) and (f := self.filters.get(int(home[at[0]]))) is not None:
                found[at] = f.has(hashes[at])
        return found


def packed(hashes: np.ndarray, segments: int) -> pa.RecordBatch:
    """Rows (segment, hashes as bytes) to be sent."""
    home = segment_of(hashes, segments)
    order = np.argsort(home, kind="stable")
    hashes, home = hashes[order], home[order]
    cuts = np.flatnonzero(np.diff(home)) + 1
    starts = [0, *cuts.tolist()] if len(hashes) else []
    rows = [hashes[a:b].astype("<u8").tobytes() for a, b in zip(starts, [*cuts.tolist(), len(hashes)])]
    return pa.record_batch([pa.array([int(home[a]) for a in starts], pa.int32()), pa.array(rows, pa.binary())], ["segment", "hashes"])


def seen_twice(sent: DataFrame, segments: int) -> Suspects:
    """From rows of :func:`packed`. A segment is one task's stream, never held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice, any_twice = None, Bloom(), Bloom(), False
        for batch in batches:
            for segment, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if segment != current:
                    if any_twice:
                        yield done(current, twice)
                    current, once, twice, any_twice = segment, Bloom(), Bloom(), False
                values, counts = np.unique(np.frombuffer(data.as_buffer(), "<u8"), return_counts=True)
                again = values[(counts > 1) | once.has(values)]
                if len(again):
                    twice.add(again)
                    any_twice = True
                once.add(values)
        if any_twice:
            yield done(current, twice)

    def done(segment: int, twice: Bloom) -> pa.RecordBatch:
        return pa.record_batch([pa.array([segment], pa.int32()), pa.array([twice.bits.tobytes()], pa.binary())], ["segment", "bits"])

    filters = sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment int, bits binary")
    return Suspects({r.segment: bytes(r.bits) for r in filters.toLocalIterator()}, segments)
