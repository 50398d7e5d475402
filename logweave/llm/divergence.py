"""How far the vocabularies of sources differ: single-pass in-memory indexing, then pair corrections.

Every task indexes its documents in one pass: a block of postings (term to documents of the language
and occurrences by source) grows until ``BLOCK`` postings fill it, is sorted by hash shard and term
and leaves as a run, in chunks of ``CHUNK`` terms. A task per shard gets the chunks of all runs in the
order of their first terms and merges them by a heap, a slice of terms at a time, so it holds those
chunks only that reach across the slice, and writes the frequencies of the terms that enough documents
of a language have.

Smoothed shares ``p`` of a term in a source and the sum of ``f(p, q)`` over all terms follow from the
frequencies. Most terms are absent from most sources, so the sum of a pair starts as if all were
absent from both, and is corrected: for terms in one source by the histogram of its counts, for terms
in both by a stream over the terms that adds up each task's pairs before they are shuffled.

All arithmetic is in integers and exact. Edge cases: null text, language and source are ''; texts of
any length are indexed whole; equal rows are documents each; a group without terms, and a language
without kept terms, still has its pairs; a language of one source has no pairs; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import LOWER, UPPER, broadcast_if_small, parts_for, python_ready, small_batches, stage, text_bytes

#: Documents of a language that a kept term has at least; terms reported for each group.
LEAST_DOCS, TOP = 10, 10
#: Postings of a block and those that wait to be added to it, terms of a chunk.
BLOCK, PENDING, CHUNK = 1_000_000, 1 << 18, 2_000
#: Text bytes behind one shard, sums of pairs that a task holds.
SHARD_BYTES, HELD = 256 << 20, 1 << 20
#: Scale and smoothing of shares.
SCALE, EXTRA = 1_000_000_000, 2
#: Letters as they count (A to Z in lower case), all other ASCII as blanks.
FOLD = bytes(ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if chr(b) in LOWER or b > 127 else 32 for b in range(256))
#: Between language and term of a key, and between keys: in no UTF-8 text.
BETWEEN, END = b"\xff", b"\xfe"


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Ids(dict):
    """Numbers terms as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order and the sums of their values."""
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value, first) if len(first) else value


class Postings:
    """Of one language in a block: term to its documents, and to its occurrences in each source. New
    ones are added to the sums ``PENDING`` at a time."""

    def __init__(self):
        self.ids, self.sources = Ids(), Ids()
        self.docs, self.occurrences = ([], []), ([], [])
        self.pending = self.settled = 0

    def add(self, source: bytes, found: list[bytes]) -> None:
        term, n = np.unique(np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found)), return_counts=True)
        place = self.sources[source]
        for (keys, values), key, value in ((self.docs, term, np.ones(len(term), np.int64)), (self.occurrences, term << 32 | place, n)):
            keys.append(key)
            values.append(value)
        self.pending += len(term)

    def settle(self) -> None:
        self.docs, self.occurrences = (tuple([x] for x in summed(*both)) for both in (self.docs, self.occurrences))
        self.pending, self.settled = 0, len(self.occurrences[0][0])


class Block:
    """Postings of the documents since the last run."""

    def __init__(self, shards: int):
        self.shards, self.size = shards, 0
        self.langs: dict[bytes, Postings] = {}

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        if not (found := terms(text)):
            return
        own = self.langs.setdefault(lang, Postings())
        own.add(source, found)
        if own.pending >= PENDING:
            self.size -= own.settled
            own.settle()
            self.size += own.settled

    def run(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(shard, first key, chunk) of all postings, of a shard in the order of keys; leaves none. A
        chunk: keys, documents, and (place of the key, place of the source, occurrences) with the sources."""
        for lang, own in self.langs.items():
            own.settle()
            names = [lang + BETWEEN + term for term in own.ids]
            order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
            shard = np.fromiter((zlib.crc32(x) % self.shards for x in names), np.int64, len(names))
            order = order[np.argsort(shard[order], kind="stable")]
            place = np.empty(len(names), np.int64)
            place[order] = np.arange(len(names))
            docs = own.docs[1][0][order]  # every term has documents, so keys are 0, 1, 2, ...
            at = place[own.occurrences[0][0] >> 32]
            by_place = np.argsort(at, kind="stable")
            at, source, n = at[by_place], own.occurrences[0][0][by_place] & 0xFFFFFFFF, own.occurrences[1][0][by_place]
            ends = np.searchsorted(shard[order], np.arange(self.shards + 1))
            for j, (begin, end) in enumerate(zip(ends[:-1], ends[1:])):
                for i in range(begin, end, CHUNK):
                    last = min(i + CHUNK, end)
                    lo, hi = np.searchsorted(at, [i, last])
                    keys = [names[k] for k in order[i:last].tolist()]
                    chunk = (END.join(keys), docs[i:last], at[lo:hi] - i, source[lo:hi], n[lo:hi], list(own.sources))
                    yield j, keys[0], pickle.dumps(chunk)
        self.langs, self.size = {}, 0


class Cursor:
    """An open chunk and how far it is merged."""

    def __init__(self, chunk: bytes):
        keys, self.docs, self.place, self.source, self.n, self.sources = pickle.loads(chunk)
        self.keys, self.done = keys.split(END), 0

    def upto(self, end: bytes | None) -> tuple:
        """(keys, documents, places, sources, occurrences) of the keys before ``end`` that are left."""
        i, j = self.done, len(self.keys) if end is None else bisect_left(self.keys, end, self.done)
        lo, hi = np.searchsorted(self.place, [i, j])
        self.done = j
        return self.keys[i:j], self.docs[i:j], self.place[lo:hi] - i, self.source[lo:hi], self.n[lo:hi], self.sources


def together(parts: list[tuple], least_docs: int) -> Iterator[tuple[bytes, int, list[bytes], list[int]]]:
    """The sums of slices with complete keys: (key, documents, sources, occurrences) of kept ones."""
    ids, sources = Ids(), Ids()
    own = [np.fromiter(map(ids.__getitem__, keys), np.int64, len(keys)) for keys, *_ in parts]
    docs = np.zeros(len(ids), np.int64)
    np.add.at(docs, np.concatenate(own), np.concatenate([p[1] for p in parts]))
    kept = docs >= least_docs
    if not kept.any():
        return
    pairs, counts = [], []
    for number, (_, _, place, source, n, names) in zip(own, parts):
        term = number[place]
        stays = kept[term]
        named = np.array([sources[x] for x in names], np.int64)
        pairs.append(term[stays] << 32 | named[source[stays]])
        counts.append(n[stays])
    pair, count = summed(pairs, counts)
    keys, names = list(ids), list(sources)
    first = np.searchsorted(pair >> 32, np.flatnonzero(kept)).tolist() + [len(pair)]
    of, count = (pair & 0xFFFFFFFF).tolist(), count.tolist()
    for k, i, j in zip(np.flatnonzero(kept).tolist(), first, first[1:]):
        yield keys[k], int(docs[k]), [names[x] for x in of[i:j]], count[i:j]


def merged(chunks: Iterable[tuple[int, bytes, bytes]], least_docs: int = 1) -> Iterator[tuple[bytes, int, list[bytes], list[int]]]:
    """(key, documents, sources, occurrences) of the keys in enough documents, from chunks in the order
    of shard and first key. The heap holds the open chunks by their next keys: what lies before the
    first key of the chunk to come is complete and leaves them."""
    heap, last = [], None

    def upto(end: bytes | None) -> Iterator[tuple[bytes, int, list[bytes], list[int]]]:
        parts, left = [], []
        while heap and (end is None or heap[0][0] < end):
            _, n, cursor = heapq.heappop(heap)
            parts.append(cursor.upto(end))
            if cursor.done < len(cursor.keys):
                left.append((cursor.keys[cursor.done], n, cursor))
        for item in left:
            heapq.heappush(heap, item)
        if parts:
            yield from together(parts, least_docs)

    for n, (shard, first, chunk) in enumerate(chunks):
        yield from upto(None if shard != last else first)
        last = shard
        heapq.heappush(heap, (first, n, Cursor(chunk)))
    yield from upto(None)


def named(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])


def frequencies(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Staged, of rows (text, lang, source): (lang, term, docs, postings [(source, n)]) of kept terms."""
    python_ready(rows.sparkSession)
    shards = parts_for(text_bytes(rows, "text"), SHARD_BYTES)

    def chunks_of(found: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in found], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["shard", "first", "chunk"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shards)
        for batch in small_batches(batches):
            for body, lang, source in zip(*batch.columns):
                block.add(lang.as_py(), source.as_py(), body.as_py())
                if block.size >= BLOCK:
                    yield chunks_of(list(block.run()))
        yield chunks_of(list(block.run()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (row for batch in small_batches(batches, 64) for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.as_py() for x in batch.column(2))))
        out = []

        def flush() -> pa.RecordBatch:
            pairs = pa.array([[{"source": s, "n": n} for s, n in zip(*found)] for _, _, *found in out], pa.list_(pa.struct([("source", pa.binary()), ("n", pa.int64())])))
            keys = [key.split(BETWEEN) for key, *_ in out]
            return pa.record_batch([pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.binary()), pa.array([x[1] for x in out], pa.int64()), pairs], ["lang", "term", "docs", "postings"])

        for entry in merged(chunks, least_docs):
            out.append(entry)
            if len(out) == 4096:
                yield flush()
                out.clear()
        yield flush()

    binary = rows.select(*[F.col(c).cast("binary").alias(c) for c in ("text", "lang", "source")])
    runs = stage(binary.mapInArrow(index, "shard int, first binary, chunk binary"), "runs")
    dealt = runs.repartitionById(shards, "shard").sortWithinPartitions("shard", "first")
    found = dealt.mapInArrow(merge, "lang binary, term binary, docs long, postings array<struct<source:binary,n:long>>")
    postings = F.transform("postings", lambda x: F.struct(x["source"].cast("string").alias("source"), x["n"].alias("n")))
    return stage(found.select(F.col("lang").cast("string").alias("lang"), F.col("term").cast("string").alias("term"), "docs", postings.alias("postings")), "frequencies")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + EXTRA) / (total + EXTRA * kept)); null without kept terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + EXTRA).cast("decimal(19,0)")
    below = F.nullif(total + EXTRA * kept, F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", top, below) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, at, p, none), lists over the sources that have a term: what the terms of both of two
    sources add to the sums that hold each for absent from the other; (lang, a, b, value) with a < b."""
    held: dict[str, tuple[list, list]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (keys, values) in held.items():
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            value = np.zeros(len(key), np.int64)
            np.add.at(value, at, np.concatenate(values))
            yield pa.record_batch([pa.array([lang] * len(key), pa.string()), pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(value)], ["lang", "a", "b", "value"])
        held.clear()

    for batch in small_batches(batches, 1024):
        langs, sizes = np.array(batch.column(0).to_pylist(), object), batch.column(1).value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        at, p, none = (batch.column(i).flatten().to_numpy() for i in (1, 2, 3))
        # terms of one language and number of sources together: the same steps for all of them
        for lang in dict.fromkeys(langs):
            keys, values = held.setdefault(lang, ([], []))
            for width in np.unique(sizes[langs == lang]):
                first = starts[(langs == lang) & (sizes == width)]
                for i in range(width - 1):
                    j = first[:, None] + np.arange(i + 1, width)
                    x = (first + i)[:, None]
                    more = f(p[x], p[j]) - f(p[x], none[j]) - f(none[x], p[j]) + f(none[x], none[j])
                    key, where = np.unique((np.minimum(at[x], at[j]) << 32 | np.maximum(at[x], at[j])).ravel(), return_inverse=True)
                    total = np.zeros(len(key), np.int64)
                    np.add.at(total, where, more.ravel())
                    keys.append(key)
                    values.append(total)
                    size += len(key)
        if size > HELD:
            yield from flush()
            size = 0
    yield from flush()


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' for the other sources of the language, part
    'term' for the ``top`` terms that a source has more of than its language."""
    rows = named(docs, text, lang, source)
    kept = frequencies(rows, least_docs)
    postings = kept.select("lang", "term", F.inline("postings"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    within = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select("lang", "source", zero("total"), zero("kept"))
    groups = groups.withColumns({"all": F.sum("total").over(within), "at": F.row_number().over(within.orderBy("source")).cast("long")})
    groups = stage(groups.withColumn("none", share(F.lit(0), F.col("total"), F.col("kept"))), "groups")
    small = broadcast_if_small(groups, F.octet_length("lang") + F.octet_length("source"))
    known = stage(postings.join(small.select("lang", "source", "total", "kept", "at", "none"), ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept"))), "shares")

    side = lambda end: small.select("lang", F.col("source").alias(end), F.col("none").alias(f"none_{end}"))
    other = F.col("source") != F.col("item")
    both = groups.select("lang", "source", "none", "kept").join(side("item"), "lang").where(other)
    absent = both.select("lang", "source", "item", F.coalesce(F.col("kept") * divergence(F.col("none"), F.col("none_item")), F.lit(0)).alias("value"))
    levels = known.groupBy("lang", "source", "p", "none").agg(F.count(F.lit(1)).alias("terms"))
    one = levels.join(side("item"), "lang").where(other)
    more = F.col("terms") * (divergence(F.col("p"), F.col("none_item")) - divergence(F.col("none"), F.col("none_item")))
    one = one.groupBy("lang", "source", "item").agg(F.sum(more).alias("value"))
    lists = known.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p", "none")).alias("x")).where(F.size("x") > 1)
    two = lists.select("lang", "x.at", "x.p", "x.none").mapInArrow(shared_terms, "lang string, a long, b long, value long")
    two = two.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = lambda at, c: small.select("lang", F.col("at").alias(at), F.col("source").alias(c))
    two = two.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value")
    corrections = one.unionByName(two)
    turned = corrections.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = absent.unionByName(corrections).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    share_of_all = kept.select("lang", "term", F.aggregate("postings", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("in_all"), F.inline("postings"))
    ranked = share_of_all.join(small.select("lang", "source", "total", "kept", "all"), ["lang", "source"])
    ranked = ranked.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("in_all"), F.col("all"), F.col("kept")).alias("q")).where("p > q")
    ranked = ranked.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    of_terms = ranked.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    of_pairs = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair"))
    return of_pairs.unionByName(of_terms).select("lang", "source", "part", "item", "value", "rank")
