"""Groups of texts that share most of their word shingles, exactly.

Two texts are near copies if the Jaccard similarity of their sets of ``WIDTH``-word shingles is at
least ``SHARE``; groups are the components of near copies. First SimHash fingerprints of the sets are compared
bit-sliced (``simhash``): spanning links of those within ``simhash.RADIUS`` bits join most copies, after an exact
comparison. That many bits do not reach all pairs of ``SHARE``, so further candidates come from a prefix filter,
which loses no pair: with all shingles in one fixed order, two sets that similar share one of their
first ``n - ceil(SHARE * n) + 1`` shingles. The order puts shingles that are frequent in a sample last; it
decides how many candidates there are and nothing else. Every candidate is compared shingle by shingle.

Texts of a shared shingle that are still apart are first compared with two of them only, which joins dense groups at once.
Then, turn by turn, every text meets the one text of another component whose counts of shingles by
``MARKS`` ranges of hashes are nearest to its own, and what is similar joins, until a turn joins
nothing. Only then all pairs are compared that are still apart although their counts allow similarity.
So candidates grow with the texts and not with the pairs of a group; who is nearest is found in tasks of
two chunks of a group each, by arrays, and pairs that the counts rule out are never emitted.

Edge cases: a text of fewer words has one shingle, null and blank texts are equal to each other;
texts of any length are compared whole; shingles are compared by 64-bit hashes; of rows equal in key and
text any one stays; a null key comes after all others; an empty table gives an empty table; other columns
are kept, whatever their names, but for ``__row``, which this operator uses.

Before sets are fetched, pairs are dropped whose counts of shingles by ``MARKS`` ranges of hashes differ by
more than two similar sets can; that needs no set and loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm import simhash
from logweave.llm.common import broadcast_if_small, drop, drop_shuffles, python_ready, row_key, small_batches, stage
from logweave.llm.components import connect

WIDTH = 5
#: The least similarity, as a fraction.
OVER, UNDER = 4, 5
#: Frequent shingles come from one text in so many, at most so many of them.
SAMPLE_ONE_IN, FREQUENT = 16, 500_000
MARKS = 128
#: Members of a shared shingle that meet in one task, and how many of them are compared at a time.
TILE, ROWS = 1024, 16


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the different shingles, in order."""
    items = text.lower().split() if text else []
    if not items:
        return np.zeros(1, np.uint64)
    words = np.fromiter(map(xxhash.xxh64_intdigest, items), np.uint64, len(items))
    width = min(width, len(items))
    n = len(items) - width + 1
    found = np.full(n, width, np.uint64)
    for i in range(width):
        found = (found ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return np.unique(found)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * common >= OVER * (len(a) + len(b) - common)


def prefix(items: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones first; ``frequent`` is in order."""
    size = len(items) - -(-OVER * len(items) // UNDER) + 1
    if not len(frequent):
        return items[:size]
    at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
    return items[np.lexsort((items, np.where(frequent[at] == items, counts[at], 0)))[:size]]


def marks(items: np.ndarray) -> bytes:
    """How many hashes lie in each range, 255 at most; sets differ in as many shingles as these do, or more."""
    return np.minimum(np.bincount((items >> np.uint64(57)).astype(np.int64), minlength=MARKS), 255).astype(np.uint8).tobytes()


def fingerprint(items: np.ndarray) -> int:
    """The SimHash of a set: a bit is set where more than half of its hashes have it."""
    return int(simhash.majority(items).view("<i8")[0])


def frequent_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = np.concatenate([np.zeros(0, np.uint64), *(shingles(t.as_py()) for t in batch.column(0))])
            yield pa.record_batch([pa.array(found.view(np.int64))], ["token"])

    some = rows.where(F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(SAMPLE_ONE_IN)) == 0).select("text")
    counted = some.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    table = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    token, n = table.column("token").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def sketches(rows: DataFrame) -> DataFrame:
    """(id, fp, n, prefix, marks, print) of rows (id, row, text): a hash of the set, its size, its first
    shingles, its fingerprint."""
    python_ready(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(frequent_shingles(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            firsts = [prefix(s, *shared.value) for s in sets]
            values = np.concatenate([np.zeros(0, np.uint64), *firsts]).view(np.int64)
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, firsts)]).astype(np.int32), pa.array(values))
            fp = np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets))
            yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64)), pa.array([*map(len, sets)], pa.int64()), lists, pa.array([*map(marks, sets)], pa.binary()), pa.array([*map(fingerprint, sets)], pa.int64())], ["id", "fp", "n", "prefix", "marks", "print"])

    return rows.select("id", "text").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, fp long, n long, prefix array<long>, marks binary, print long")


def possible(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that sizes and marks do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, MARKS).astype(np.int64) for i in (3, 4))
            # Of similar sets at most (UNDER - OVER) / (UNDER + OVER) of both sizes is not common.
            near = (UNDER + OVER) * np.abs(a - b).sum(axis=1) <= (UNDER - OVER) * batch.column(2).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(near))

    of = lambda end: distinct.select(F.col("fp").alias(end), F.col("n").alias(f"n_{end}"), F.col("marks").alias(f"marks_{end}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").where(OVER * F.greatest("n_a", "n_b") <= UNDER * F.least("n_a", "n_b"))
    return met.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "marks_a", "marks_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """The staged ``pairs`` (a, b) that are similar. Staged; sets are made for texts of pairs only."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.record_batch([batch.column(0), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], ["fp", "items"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            both = zip(batch.column(2), batch.column(3))
            yield batch.select([0, 1]).filter(pa.array([similar(*(np.frombuffer(x.as_py(), np.uint64) for x in pair)) for pair in both], pa.bool_()))

    ends = pairs.select(F.col("a").alias("fp")).unionAll(pairs.select("b")).distinct()
    wanted = stage(distinct.join(ends, "fp", "left_semi").select("fp", F.col("first.row").alias("row")), "wanted")
    texts = rows.select("row", "text").join(broadcast_if_small(wanted, F.octet_length("row")), "row").select("fp", "text")
    sets = fetched = stage(texts.mapInArrow(sets_of, "fp long, items binary"), "sets")
    if not sets.groupBy("fp").count().where("count > 1").isEmpty():
        sets = sets.dropDuplicates(["fp"])
    of = lambda end: sets.select(F.col("fp").alias(end), F.col("items").alias(f"items_{end}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "items_a", "items_b")
    found = stage(met.mapInArrow(compare, "a long, b long"), "similar")
    drop(wanted, fetched)
    drop_shuffles(rows.sparkSession)
    return found


def near_in_tile(left: np.ndarray, right: np.ndarray, n: np.ndarray, component: np.ndarray, seen: np.ndarray, nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two components that sizes and marks (``seen``) do not rule out: all of them, or
    for each left row the one with the nearest marks only."""
    for i in range(0, len(left), ROWS):
        l = left[i : i + ROWS]
        open_ = (component[l][:, None] != component[right]) & (OVER * np.maximum(n[l][:, None], n[right]) <= UNDER * np.minimum(n[l][:, None], n[right]))
        if not len(column := np.flatnonzero(open_.any(axis=0))):
            continue
        r = right[column]
        apart = np.abs(seen[l][:, None, :] - seen[r][None]).sum(axis=2, dtype=np.int64)
        open_ = open_[:, column] & ((UNDER + OVER) * apart <= (UNDER - OVER) * (n[l][:, None] + n[r]))
        if nearest:
            row = np.flatnonzero(open_.any(axis=1))
            yield l[row], r[np.where(open_, apart, np.iinfo(np.int64).max).argmin(axis=1)[row]]
        else:
            row, at = np.nonzero(open_)
            yield l[row], r[at]


def candidates(member: DataFrame, nearest: bool) -> DataFrame:
    """Different pairs (a, b) of ``member`` (token, fp, n, component, marks) that share a token, are not
    in one component and may be similar. The members of a token are dealt into chunks of about TILE
    rows, and any two chunks meet in a task of their own, which compares rows and emits what stays."""
    sizes = member.groupBy("token").agg(F.count("*").alias("m"))
    dealt = member.join(sizes, "token").withColumn("chunks", F.ceil(F.col("m") / TILE).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
        "fp", "n", "component", "marks",
    )

    def compare(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        tile, side, fp, n, component = (table.column(i).to_numpy() for i in range(5))
        seen = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(-1, MARKS).astype(np.int16)
        edges = np.flatnonzero(np.diff(tile)) + 1
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(tile)]):
            left, right = lo + np.flatnonzero(side[lo:hi] < 2), lo + np.flatnonzero(side[lo:hi] != 1)
            both = [(left, right), (right, left)] if nearest and side[lo:hi].any() else [(left, right)]
            for x, y in (pair for ends in both for pair in near_in_tile(*ends, n, component, seen, nearest)):
                a.append(np.minimum(fp[x], fp[y]))
                b.append(np.maximum(fp[x], fp[y]))
        return pa.record_batch([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            tile = batch.column(0).to_numpy()
            cut = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
            if cut or (held and held[-1].column(0)[-1] != batch.column(0)[0]):
                yield compare([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compare(held)

    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long").distinct()


def linked_prints(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that span the groups of fingerprints within ``simhash.RADIUS`` bits: the sets of a
    fingerprint with one of them, and these along the links of the fingerprints."""
    heads = stage(distinct.groupBy("print").agg(F.min("fp").alias("head")), "prints")
    of = lambda end: heads.select(F.col("print").alias(end), F.col("head").alias(f"head_{end}"))
    near = simhash.links(heads.select(F.col("print").alias("fp"))).distinct().join(of("a"), "a").join(of("b"), "b")
    own = distinct.join(heads, "print").where("fp <> head")
    return (
        near.select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b"))
        .unionAll(own.select(F.col("head").alias("a"), F.col("fp").alias("b")))
        .distinct()
    )


def members(entries: DataFrame) -> DataFrame:
    """The rows of ``entries`` (token, fp, n, component) whose token stands in several components; of tokens that the
    same sets share, one is enough. Entries are shuffled once, for counting and for the choice."""
    dealt = entries.where("token is not null").repartition("token")
    shared = dealt.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("fp", "n")).alias("sets")
    )
    chosen = shared.where("low <> high").groupBy("low", "high", "m", "sets").agg(F.min("token").alias("token")).select("token")
    return dealt.join(chosen.hint("shuffle_hash"), "token", "left_semi")


def links(distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) that connect all similar sets of ``distinct`` (fp, first, n, prefix, marks, print)."""
    tested = stage(possible(linked_prints(distinct), distinct), "print-pairs")
    found = verified(tested, distinct, rows)
    named = broadcast_if_small(stage(connect(found).withColumnRenamed("node", "fp"), "print-groups"))
    entries = distinct.select("fp", "n", F.explode("prefix").alias("token")).join(named, "fp", "left")
    member = stage(members(entries.select("token", "fp", "n", F.coalesce("component", "fp").alias("component"))), "members")
    some = F.struct("component", "fp")
    ends = member.groupBy("token").agg(F.min(some).alias("low"), F.max(some).alias("high"))
    hubs = member.join(ends, "token").select("fp", "component", F.explode(F.array("low", "high")).alias("hub")).where("component <> hub.component")
    met = hubs.select(F.least("fp", "hub.fp").alias("a"), F.greatest("fp", "hub.fp").alias("b")).distinct()
    met = stage(possible(met, distinct), "hub-pairs")
    found, tested, nearest = found.unionAll(verified(met, distinct, rows)), tested.unionAll(met), True
    active = member.select("token", "fp", "n")
    while True:
        named = connect(found).withColumnRenamed("node", "fp")
        labelled = active.join(named, "fp", "left").select("token", "fp", "n", F.coalesce("component", "fp").alias("component"))
        apart = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        before, member = member, stage(labelled.join(apart.select("token"), "token", "left_semi"), "apart")
        near = stage(candidates(member.join(distinct.select("fp", "marks"), "fp"), nearest), "near")
        drop(before)
        if near.isEmpty():
            return found
        met = stage(near.join(tested, ["a", "b"], "left_anti"), "other-pairs")
        joined = False
        if not met.isEmpty():
            more = verified(met, distinct, rows)
            found, tested, joined = found.unionAll(more), tested.unionAll(met), not more.isEmpty()
        if not nearest:
            return found
        nearest = joined
        # whoever has a text to meet is in a pair; the others have none in later turns either
        meets = near.select(F.col("a").alias("fp")).unionAll(near.select("b")).distinct()
        active = member.select("token", "fp", "n").join(meets, "fp", "left_semi")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of the smallest key of every group of near copies, with its columns; of rows with
    that key the one with the smallest text hash, and of rows equal in both any one."""
    named = docs.withColumn("__row", row_key(key, text))
    rank = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col("__row").alias("row"))
    rows = named.select(rank.alias("id"), F.col("__row").alias("row"), F.col(text).cast("binary").alias("text"))
    prints = stage(sketches(rows), "sketches")
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("marks").alias("marks"), F.first("print").alias("print")), "distinct-sets")
    several = stage(prints.groupBy(F.col("id.row").alias("__row")).count().where("count > 1").select("__row"), "several")
    drop(prints)
    group = connect(links(distinct, rows)).withColumnRenamed("node", "fp")
    least = distinct.select("fp", "first").join(group, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
    stays = stage(least.select(F.col("first.row").alias("__row")).distinct(), "stays")
    repeated = stage(several.join(stays, "__row", "left_semi"), "repeated")
    drop(distinct, several)
    drop_shuffles(docs.sparkSession)
    kept = named.join(broadcast_if_small(stays, F.octet_length("__row")), "__row", "left_semi")
    if not repeated.isEmpty():
        once = kept.join(repeated, "__row", "left_semi").dropDuplicates(["__row"])
        kept = kept.join(repeated, "__row", "left_anti").unionByName(once)
    return kept.select(*docs.columns)
