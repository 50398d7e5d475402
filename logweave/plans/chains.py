"""Sequential "first hit after the last hit" chains, computed block-parallel.

Two operators of a log client depend on the previous outcome record by record: transaction
windows anchored at the record that closed the last one, and commit-ahead decisions over
offsets with gaps. Both are chains over sorted integers: after a hit at ``v`` the next hit is
the first value in ``(v, v + near]`` if there is one, else the first value ``>= v + far``.

A serial fold would put one sender or partition into one task. Here the values are cut into
blocks of bounded length:

    1. every block turns each *possible* entry (a value within ``far`` of its first one, or the
       next one after those) into the last hit it leads to and the number of hits;
    2. such maps compose: up to ``FAN`` neighbours make the map of one node, these make the map of a
       node above, until a group has at most ``FAN`` nodes. The possible entries of a node lie within
       ``far`` of its first value as well, so no map is larger than one span of ``far``;
    3. downwards again, the real entry of a node and its map's children give the real entry of each
       child, one task per node and a scalar as state;
    4. every block replays its own chain from its real entry.

Blocks hold distinct integers of a fixed-length range, so their size is bounded by the block
length no matter how many records share one value. No task sees a whole group: its length is
divided by ``FAN`` at each of the steps 2 and 3. Maps are staged, as both directions read them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.plans.ordered import div
from logweave.plans.staged import staged
from logweave.session import ship_package, slice_width

MAX_BLOCK = 1 << 22
#: Maps that one task composes, and nodes of a group at the top.
FAN = 16


def block_length(spark, far: int) -> int:
    """Integers per block: several times ``far`` when that fits, never above ``MAX_BLOCK``."""
    return max(slice_width(spark), min(16 * far, MAX_BLOCK))


def next_hits(values: np.ndarray, near: int, far: int) -> np.ndarray:
    """Index of the hit that follows a hit at each index (``len(values)`` = outside)."""
    nxt = np.searchsorted(values, values + far, side="left")
    if near > 0 and len(values) > 1:
        close = np.append(np.diff(values) <= near, False)
        nxt = np.where(close, np.arange(1, len(values) + 1), nxt)
    return nxt


def block_map(values: np.ndarray, near: int, far: int):
    """(entries, last hits, hit counts) for every possible entry of one block.

    The last hit or anchor before the entry is not later than the first value, so the entry is
    within ``far`` of that value or the first one beyond.
    """
    n = len(values)
    jump = next_hits(values, near, far)
    last = np.arange(n)
    count = np.ones(n, dtype=np.int64)
    live = np.flatnonzero(jump < n)
    while len(live):
        target = jump[live]
        new_last, new_count, new_jump = last[target], count[live] + count[target], jump[target]
        last[live], count[live], jump[live] = new_last, new_count, new_jump
        live = live[new_jump < n]
    entries = min(int(np.searchsorted(values, values[0] + far, side="left")) + 1, n)
    return values[:entries], values[last[:entries]], count[:entries]


def compose(maps: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], near: int, far: int):
    """The map of neighbouring blocks from theirs, in order; holds the composed map and one more."""
    entries, last, count = (x.copy() for x in next(maps))
    limit = entries[0] + far
    for entry, into_last, into_count in maps:
        at = np.searchsorted(entry, last + far, side="left")
        if near > 0:
            at = np.where(entry[0] - last <= near, 0, at)
        goes_on = at < len(entry)
        at = at[goes_on]
        last[goes_on], count[goes_on] = into_last[at], count[goes_on] + into_count[at]
        if entries[-1] < limit:
            more = min(int(np.searchsorted(entry, limit, side="left")) + 1, len(entry))
            entries, last, count = (np.concatenate([x, y[:more]]) for x, y in ((entries, entry), (last, into_last), (count, into_count)))
    return entries, last, count


def replay(values: np.ndarray, entry: int | None, near: int, far: int) -> np.ndarray:
    """Boolean mask of the hits of one block, given its real entry (``None`` = no hit). The hits so far
    and the jumps of twice as many hits give as many hits again."""
    hit = np.zeros(len(values), dtype=bool)
    if entry is None:
        return hit
    start = int(np.searchsorted(values, entry, side="left"))
    jump = np.append(next_hits(values[start:], near, far), len(values) - start)
    path = new = np.zeros(1, np.int64)
    while len(new := jump[path]) and len(new := new[new < len(jump) - 1]):
        path, jump = np.concatenate([path, new]), jump[jump]
    hit[start + path] = True
    return hit


def _run_starts(columns: list[pa.Array]) -> np.ndarray:
    """Where a run of equal keys begins, nulls being equal; compares whole columns, makes no Python objects."""
    changed = np.zeros(len(columns[0]), dtype=bool)
    changed[0] = True
    for column in columns:
        this, last = column.slice(1), column.slice(0, len(column) - 1)
        # unknown where one side or both are null
        different = pc.coalesce(pc.not_equal(this, last), pc.not_equal(pc.is_null(this), pc.is_null(last)))
        changed[1:] |= different.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def _by_block(batches: Iterator[pa.RecordBatch], names: list[str], keys: list[str], fn) -> Iterator[pa.RecordBatch]:
    """Call ``fn(columns)`` for each run of equal ``names`` in sorted batches.

    ``columns`` maps the other columns to arrays of one whole block; ``fn`` returns arrays of
    one length, which get the ``keys`` of the block in front: those of the same row when ``fn``
    returns as many rows as it got. Only the block that a batch leaves unfinished is kept for
    the next one.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _run_starts([batch.column(n) for n in names])
        same = held and all(held[-1].column(n)[-1].equals(batch.column(n)[0]) for n in names)
        if held and not same:
            yield _apply_runs(held, names, keys, fn)
            held = []
        if len(starts) == 1:
            held.append(batch)
            continue
        begin = 0
        if held:
            yield _apply_runs([*held, batch.slice(0, starts[1])], names, keys, fn)
            begin = 1
        if begin < len(starts) - 1:
            yield _apply_runs([batch.slice(starts[begin], starts[-1] - starts[begin])], names, keys, fn)
        held = [batch.slice(starts[-1])]
    if held:
        yield _apply_runs(held, names, keys, fn)


def _apply_runs(batches: list[pa.RecordBatch], names: list[str], keys: list[str], fn) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    column = {n: table.column(n).combine_chunks() for n in table.column_names}
    starts = _run_starts([column[n] for n in names])
    numbers = {n: c.to_numpy(zero_copy_only=False) for n, c in column.items() if n not in {*names, *keys}}
    bounds = list(zip(starts, [*starts[1:], table.num_rows]))
    parts = [fn({n: c[i:j] for n, c in numbers.items()}) for i, j in bounds]
    lengths = [len(next(iter(part.values()))) for part in parts]
    if all(length == j - i for length, (i, j) in zip(lengths, bounds)):
        arrays = {n: column[n] for n in keys}
    else:
        rows = pa.array(np.repeat(starts, lengths))
        arrays = {n: column[n].take(rows) for n in keys}
    for n in parts[0]:
        values = np.concatenate([part[n] for part in parts])
        if values.dtype.kind == "f":  # integers with gaps
            missing = np.isnan(values)
            arrays[n] = pa.array(np.where(missing, 0, values).astype("int64"), mask=missing)
        else:
            arrays[n] = pa.array(values)
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def dealt(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with equal ``names`` in one partition. Dealt by a hash column of their own: a repartition by the
    keys of the join below is dropped as done, and once that join is broadcast, rows stay where they were read."""
    return rows.withColumn("__deal", F.xxhash64(*names)).repartition("__deal").drop("__deal")


def widest(maps: DataFrame, by: Sequence[str]) -> int:
    """The largest number of blocks that a group of ``maps`` extends over."""
    spans = maps.groupBy(*by).agg((F.max("__block") - F.min("__block") + 1).alias("n"))
    return spans.agg(F.max("n")).first()[0] or 0


def _composed(maps: DataFrame, keys: list[T.StructField], near: int, far: int) -> DataFrame:
    """The maps of the nodes above: of up to FAN blocks each."""
    by = [f.name for f in keys]
    names = [*by, "__node"]

    def node(columns: dict) -> dict:
        bounds = np.flatnonzero(np.append(True, columns["__block"][1:] != columns["__block"][:-1]))
        parts = (tuple(columns[c][i:j] for c in ("__entry", "__last", "__count")) for i, j in zip(bounds, [*bounds[1:], None]))
        entries, last, count = compose(parts, near, far)
        return {"__entry": entries, "__last": last, "__count": count}

    schema = T.StructType([*keys, *[T.StructField(c, T.LongType()) for c in ("__node", "__entry", "__last", "__count")]])
    return (
        maps.withColumn("__node", div(F.col("__block"), FAN))
        .repartition(*names)
        .sortWithinPartitions(*names, "__block", "__entry")
        .mapInArrow(lambda batches: _by_block(batches, names, names, node), schema)
        .withColumnRenamed("__node", "__block")
    )


def _entered(maps: DataFrame, keys: list[T.StructField], near: int, far: int, first_hits: bool) -> DataFrame:
    """(by, __block, __entry, __after, __seen): the first hit in each block, the latest hit or anchor
    before it and the hits so far, from ``__after`` and ``__seen`` at the begin of each ``__node``."""
    by = [f.name for f in keys]
    parent, names = [*by, "__node"], [*by, "__node", "__block"]
    fields = [*keys, *[T.StructField(c, T.LongType()) for c in ("__block", "__entry", "__after", "__seen")]]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = block = after = None
        seen, open_block = 0, False
        found: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * len(fields)
            done = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            found.clear()
            return pa.RecordBatch.from_arrays(done, names=[f.name for f in fields])

        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = kinds or [*(batch.column(n).type for n in by), *[pa.int64()] * 4]
            starts = _run_starts([batch.column(n) for n in names])
            heads = list(zip(*[batch.column(n).take(pa.array(starts)).to_pylist() for n in names]))
            given = zip(*[batch.column(n).take(pa.array(starts)).to_pylist() for n in ("__after", "__seen")])
            entries, lasts, counts = (batch.column(n).to_numpy() for n in ("__entry", "__last", "__count"))
            for head, initial, start, end in zip(heads, given, starts, [*starts[1:], batch.num_rows]):
                entry = entries[start:end]
                fresh = (group, block) != (head[:-1], head[-1])
                if fresh:
                    if open_block:
                        found.append((*group[:-1], block, None, after, seen))
                    if head[:-1] != group:
                        after, seen = initial
                        if after is None and not first_hits:
                            after = int(entry[0])
                    group, block, open_block = head[:-1], head[-1], True
                if not open_block:
                    continue
                if after is None or (fresh and near > 0 and entry[0] - after <= near):
                    i = 0
                else:
                    i = int(np.searchsorted(entry, after + far, side="left"))
                if i < len(entry):
                    found.append((*group[:-1], block, int(entry[i]), after, seen))
                    after = int(lasts[start + i])
                    seen += int(counts[start + i])
                    open_block = False
            yield rows()
        if open_block:
            found.append((*group[:-1], block, None, after, seen))
            yield rows()

    return dealt(maps, parent).sortWithinPartitions(*names, "__entry").mapInArrow(walk, T.StructType(fields))


def hits(
    nodes: DataFrame,
    by: Sequence[str],
    value: str,
    near: int,
    far: int,
    first_hits: bool,
    carry: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Walk the chain of every group.

    ``nodes`` has one row per distinct ``(by, value)`` with an integer value. ``first_hits``:
    the first value is itself a hit; otherwise it only anchors the chain. ``carry`` (``by``,
    ``after``) continues from an earlier anchor. Null values drop out; a group whose name has a null has no hits,
    as its rows equal nothing. Returns ``by``, ``keep``, ``value``, ``is_hit``,
    ``hits_before`` and ``last_hit`` (the latest hit or anchor before this value, or null).
    """
    spark = nodes.sparkSession
    ship_package(spark)
    by = list(by)
    length = block_length(spark, far)
    kept = nodes.select(*by, *keep, F.col(value).cast("long").alias("__v")).where("__v is not null").withColumn("__block", div(F.col("__v"), length))
    blocked = kept.drop(*keep)
    keys = [f for f in blocked.schema.fields if f.name in by]
    names = [*by, "__block"]
    longs = lambda *columns: [T.StructField(c, T.LongType()) for c in columns]

    def to_map(block: dict) -> dict:
        entries, last, count = block_map(block["__v"], near, far)
        return {"__entry": entries, "__last": last, "__count": count}

    map_columns = ["__block", "__entry", "__last", "__count"]
    maps = staged(
        blocked.repartition(*names)
        .sortWithinPartitions(*names, "__v")
        .mapInArrow(lambda batches: _by_block(batches, names, names, to_map), T.StructType([*keys, *longs(*map_columns)])),
        "chain-maps",
    )
    levels = [maps]
    while widest(levels[-1], by) > FAN:
        levels.append(staged(_composed(levels[-1], keys, near, far), "chain-maps"))

    if carry is None:
        begin = F.lit(None).cast("long")
        top = levels[-1].withColumns({"__after": begin, "__seen": F.lit(0).cast("long")})
    else:
        known = carry.select(*by, F.col("after").cast("long").alias("__after"))
        top = levels[-1].join(known, by, "left").withColumn("__seen", F.lit(0).cast("long"))
    state = _entered(top.withColumn("__node", F.lit(0).cast("long")), keys, near, far, first_hits)
    for level in reversed(levels[:-1]):
        above = staged(state, "chain-entries").select(*by, F.col("__block").alias("__node"), "__after", "__seen")
        below = level.withColumn("__node", div(F.col("__block"), FAN)).join(above, [*by, "__node"])
        state = _entered(below, keys, near, far, first_hits)

    def play(block: dict) -> dict:
        values, entry, after = block["__v"], block["__entry"][0], block["__after"][0]
        hit = replay(values, None if np.isnan(entry) else int(entry), near, far)
        done = np.cumsum(hit) - hit
        # index of the latest hit before each value, -1 for none inside this block
        at = np.maximum.accumulate(np.concatenate([[-1], np.where(hit, np.arange(len(hit)), -1)[:-1]]))
        last = np.where(at >= 0, values[at], np.nan if np.isnan(after) else after)
        return {value: values, "is_hit": hit, "hits_before": done + block["__seen"], "last_hit": last}

    extra = [f for f in kept.schema.fields if f.name in keep]
    schema = T.StructType([*keys, *extra, *longs(value), T.StructField("is_hit", T.BooleanType()), *longs("hits_before", "last_hit")])
    return (
        dealt(kept.join(state, names, "left"), names)
        .sortWithinPartitions(*names, "__v")
        .mapInArrow(lambda batches: _by_block(batches, names, [*by, *keep], play), schema)
    )
