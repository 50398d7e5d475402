"""Few files for many transactions: closed batches of a transactional sink move into parts.

    <path>/parts/<name>/data/topic=/partition=    entries of some batches in a row, with their txn_id
    <path>/parts/<name>/txns                      their markers
    <path>/manifests/batch_id=<generation>        the parts in force: name, first and last batch, tier

A generation counts once its manifest is complete; a crash before that leaves only a part nobody reads,
which the next attempt replaces. Whoever reads takes one manifest and sees its parts and the folders of
later batches. What a generation replaces is removed by the generation after it, so a reader outlives one
compaction. Parts merge like digits: ``FAN`` parts of a tier become one of the next, so every entry is
rewritten once per tier, and there are at most ``FAN - 1`` parts of each.

Batches that may still be repeated are not taken: the last two with a marker stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.plans.ordered import div
from logweave.schema import LOG, LOG_COLUMNS, TP
from logweave.session import exists, remove, slice_width
from logweave.streaming.runs import batch_dir, batches_in, names_in, overwrite

FAN = 8
#: The latest batches with markers; they may be repeated and stay in folders of their own.
KEPT_BATCHES = 2
MARKERS = "txn_id string, state string, ends long, offsets long, batch_id long"
_MANIFEST = "part string, first long, last long, tier long"


class Snapshot:
    """Entries and markers of a sink under one manifest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.generation = max(generations(spark, path), default=None)
        self.parts = [] if self.generation is None else _manifest(spark, path, self.generation)
        #: The last batch that is in a part; -1 if none is.
        self.upto = max((p["last"] for p in self.parts), default=-1)

    def part_dir(self, part: dict, table: str) -> str:
        return f"{self.path}/parts/{part['part']}/{table}"

    def entries(self, upto: int | None = None) -> DataFrame:
        """All entries, those of open batches too (``upto``: no later batches)."""
        data = f"{self.path}/data"
        later = [n for n in names_in(self.spark, data) if n.startswith("txn_id=") and self.upto < _batch_of(n)]
        later = [n for n in later if upto is None or _batch_of(n) <= upto]
        read = self.spark.read.schema(LOG)
        found = [_part_entries(self.spark, self.part_dir(p, "data")) for p in self.parts]
        if later:
            found.append(read.option("basePath", data).parquet(*[f"{data}/{n}" for n in later]).select(*LOG_COLUMNS))
        return _all(found, self.spark.createDataFrame([], LOG).select(*LOG_COLUMNS))

    def markers(self, upto: int | None = None) -> DataFrame:
        later = [b for b in batches_in(self.spark, f"{self.path}/txns") if self.upto < b and (upto is None or b <= upto)]
        found = [self.spark.read.schema(MARKERS).parquet(self.part_dir(p, "txns")) for p in self.parts]
        if later:
            stored = self.spark.read.schema(MARKERS).option("basePath", f"{self.path}/txns")
            found.append(stored.parquet(*[batch_dir(f"{self.path}/txns", b) for b in later]))
        return _all(found, self.spark.createDataFrame([], MARKERS))


def _part_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path).select(*LOG_COLUMNS)


def _all(found: list[DataFrame], empty: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found) if found else empty


def _batch_of(folder: str) -> int:
    return int(folder.rpartition("-")[2])


def generations(spark: SparkSession, path: str) -> list[int]:
    """Generations whose manifest is complete."""
    manifests = f"{path}/manifests"
    return [g for g in batches_in(spark, manifests) if exists(spark, f"{batch_dir(manifests, g)}/_SUCCESS")]


def _manifest(spark: SparkSession, path: str, generation: int) -> list[dict]:
    stored = spark.read.schema(_MANIFEST).parquet(batch_dir(f"{path}/manifests", generation))
    return sorted((r.asDict() for r in stored.collect()), key=lambda p: p["first"])


def closed_batches(spark: SparkSession, path: str, after: int) -> list[int]:
    """Batches with markers that may go into parts, those up to ``after`` left out."""
    return [b for b in batches_in(spark, f"{path}/txns")[:-KEPT_BATCHES] if b > after]


def compact(spark: SparkSession, path: str) -> bool:
    """Move the closed batches into a part, and merge it with the tiers that are full. One writer at a
    time, which is the stream of the sink. Returns whether there was anything to do."""
    now = Snapshot(spark, path)
    closed = closed_batches(spark, path, now.upto)
    if not closed:
        return False
    stay, merged, tier = list(now.parts), [], 0
    while len(same := [p for p in stay if p["tier"] == tier]) >= FAN - 1:
        stay, merged, tier = [p for p in stay if p["tier"] != tier], same + merged, tier + 1
    generation = -1 if now.generation is None else now.generation
    part = {"part": f"part-{generation + 1}", "first": min(p["first"] for p in [*merged, {"first": closed[0]}]), "last": closed[-1], "tier": tier}
    taken = Snapshot(spark, path)
    taken.parts = merged
    entries, markers = taken.entries(closed[-1]), taken.markers(closed[-1])
    _write(entries, now.part_dir(part, "data"), slice_width(spark))
    markers.coalesce(1).write.mode("overwrite").parquet(now.part_dir(part, "txns"))
    parts = [tuple(p[c] for c in ("part", "first", "last", "tier")) for p in [*stay, part]]
    overwrite(spark.createDataFrame(parts, _MANIFEST).coalesce(1), f"{path}/manifests", generation + 1)
    _clean(spark, path, now, {p[0] for p in parts})
    return True


def _write(entries: DataFrame, path: str, width: int) -> None:
    """One file per partition and slice of offsets, so that a hot partition is several tasks' work."""
    placed = entries.withColumn("__slice", div(F.col("offset"), width))
    sorted_ = placed.repartition(*TP, "__slice").sortWithinPartitions(*TP, "offset").drop("__slice")
    sorted_.write.mode("overwrite").partitionBy(*TP).parquet(path)


def _clean(spark: SparkSession, path: str, before: Snapshot, in_force: set[str]) -> None:
    """Remove what the generation before already did without."""
    wanted = in_force | {p["part"] for p in before.parts}
    for name in names_in(spark, f"{path}/parts"):
        if name not in wanted:
            remove(spark, f"{path}/parts/{name}")
    for name in names_in(spark, f"{path}/data"):
        if name.startswith("txn_id=") and _batch_of(name) <= before.upto:
            remove(spark, f"{path}/data/{name}")
    for batch in batches_in(spark, f"{path}/txns"):
        if batch <= before.upto:
            remove(spark, batch_dir(f"{path}/txns", batch))
    for old in batches_in(spark, f"{path}/manifests"):
        if before.generation is not None and old < before.generation:
            remove(spark, batch_dir(f"{path}/manifests", old))
