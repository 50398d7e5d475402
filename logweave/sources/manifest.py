"""Bounds and times of a topic log, kept beside it as the log grows.

``<log>/_bounds`` has a row for each data file: its partition, first and last offset, number of entries,
least and greatest timestamp, and a sparse time index, the greatest timestamp of each ``STEP`` offsets.
:meth:`TopicLog.append` adds the rows of the files it wrote. Readers list the files of the log, names
only, and summarise those that have no row yet, so a log that others append to is described as it is;
without such files no log column is read. A file that two writers described at once counts once.

Questions about times read the log only where the index says that the answer lies: the offsets of one
step, in the files that overlap them, per partition.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.plans.ordered import div
from logweave.schema import LOG, TP
from logweave.session import exists

#: Offsets behind one entry of the time index.
STEP = 4096
#: File names that a plan lists one by one; beyond that the log is read and joined with the names.
LISTED = 10_000
SCHEMA = (
    "file string, topic string, partition int, first_offset long, last_offset long, entries long, "
    "min_time timestamp, max_time timestamp, steps array<struct<first:long,last:long,max_time:timestamp>>"
)


def _place() -> Column:
    return F.substring_index("_metadata.file_path", "/", -3)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file, full): the data files of the log, by a listing."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(_place().alias("file"), F.col("_metadata.file_path").alias("full"))


def stored(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, f"{path}/_bounds"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/_bounds")


def read_files(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The entries of the files ``names`` (file, full), with their ``file``."""
    some = names.select("full").limit(LISTED + 1).collect()
    if not some:
        return spark.createDataFrame([], LOG).withColumn("file", F.lit(None).cast("string"))
    if len(some) > LISTED:
        whole = spark.read.schema(LOG).parquet(path).withColumn("file", _place())
        return whole.join(names.select("file"), "file", "left_semi")
    reader = spark.read.schema(LOG).option("basePath", path)
    return reader.parquet(*[unquote(r.full) for r in some]).withColumn("file", _place())


def summarise(entries: DataFrame) -> DataFrame:
    """A row of the manifest for each ``file`` of ``entries``; hash aggregates only."""
    step = entries.groupBy(*TP, "file", div(F.col("offset"), STEP).alias("step")).agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("low"),
        F.max("timestamp").alias("high"),
    )
    return step.groupBy("file", *TP).agg(
        F.min("first").alias("first_offset"),
        F.max("last").alias("last_offset"),
        F.sum("n").alias("entries"),
        F.min("low").alias("min_time"),
        F.max("high").alias("max_time"),
        F.sort_array(F.collect_list(F.struct("first", "last", F.col("high").alias("max_time")))).alias("steps"),
    )


def undescribed(spark: SparkSession, path: str) -> DataFrame:
    return files(spark, path).join(stored(spark, path).select("file"), "file", "left_anti")


def extend(spark: SparkSession, path: str) -> None:
    """Describe the files that have no row yet."""
    if not exists(spark, path):
        return
    new = summarise(read_files(spark, path, undescribed(spark, path)))
    new.coalesce(1).write.mode("append").parquet(f"{path}/_bounds")


def described(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of all files there are, described or not."""
    known = stored(spark, path)
    missing = undescribed(spark, path)
    # a row of a file that is gone says nothing about the log
    there = known.join(files(spark, path).select("file"), "file", "left_semi").dropDuplicates(["file"])
    if missing.isEmpty():
        return there
    return there.unionByName(summarise(read_files(spark, path, missing)).select(*known.columns))


def bounds(manifest: DataFrame) -> DataFrame:
    """(topic, partition, begin_offset, end_offset, entries) from rows of the manifest."""
    return manifest.groupBy(*TP).agg(
        F.min("first_offset").alias("begin_offset"),
        (F.max("last_offset") + 1).alias("end_offset"),
        F.sum("entries").alias("entries"),
    )


def located(manifest: DataFrame, targets: DataFrame) -> DataFrame:
    """Of ``targets(topic, partition, target)``: the offsets ``low`` to ``high`` within which the first
    entry stamped at or after the target lies; null where no entry is late enough.

    ``low`` begins the first step that has such an entry. An earlier one would lie in a step that
    begins earlier, and this step ends with ``high``, so the answer is not beyond it."""
    wanted = targets.groupBy(*TP).agg(F.min("target").alias("target"))
    late = manifest.join(wanted, TP).where(F.col("max_time") >= F.col("target"))
    steps = late.select(*TP, "target", F.inline("steps")).where(F.col("max_time") >= F.col("target"))
    best = steps.groupBy(*TP).agg(F.min("first").alias("low"), F.min_by("last", "first").alias("high"))
    return wanted.join(best, TP, "left")


def first_at_or_after(spark: SparkSession, path: str, manifest: DataFrame, targets: DataFrame) -> DataFrame:
    """(topic, partition, found_offset) for each partition of the log that has a target; null where no
    entry is late enough. Reads the files that overlap the located steps only."""
    spans = located(manifest, targets)
    overlap = (F.col("first_offset") <= F.col("high")) & (F.col("last_offset") >= F.col("low"))
    hit = manifest.join(spans, TP).where(overlap).select("file").distinct()
    entries = read_files(spark, path, files(spark, path).join(hit, "file", "left_semi"))
    within = entries.join(spans, TP).where(F.col("offset").between(F.col("low"), F.col("high")) & (F.col("timestamp") >= F.col("target")))
    found = within.groupBy(*TP).agg(F.min("offset").alias("found_offset"))
    return manifest.select(*TP).distinct().join(spans.select(*TP), TP, "left_semi").join(found, TP, "left")
