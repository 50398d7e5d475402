"""The manifest of a log against the log itself."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweave.functions.codec import decode_json
from logweave.schema import LOG
from logweave.sources import catalog, manifest, starts
from logweave.sources.topic_log import TopicLog

T0 = datetime(2024, 1, 1)


def entries(spark, topic, partition, first, stamps):
    rows = [(first + i, T0 + timedelta(seconds=s), 0, b"k", b"v", None, None, False, topic, partition) for i, s in enumerate(stamps)]
    return spark.createDataFrame(rows, LOG)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


BOUNDS = ["topic", "partition", "begin_offset", "end_offset", "entries"]


@pytest.fixture
def log(spark, tmp_path, monkeypatch):
    """Two topics in several appends; times go up and down, and files share ranges of offsets."""
    monkeypatch.setattr(manifest, "STEP", 8)
    rng = random.Random(5)
    log = TopicLog(spark, f"{tmp_path}/log")
    for n in range(3):
        parts = [entries(spark, "a b", p, n * 40, [rng.randrange(n * 30, n * 30 + 60) for _ in range(40)]) for p in (0, 1)]
        log.append(parts[0].unionByName(parts[1]).unionByName(entries(spark, "z%", 0, n * 2, [n, n])).repartition(2))
    return log


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan (\w+) .*?ReadSchema: (struct<.*?>)", plan, re.S), plan


def test_bounds_read_no_log_column(spark, log):
    found = log.bounds(pattern="a.*")
    assert rows(found, *BOUNDS) == rows(catalog.topic_bounds(log.read(pattern="a.*")), *BOUNDS)
    assert rows(log.bounds(), *BOUNDS) == rows(catalog.topic_bounds(log.all()), *BOUNDS)
    read, plan = scans(found)
    kinds = {kind for kind, _ in read}
    assert kinds == {"parquet", "binaryFile"}
    assert all("content" not in schema for kind, schema in read if kind == "binaryFile")
    assert all("file" in schema and "steps" not in schema for kind, schema in read if kind == "parquet")
    assert all("_bounds" in where for where in re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\S* ?[^\n]*?\[(.*?)\]", plan))
    assert "timestamp" not in plan and "key#" not in plan


def test_files_of_others_count_at_once(spark, log):
    more = entries(spark, "a b", 1, 120, [500, 3, 4])
    more.write.mode("append").partitionBy("topic", "partition").parquet(log.path)
    assert rows(log.bounds(), *BOUNDS) == rows(catalog.topic_bounds(log.all()), *BOUNDS)
    log.describe()
    log.describe()
    assert rows(log.bounds(), *BOUNDS) == rows(catalog.topic_bounds(log.all()), *BOUNDS)
    described = manifest.stored(spark, log.path)
    assert described.count() == manifest.files(spark, log.path).count()
    # a second writer describes the same files
    described.write.mode("append").parquet(f"{log.path}/_bounds")
    assert rows(log.bounds(), *BOUNDS) == rows(catalog.topic_bounds(log.all()), *BOUNDS)


def test_starts_from_bounds(spark, log):
    whole, known = log.all(), log.bounds()
    commits = spark.createDataFrame([("g", "a b", 0, 7, 1)], "group_id string, topic string, partition int, commit_offset long, commit_no int")
    half = lambda assigned: assigned.select("topic", "partition", F.expr("end_offset div 2").alias("start_offset"))
    for make in (
        lambda **b: starts.seek_to_end(whole, **b),
        lambda **b: starts.seek(whole, 3, **b),
        lambda **b: starts.resume(whole, commits, "g", "latest", **b),
        lambda **b: starts.resolve(whole, half, **b),
        lambda **b: catalog.consumer_lag(whole, commits, "g", **b).withColumnRenamed("position", "start_offset"),
    ):
        assert rows(make(bounds=known), "topic", "partition", "start_offset") == rows(make(), "topic", "partition", "start_offset")
    assert {r[2] for r in rows(starts.seek_to_beginning(whole, known), "topic", "partition", "start_offset")} == {0}


def test_times_by_index(spark, log, monkeypatch):
    whole = log.all().select("topic", "partition", "offset", "timestamp").collect()
    opened, kept = [], manifest.read_files
    monkeypatch.setattr(manifest, "read_files", lambda s, p, names: opened.append(names.count()) or kept(s, p, names))
    for second in (-5, 0, 17, 45, 63, 80, 119, 400):
        at = T0 + timedelta(seconds=second)
        targets = spark.createDataFrame([("a b", 0, at), ("a b", 1, at + timedelta(seconds=9)), ("none", 0, at)], "topic string, partition int, target timestamp")
        want = []
        for partition, limit in ((0, at), (1, at + timedelta(seconds=9))):
            late = [r.offset for r in whole if (r.topic, r.partition) == ("a b", partition) and r.timestamp >= limit]
            want.append(("a b", partition, min(late, default=None)))
        assert rows(log.offsets_for_times(targets), "topic", "partition", "found_offset") == want
    # of six files a partition has, those that overlap one step: two an append
    assert max(opened) <= 4 < manifest.files(spark, log.path).where("file like 'topic=a%'").count()


def test_empty_log(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    log.append(spark.createDataFrame([], LOG))
    log.append(entries(spark, "t", 0, 0, [1]))
    assert rows(log.bounds(), *BOUNDS) == [("t", 0, 0, 1, 1)]


def test_seek_names_partitions_that_exist(spark, log):
    named = spark.createDataFrame([("a b", 9, 0)], "topic string, partition int, start_offset long")
    for known in (None, log.bounds()):
        with pytest.raises(Exception, match="cannot seek a b-9"):
            starts.seek(log.all(), named, known).collect()


def test_readable_and_null_are_two_things(spark):
    values = ['{"k":null}', "{}", '{"k":', "null", "", None, '{"k":"x"}', "[1]", '{"k":2,"other":3}', "x"]
    df = spark.createDataFrame([(i, v.encode() if v is not None else None) for i, v in enumerate(values)], "i int, value binary")
    found = {r.i: (r.decoded_ok, r.k, r.s) for r in decode_json(df, "value", "k long, s string").collect()}
    good = {i: r for i, r in found.items() if r[0]}
    assert good == {0: (True, None, None), 1: (True, None, None), 8: (True, 2, None)}
    assert all(r[1:] == (None, None) for i, r in found.items() if i not in good)
