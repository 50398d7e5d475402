"""The stream whose position is a map of offsets: bounds, restarts, late partitions, replays."""

import json
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweave.schema import LOG
from logweave.sources.offset_stream import OffsetStreamReader, read_by_offsets, share
from logweave.sources.topic_log import TopicLog
from logweave.streaming import runs
from tests.test_manifest import entries


@given(st.dictionaries(st.integers(0, 20), st.integers(1, 10**12), min_size=1), st.integers(1, 10**12))
def test_share_uses_the_whole_limit(waiting, limit):
    given_out = share(waiting, limit)
    assert sum(given_out.values()) == min(limit, sum(waiting.values()))
    assert all(0 <= given_out[k] <= n for k, n in waiting.items())


def append(spark, log, *parts):
    """(topic, partition, first, number) each."""
    frames = [entries(spark, t, p, first, range(first, first + n)) for t, p, first, n in parts]
    for frame in frames:
        log.append(frame.repartition(2))


class Query:
    """One query over a log: what each run takes, in batches."""

    def __init__(self, spark, base, **options):
        self.spark, self.base, self.options = spark, str(base), options

    def run(self, each=None):
        stream = read_by_offsets(self.spark, f"{self.base}/log", position=f"{self.base}/position", **self.options)
        return runs.drain(stream, each or runs.batches_to(f"{self.base}/out"), f"{self.base}/checkpoint")

    def taken(self):
        return runs.read_batches(self.spark, f"{self.base}/out")

    def rows(self):
        return sorted((r.topic, r.partition, r.offset) for r in self.taken().collect())


def offsets(*parts):
    return sorted((t, p, o) for t, p, first, n in parts for o in range(first, first + n))


def test_batches_are_bounded_and_go_on_after_restarts(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    query = Query(spark, tmp_path, pattern="a.*", max_records=30, slice_records=7)
    first = [("a b", 0, 0, 100), ("a%", 1, 5, 3), ("other", 0, 0, 50)]
    append(spark, log, *first)
    assert query.run() == 3
    assert query.rows() == offsets(*first[:2])
    # a partition that comes late, more of an old one
    later = [("a b", 0, 100, 31), ("a late", 7, 40, 20)]
    append(spark, log, *later)
    query.run()
    assert query.rows() == offsets(*first[:2], *later)
    sizes = [r["count"] for r in query.taken().groupBy("batch_id").count().collect()]
    assert max(sizes) <= 30 and len(sizes) == 6
    # nothing new: nothing happens
    query.run()
    assert query.rows() == offsets(*first[:2], *later)


def test_all_columns_arrive(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    plain = entries(spark, "a", 0, 0, range(20))
    rich = plain.withColumn("headers", F.array(F.struct(F.lit("h").alias("key"), F.lit(b"\x00\xff").alias("value")), F.struct(F.lit("n").alias("key"), F.lit(None).cast("binary").alias("value"))))
    rich = rich.withColumn("txn_id", F.when(F.col("offset") % 2 == 0, "t")).withColumn("key", F.when(F.col("offset") % 3 == 0, F.col("key")))
    log.append(rich)
    query = Query(spark, tmp_path, topics=["a"])
    query.run()
    assert query.taken().drop("batch_id").schema.names == LOG.names
    assert sorted(map(str, query.taken().drop("batch_id").collect())) == sorted(map(str, log.all().collect()))


def test_a_failed_batch_is_repeated_with_the_same_records(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    append(spark, log, ("a", 0, 0, 50), ("a", 1, 0, 50))
    query, seen = Query(spark, tmp_path, topics=["a"], max_records=20), {}

    def failing(batch, batch_id):
        seen.setdefault(batch_id, []).append(sorted((r.partition, r.offset) for r in batch.collect()))
        if batch_id == 2 and len(seen[2]) == 1:
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        query.run(failing)
    append(spark, log, ("a", 2, 0, 10))
    query.run(failing)
    assert len(seen[2]) == 2 and seen[2][0] == seen[2][1]
    last = [batches[-1] for batches in seen.values()]
    assert sorted(sum(last, [])) == sorted([(p, o) for p in (0, 1) for o in range(50)] + [(2, o) for o in range(10)])
    assert max(map(len, last)) <= 20


def test_starting_offsets_and_assignment(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    append(spark, log, ("a", 0, 0, 10), ("a", 1, 0, 10), ("b", 0, 0, 10))
    named = Query(spark, tmp_path / "x", assignment=[("a", 0), ("b", 0)], starting={"a": {0: 7}}, max_per_partition=4)
    latest = Query(spark, tmp_path / "y", topics=["a"], starting="latest")
    for query in (named, latest):
        os.makedirs(query.base)
        os.symlink(f"{tmp_path}/log", f"{query.base}/log")
        query.run()
    assert named.rows() == offsets(("a", 0, 7, 3), ("b", 0, 0, 10))
    append(spark, log, ("a", 1, 10, 5), ("a", 3, 0, 2))
    named.run()
    latest.run()
    assert named.rows() == offsets(("a", 0, 7, 3), ("b", 0, 0, 10))
    assert latest.rows() == offsets(("a", 1, 10, 5), ("a", 3, 0, 2))


def test_empty_log_and_wrong_options(spark, tmp_path):
    assert OffsetStreamReader({"path": f"{tmp_path}/none", "topics": "a"}).latestOffset() == {}
    for options in ({}, {"topics": "a", "pattern": "b"}, {"topics": "a", "maxrecords": "5"}, {"topics": "a", "maxrecords": "0", "position": "p"}):
        with pytest.raises(ValueError):
            OffsetStreamReader({"path": "p", **options})


def test_a_foreign_position_is_an_error(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    append(spark, log, ("a", 0, 0, 10))
    reader = OffsetStreamReader({"path": log.path, "topics": "a", "maxrecords": "3", "position": f"{tmp_path}/position"})
    assert reader.latestOffset() == {"a": {"0": 3}}
    with pytest.raises(ValueError, match="go back"):
        reader.partitions({"a": {"0": 8}}, {"a": {"0": 3}})
    reader.partitions({}, {"a": {"0": 3}})
    again = OffsetStreamReader({"path": log.path, "topics": "a", "maxrecords": "3", "position": f"{tmp_path}/position"})
    assert again.latestOffset() == {"a": {"0": 6}}
    assert json.loads(open(sorted((tmp_path / "position").glob("end-*"))[-1]).read()) == {"position": {"a": {"0": 3}}}
