"""Streams: failures between steps, repeated batches, callbacks, counters."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweave.schema import LOG
from logweave.sources.topic_log import TopicLog
from logweave.streaming import metrics, runs, stateful
from logweave.streaming.transactional import TxnSink, exactly_once

T0 = datetime(2024, 1, 1)


def write_batches(spark, path, total, size):
    """A one-partition log in files of ``size`` records, oldest file first."""
    for start in range(0, total, size):
        rows = [(i, T0 + timedelta(seconds=i), 0, str(i).encode(), b"v", None, None, False, "src", 0) for i in range(start, start + size)]
        TopicLog(spark, path).append(spark.createDataFrame(rows, LOG).coalesce(1))
    return TopicLog(spark, path)


def copy(batch):
    return batch.select(
        F.col("offset").alias("seq"), F.lit("dest").alias("topic"), (F.col("offset") % 2).cast("int").alias("partition"),
        "timestamp", "key", "value", "headers", F.lit(None).cast("string").alias("error"),
    )


def run(log, each, checkpoint):
    runs.start(log.read_stream(topics=["src"], max_files=1), each, checkpoint).awaitTermination()


def test_failure_aborts_one_batch_and_ends_the_stream(spark, tmp_path):
    log = write_batches(spark, f"{tmp_path}/log", 60, 10)
    told = []
    sink = TxnSink(spark, f"{tmp_path}/sink", on_complete=lambda batch, ok: told.append((batch, ok)))

    def transform(batch):
        return copy(batch).withColumn("error", F.when(F.col("seq") == 33, "TimeoutException"))

    with pytest.raises(Exception, match="TimeoutException"):
        run(log, exactly_once(transform, sink), f"{tmp_path}/cp")
    assert sink.read().count() == 30
    assert sink.committed().first().commit_offset == 30
    assert told == [(0, True), (1, True), (2, True), (3, False)]
    # the same batch succeeds after a restart, and the rest follows
    run(log, exactly_once(copy, sink), f"{tmp_path}/cp")
    seen = sink.read().collect()
    assert sorted(int(r.key) for r in seen) == list(range(60))
    assert len({(r.partition, r.offset) for r in seen}) == 60
    assert sink.committed().first().commit_offset == 60


@pytest.mark.parametrize("step", ["send_offsets", "commit"])
def test_crash_between_steps_leaves_nothing_visible(spark, tmp_path, step):
    log = write_batches(spark, f"{tmp_path}/log", 30, 10)

    class Crashing(TxnSink):
        pass

    def crash(self, *args):
        if args[-1] == 1:  # second batch
            raise OSError("machine lost")
        return getattr(TxnSink, step)(self, *args)

    setattr(Crashing, step, crash)
    with pytest.raises(Exception, match="machine lost"):
        run(log, exactly_once(copy, Crashing(spark, f"{tmp_path}/sink")), f"{tmp_path}/cp")
    sink = TxnSink(spark, f"{tmp_path}/sink")
    assert sink.read().count() == 10
    assert sink.read("read_uncommitted").count() == 20
    run(log, exactly_once(copy, sink), f"{tmp_path}/cp")
    assert sorted(int(r.key) for r in sink.read().collect()) == list(range(30))
    per_partition = sink.entries().groupBy("partition").agg(F.max("offset").alias("o"), F.count("*").alias("n")).collect()
    assert {(r.o, r.n) for r in per_partition} == {(17, 18)}  # 15 records, 3 control entries, no hole


def _offsets(spark, *rows):
    return spark.createDataFrame([("t", p, o) for p, o in rows], "topic string, partition int, commit_offset long")


def _requests(spark, partition, *seqs):
    rows = [(i, "dest", partition, T0, None) for i in seqs]
    return spark.createDataFrame(rows, "seq long, topic string, partition int, timestamp timestamp, error string").withColumns(
        {"key": F.lit(b"k"), "value": F.lit(b"v"), "headers": F.lit(None).cast(LOG["headers"].dataType)}
    )


def _committed(sink):
    return sorted((r.partition, r.commit_offset) for r in sink.committed().collect())


@pytest.mark.parametrize("middle", ["abort", "no offsets", "aborted offsets", "abort without data", "several"])
def test_offsets_survive_what_comes_between(spark, tmp_path, middle):
    sink = TxnSink(spark, f"{tmp_path}/sink")
    assert _committed(sink) == []
    sink.run(_requests(spark, 0, 1, 2), 0, _offsets(spark, (0, 5)))
    last = 2
    if middle == "no offsets":
        sink.run(_requests(spark, 0, 3), 1)
    elif middle == "abort without data":
        sink.abort(1)
    else:
        sink.write_data(_requests(spark, 0, 3), 1, ("seq",))
        if middle != "abort":
            sink.send_offsets(_offsets(spark, (0, 99)), 1)
        sink.abort(1)
    if middle == "several":
        last = 6
        sink.abort(2)
        sink.run(_requests(spark, 1, 4), 3)
        sink.run(_requests(spark, 0, 5), 4, _offsets(spark, (1, 3)))
        sink.abort(5)
    assert _committed(sink) == ([(0, 5), (1, 3)] if middle == "several" else [(0, 5)])
    sink.run(_requests(spark, 2, 6), last, _offsets(spark, (2, 7)))
    assert _committed(sink) == ([(0, 5), (1, 3), (2, 7)] if middle == "several" else [(0, 5), (2, 7)])
    # places in the log are given once, also those of aborted entries
    places = [(r.partition, r.offset) for r in sink.entries().collect()]
    assert len(places) == len(set(places))
    for table in ("ends", "offsets"):
        assert len(runs.batches_in(spark, f"{tmp_path}/sink/{table}")) <= 2


def test_versions_stay_bounded_and_a_repeat_changes_nothing(spark, tmp_path):
    sink = TxnSink(spark, f"{tmp_path}/sink")
    for batch in range(6):
        sink.run(_requests(spark, 0, batch), batch, _offsets(spark, (0, batch + 1)))
        before = sorted((r.partition, r.offset) for r in sink.read().collect())
        sink.run(_requests(spark, 0, batch), batch, _offsets(spark, (0, 1000)))
        assert sorted((r.partition, r.offset) for r in sink.read().collect()) == before and _committed(sink) == [(0, batch + 1)]
    for table in ("ends", "offsets"):
        assert runs.batches_in(spark, f"{tmp_path}/sink/{table}") == [4, 5]


def test_aborted_batch_may_succeed_when_repeated(spark, tmp_path):
    sink = TxnSink(spark, f"{tmp_path}/sink")
    sink.run(_requests(spark, 0, 0), 0, _offsets(spark, (0, 1)))
    bad = _requests(spark, 0, 1).withColumn("error", F.lit("TimeoutException"))
    with pytest.raises(Exception, match="TimeoutException"):
        sink.run(bad, 1, _offsets(spark, (0, 2)))
    assert _committed(sink) == [(0, 1)] and sink.state(1) == "aborted"
    sink.run(_requests(spark, 0, 1), 1, _offsets(spark, (0, 2)))
    assert _committed(sink) == [(0, 2)] and sink.state(1) == "committed"
    assert sorted(r.offset for r in sink.entries().collect()) == [0, 1, 2, 3]


def test_failing_store_stops_the_stream_and_is_retried_after_restart(spark, tmp_path):
    log = write_batches(spark, f"{tmp_path}/log", 20, 10)
    calls = []

    def broken(batch, batch_id):
        calls.append(batch_id)
        raise OSError("no store")

    with pytest.raises(Exception, match="no store"):
        run(log, runs.sink_then_commit(broken, attempts=3, pause_seconds=0), f"{tmp_path}/cp")
    assert calls == [0, 0, 0]
    run(log, runs.sink_then_commit(runs.batches_to(f"{tmp_path}/out")), f"{tmp_path}/cp")
    assert runs.read_batches(spark, f"{tmp_path}/out").groupBy("batch_id").count().count() == 2


def happened(spark, path, kind, offsets):
    rows = [(kind, "t", 0, o) for o in offsets]
    df = spark.createDataFrame(rows, "kind string, topic string, partition int, offset long")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def test_frontier_over_batches(spark, tmp_path):
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = happened(spark, path, "delivered", range(4))
    steps = [("acked", [3, 1, 2]), ("delivered", [4, 5]), ("acked", [0])]
    expected = [(None, 0), (None, 3), (None, 3), (4, 0)]

    def go():
        stream = spark.readStream.schema(schema).parquet(path)
        runs.start(stream, stateful.frontier(out), f"{tmp_path}/cp").awaitTermination()
        row = stateful.latest_frontier(spark.read.parquet(f"{out}/commits")).first()
        return row.commit_offset, row.deferred_count

    got = [go()]
    for kind, offsets in steps:
        happened(spark, path, kind, offsets)
        got.append(go())
    assert got == expected
    pending = spark.read.parquet(f"{out}/pending/batch_id=3").collect()
    assert sorted((r.offset, r.acked) for r in pending) == [(4, False), (5, False)]


def test_undecided_entries_are_held_back(spark, tmp_path):
    markers = []

    def txns():
        return spark.createDataFrame(markers, "txn_id string, state string")

    def entries(*rows):
        schema = "topic string, partition int, offset long, txn_id string, is_control boolean"
        return spark.createDataFrame([("t", p, o, x, False) for p, o, x in rows], schema)

    each = stateful.read_committed(f"{tmp_path}/out", txns)

    def seen():
        return sorted((r.partition, r.offset) for r in spark.read.parquet(f"{tmp_path}/out/visible").collect())

    each(entries((0, 0, None), (0, 1, "a"), (0, 2, None), (1, 0, None)), 0)
    assert seen() == [(0, 0), (1, 0)]
    each(entries((0, 3, "b"), (1, 1, "b")), 1)
    assert seen() == [(0, 0), (1, 0)]
    markers.append(("a", "committed"))
    each(entries((1, 2, None)), 2)
    assert seen() == [(0, 0), (0, 1), (0, 2), (1, 0)]
    markers.append(("b", "aborted"))
    each(entries((0, 4, None)), 3)
    assert seen() == [(0, 0), (0, 1), (0, 2), (0, 4), (1, 0), (1, 2)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    schema = "kind string, topic string, partition int, offset long"
    each = stateful.frontier(f"{tmp_path}/out")
    first = spark.createDataFrame([("delivered", "t", 0, o) for o in range(4)], schema)
    second = spark.createDataFrame([("acked", "t", 0, o) for o in (0, 1, 3)], schema)
    each(first, 0)
    for _ in range(3):
        each(second, 1)
    row = stateful.latest_frontier(spark.read.parquet(f"{tmp_path}/out/commits")).first()
    assert (row.commit_offset, row.deferred_count) == (2, 1)


def test_new_topics_join_a_pattern(spark, tmp_path):
    path, out = f"{tmp_path}/log", f"{tmp_path}/out"
    log = TopicLog(spark, path)

    def add(topic):
        log.append(spark.createDataFrame([(0, T0, 0, b"k", b"v", None, None, False, topic, 0)], LOG))

    def go():
        runs.to_files(log.read_stream(pattern="ev-.*"), out, f"{tmp_path}/cp").awaitTermination()
        return sorted(r.topic for r in spark.read.schema(LOG).parquet(out).collect())

    add("ev-a")
    add("other")
    assert go() == ["ev-a"]
    add("ev-b")
    assert go() == ["ev-a", "ev-b"]


def test_counters_and_lifecycle(spark, tmp_path):
    log = write_batches(spark, f"{tmp_path}/log", 20, 10)
    told = []
    listener = metrics.Lifecycle(lambda kind, name, detail: told.append(kind))
    spark.streams.addListener(listener)
    try:
        observed = metrics.observed(log.read_stream(topics=["src"], max_files=1), "consumer-1")
        query = runs.start(observed, metrics.count_batches(f"{tmp_path}/out", "consumer-1"), f"{tmp_path}/cp")
        query.awaitTermination()
        reported = [p.observedMetrics["client:consumer-1"]["records"] for p in query.recentProgress if p.numInputRows]
        table = metrics.counted(spark, f"{tmp_path}/out", {"env": "test"}).collect()
    finally:
        import time

        time.sleep(1)
        spark.streams.removeListener(listener)
    assert reported == [10, 10]
    assert sorted((r.client_id, r.batch_id, r.records, r.env) for r in table) == [("consumer-1", 0, 10, "test"), ("consumer-1", 1, 10, "test")]
    assert told[0] == "started" and "progress" in told and told[-1] == "terminated"


def test_shared_folder_is_the_configured_one(spark):
    from logweave.session import new_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or new_dir(spark, "x").startswith(configured)
    assert not os.path.exists(new_dir(spark, "x"))
