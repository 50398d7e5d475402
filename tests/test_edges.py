"""Cases at the edges: null groups, doubled starts, several senders, state that is forgotten."""

import os

import pytest
from pyspark.sql import functions as F

from logweave.operators import commits, records, send
from logweave.plans.ordered import Running, running
from logweave.session import new_dir
from logweave.sources import starts
from logweave.streaming import runs, stateful


def test_null_groups_carry_on(spark):
    df = spark.createDataFrame([(g, i, 1) for g in ("a", None) for i in range(10)], "g string, i long, n long")
    spark.conf.set("spark.logweave.sliceWidth", "3")
    try:
        got = running(df, ["g"], ["i"], [Running("sum", "sum", F.col("n"))]).collect()
    finally:
        spark.conf.unset("spark.logweave.sliceWidth")
    assert sorted((str(r.g), r.i, r.sum) for r in got) == sorted((str(g), i, i + 1) for g in ("a", None) for i in range(10))


@pytest.mark.parametrize("literals", [128, 0])
def test_start_maps(spark, monkeypatch, literals):
    monkeypatch.setattr(starts, "LITERAL_PARTITIONS", literals)
    log = spark.createDataFrame([("t", p, o) for p in range(3) for o in range(5)], "topic string, partition int, offset long")
    at = spark.createDataFrame([("t", 0, 4), ("t", 0, 2), ("t", 1, 3)], "topic string, partition int, start_offset long")
    keep = {(0, 2), (0, 3), (0, 4), (1, 3), (1, 4)}
    assert {(r.partition, r.offset) for r in starts.read_from(log, at).collect()} == keep
    assert starts.read_from(log, at).count() == 5
    assert {(r.partition, r.offset) for r in starts.read_from(log, at, "read").collect()} == keep | {(2, o) for o in range(5)}


def test_two_senders_do_not_depend_on_the_layout(spark):
    rows = [("t", 0, s, q, None) for s in (1, 2) for q in range(500)]
    requests = spark.createDataFrame(rows, "topic string, partition int, sender_id int, seq long, error string")
    first, second = ({(r.sender_id, r.seq): r.offset for r in send.assign_offsets(requests.repartition(n), senders=2).collect()} for n in (3, 7))
    assert first == second and sorted(first.values()) == list(range(1000))


def test_ordered_steps_must_say_what_they_keep(spark):
    log = spark.createDataFrame([("t", 0, 0)], "topic string, partition int, offset long")
    with pytest.raises(ValueError):
        records.process_by_partition(log, lambda pdf, _: pdf, "topic string, partition int, offset long")
    stream = spark.readStream.format("rate").load().select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("value").alias("offset"))
    with pytest.raises(ValueError):
        records.process_by_partition(stream, lambda pdf, _: pdf, log.schema, stateless=True)


def feed(spark, path, rows, schema, run):
    query = None
    for part in rows:
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        query = run(path)
        query.awaitTermination()
    return query


def test_two_state_versions_stay(spark):
    base, schema = new_dir(spark, "versions"), "kind string, topic string, partition int, offset long"
    rows = [[("delivered", "t", 0, i), ("acked", "t", 0, i)] for i in range(5)]
    feed(spark, f"{base}/in", rows, schema, lambda p: runs.start(spark.readStream.schema(schema).parquet(p), stateful.frontier(f"{base}/out"), f"{base}/check"))
    folder = f"{base}/out/pending".removeprefix("file:")
    assert sorted(x for x in os.listdir(folder) if x.startswith("batch_id")) == ["batch_id=3", "batch_id=4"]
    assert stateful.latest_frontier(spark.read.parquet(f"{base}/out/commits")).first().commit_offset == 5


def test_closed_intervals_leave_the_state(spark):
    base, schema = new_dir(spark, "intervals"), "member_id int, topic string, partition int, offset long, ack_seq long, ack_time timestamp"
    stamps = ["2024-01-01 00:10:00", "2024-01-01 01:10:00", "2024-01-01 02:10:00"]
    rows = [[(0, "t", 0, i, i)] for i in range(3)]

    def run(path):
        stream = spark.readStream.schema(schema).parquet(path).withWatermark("ack_time", "0 seconds")
        return runs.start(commits.commit_by_interval(stream, "1 hour"), runs.batches_to(f"{base}/out"), f"{base}/check")

    removed = 0
    for part, stamp in zip(rows, stamps):
        frame = spark.createDataFrame(part, "member_id int, topic string, partition int, offset long, ack_seq long")
        frame.withColumn("ack_time", F.lit(stamp).cast("timestamp")).write.mode("append").parquet(f"{base}/in")
        query = run(f"{base}/in")
        query.awaitTermination()
        removed += sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"])
    assert removed == 2
    assert spark.read.parquet(f"{base}/out").count() == 2
