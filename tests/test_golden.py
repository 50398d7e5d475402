"""Small cases with known results, and error cases."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweave.functions.codec import bytes_to_int, decode_layout, encode_layout, int_to_bytes
from logweave.functions.headers import header, last_header, last_header_bytes, with_headers
from logweave.operators import commits, delivery, frontier, records, send, stats, tracing, transactions
from logweave.schema import LOG, TP
from logweave.sources import catalog, isolation, starts
from logweave.sources.topic_log import kafka_options, selection

T0 = datetime(2024, 1, 1)
PERSON = [("id", "int"), ("first_name", "string"), ("last_name", "string"), ("email", "string_or_null")]


def log_of(spark, n, partitions=4, topic="t"):
    rows = [(i // partitions, T0 + timedelta(seconds=i), 0, None, f"Message {i}".encode(), None, None, False, topic, i % partitions) for i in range(n)]
    return spark.createDataFrame(rows, LOG)


def requests_of(spark, n, partitions=4, bad=(), sender="s", error="InvalidTopicException"):
    rows = [(sender, i, "t", i % partitions, T0 + timedelta(seconds=i), b"k", b"v", i, error if i in bad else None) for i in range(n)]
    schema = "sender_id string, seq long, topic string, partition int, timestamp timestamp, key binary, value binary, correlation long, error string"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("headers", F.lit(None).cast(LOG["headers"].dataType))


def marked_of(spark, delivered, acked):
    rows = [("t", p, o, (p, o) in acked) for p, o in delivered]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, acked boolean")


# -- frontier ---------------------------------------------------------------------------------


def frontier_rows(spark, delivered, acked, revoked=None):
    got = frontier.commit_frontier(marked_of(spark, delivered, acked), revoked).collect()
    return {r.partition: (r.commit_offset, r.deferred_count) for r in got}


def test_out_of_order_acks_commit_once_complete(spark):
    four = [(0, o) for o in range(4)]
    assert frontier_rows(spark, four, set(four)) == {0: (4, 0)}
    assert frontier_rows(spark, four, {(0, 3), (0, 1), (0, 2)}) == {0: (None, 3)}


def test_two_partitions(spark):
    both = [(p, o) for p in (0, 1) for o in (0, 1)]
    assert frontier_rows(spark, both, set(both)) == {0: (2, 0), 1: (2, 0)}


def test_pause_when_deferred_reaches_limit(spark):
    four = [(0, o) for o in range(4)]
    state = frontier.commit_frontier(marked_of(spark, four, {(0, 3), (0, 1), (0, 2)}))
    row = frontier.deferred_pause(state, 2, F.lit(0)).first()
    assert (row.deferred_total, row.would_pause) == (3, True)
    assert not frontier.deferred_pause(state, 4, F.lit(0)).first().would_pause


def test_gaps_in_offsets_are_not_missing_acks(spark):
    assert frontier_rows(spark, [(0, 0), (0, 5), (0, 9)], {(0, 0), (0, 5)}) == {0: (6, 0)}


def test_revoked_partition_has_no_state(spark):
    both = [(p, o) for p in (0, 1) for o in (0, 1)]
    revoked = spark.createDataFrame([("t", 0)], "topic string, partition int")
    assert frontier_rows(spark, both, set(both), revoked) == {1: (2, 0)}


def test_unknown_and_repeated_acks_have_no_effect(spark):
    delivered = log_of(spark, 3, 1).select(*TP, "offset")
    acks = spark.createDataFrame([("t", 0, 0), ("t", 0, 0), ("t", 0, 77)], "topic string, partition int, offset long")
    marked = frontier.mark_acked(delivered, acks)
    assert marked.count() == 3
    assert frontier.commit_frontier(marked).first().commit_offset == 1
    assert frontier.in_flight(marked, F.lit(0)).first().in_flight == 2


# -- commits ----------------------------------------------------------------------------------


def acks_of(spark, offsets):
    rows = [(0, "t", 0, o, i, T0 + timedelta(seconds=i)) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "member_id int, topic string, partition int, offset long, ack_seq long, ack_time timestamp")


def test_commit_by_size(spark):
    got = commits.commit_by_size(acks_of(spark, range(10)), 4).collect()
    assert sorted((r.commit_no, r.commit_offset) for r in got) == [(0, 4), (1, 8), (2, 10)]


def test_last_ack_wins(spark):
    row = commits.commit_in_order(acks_of(spark, [0, 5, 3])).first()
    assert (row.commit_offset, row.regressed) == (4, True)


def test_first_ack_counts(spark):
    first = commits.first_acks(acks_of(spark, [0, 1, 0, 2, 1]))
    assert sorted((r.offset, r.ack_seq) for r in first.collect()) == [(0, 0), (1, 1), (2, 3)]


def test_tick_restarts_the_count(spark):
    got = commits.commit_by_size_or_interval(acks_of(spark, range(10)), 4, "5 seconds").collect()
    assert sorted((r.tick.second, r.commit_no, r.commit_offset) for r in got) == [(0, 0, 4), (0, 1, 5), (5, 0, 9), (5, 1, 10)]


def test_manual_commits_carry_earlier_acks(spark):
    calls = acks_of(spark, range(6)).withColumn("commit", F.col("offset").isin(2, 3))
    got = commits.commit_each(calls).collect()
    assert sorted((r.commit_no, r.commit_offset, r.acks) for r in got) == [(-1, 6, 2), (0, 3, 3), (1, 4, 1)]


def test_at_most_once_stays_within_bounds(spark):
    log = log_of(spark, 40)
    exact = delivery.at_most_once_ledger(log, 5, contiguous=True).collect()
    assert all(r.offset <= r.committed <= r.offset + 6 for r in exact)
    assert sorted(exact) == sorted(delivery.at_most_once_ledger(log, 5).collect())
    assert {r.kind for r in delivery.at_most_once_ledger(log, 0).collect()} == {"sync"}
    undo = delivery.commit_ahead_undo(delivery.at_most_once_ledger(log, 5))
    assert {(r.rewind_to, r.committed) for r in undo.collect()} == {(10, 15)}


@pytest.mark.parametrize("ahead", [0, 1, 5, 9])
def test_at_most_once_with_gaps(narrow, ahead):
    rng = random.Random(ahead)
    offsets = sorted(rng.sample(range(600), 200))
    expected, c = {}, -1
    for o in offsets:
        kind = "sync" if o >= c else "async" if c - o >= ahead // 2 else "none"
        c = c if kind == "none" else o + ahead + 1
        expected[o] = (kind, c)
    log = narrow.createDataFrame([("t", 0, o) for o in offsets], "topic string, partition int, offset long")
    got = delivery.at_most_once_ledger(log, ahead).collect()
    assert {r.offset: (r.kind, r.committed) for r in got} == expected


def test_failure_in_the_second_batch(spark):
    log = log_of(spark, 30, 1).withColumn("key_no", F.col("offset"))
    batched = commits.poll_batches(log, 10, F.lit(0))
    states = delivery.exactly_once_outcome(batched, F.col("key_no") == 15).collect()
    assert sorted((r.batch_id, r.state) for r in states) == [(0, "committed"), (1, "aborted"), (2, "not_started")]


def test_delivery_audit(spark):
    log = log_of(spark, 10, 1)
    dispatched = log.where((F.col("offset") < 8) & (F.col("offset") != 2)).select(*TP, "offset")
    newest = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, commit_offset long")
    row = delivery.delivery_audit(log, dispatched, newest).first()
    assert (row.redelivered, row.lost) == (3, 1)


# -- sending ----------------------------------------------------------------------------------


def test_offsets_per_partition_follow_request_order(spark):
    sent = send.assign_offsets(requests_of(spark, 10)).collect()
    assert {r.seq: (r.partition, r.offset) for r in sent} == {i: (i % 4, i // 4) for i in range(10)}


def test_every_request_has_a_result_when_errors_are_recorded(spark):
    requests = requests_of(spark, 20, bad=range(0, 20, 2))
    results = send.send_results(send.assign_offsets(send.continue_on_error(requests))).collect()
    assert len(results) == 20
    assert all((r.exception is None) != (r.offset is None) for r in results)
    status = send.send_status(requests).first()
    assert (status.failed, status.first_error) == (10, "InvalidTopicException")


def test_stop_on_error_gives_no_result_for_the_failed_request(spark):
    kept = send.stop_on_error(requests_of(spark, 20, bad=[7, 9])).collect()
    assert sorted(r.seq for r in kept) == list(range(7))


def test_fatal_errors_always_stop(spark):
    requests = requests_of(spark, 20, bad=[7], error="ProducerFencedException")
    assert send.continue_on_error(requests).count() == 7


def test_unknown_topics_fail(spark):
    checked = send.check_topics(requests_of(spark, 3), ["other"])
    assert {r.error for r in checked.collect()} == {"InvalidTopicException"}


def test_chain_stops_at_the_failing_link(spark):
    links = [requests_of(spark, 3), requests_of(spark, 5, bad=[2]), requests_of(spark, 4)]
    sent = send.assign_chain_offsets(send.chain(links)).collect()
    assert sorted((r.link_no, r.seq) for r in sent) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_chain_steps_run_in_order(spark):
    done = []

    def fail():
        raise ValueError("task")

    with pytest.raises(ValueError):
        send.run_chain(lambda df: done.append(df.count()), [requests_of(spark, 3), lambda: done.append("task"), fail, requests_of(spark, 4)])
    assert done == [3, "task"]


def test_resume_after_failure(spark):
    requests = requests_of(spark, 10, bad=[4])
    results = send.send_results(send.assign_offsets(send.stop_on_error(requests)))
    left = send.remaining(requests, results).collect()
    assert sorted(r.correlation for r in left) == [4, 5, 6, 7, 8, 9]


# -- transactions -----------------------------------------------------------------------------


def test_markers_take_up_an_offset(spark):
    entries, markers = transactions.send_transactional(requests_of(spark, 100).withColumn("txn_no", F.lit(0)))
    assert {r.end_offset for r in catalog.topic_bounds(entries).collect()} == {26}
    assert isolation.read_committed(entries, markers).count() == 100


def test_transactions_after_an_abort_do_not_start(spark):
    requests = transactions.count_windows(requests_of(spark, 30, bad=[15]), 10)
    states = transactions.txn_status(requests).collect()
    assert sorted((r.txn_no, r.state) for r in states) == [(0, "committed"), (1, "aborted"), (2, "not_started")]
    entries, markers = transactions.send_transactional(requests)
    assert isolation.read_committed(entries, markers).count() == 10
    assert isolation.read_uncommitted(entries).count() == 15


def test_open_transaction_hides_what_follows_in_its_partition(spark):
    rows = [("t", 0, 0, None), ("t", 0, 1, "open"), ("t", 0, 2, None), ("t", 1, 0, None), ("t", 1, 1, "bad"), ("t", 1, 2, None)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, txn_id string").withColumn("is_control", F.lit(False))
    txns = spark.createDataFrame([("bad", "aborted")], "txn_id string, state string")
    seen = isolation.read(log, txns, "read_committed").collect()
    assert sorted((r.partition, r.offset) for r in seen) == [(0, 0), (1, 0), (1, 2)]
    assert isolation.read(log).count() == 6


def anchored_brute(times, d):
    out, start, no = [], times[0], 0
    for t in times:
        closes = t >= start + d
        out.append((no, closes, start))
        if closes:
            start, no = t, no + 1
    return out


@pytest.mark.parametrize("d", [1, 40, 1000])
def test_anchored_windows_with_equal_times(narrow, d):
    rng = random.Random(d)
    times = sorted(rng.choices(range(2000), k=600))
    rows = [("s", i, T0 + timedelta(milliseconds=t)) for i, t in enumerate(times)]
    df = narrow.createDataFrame(rows, "sender_id string, seq long, timestamp timestamp")
    got = transactions.anchored_windows(df, d).orderBy("seq").collect()
    base = int(T0.timestamp() * 1000)
    zone = got[0].window_start - base - times[0]  # local clock against UTC
    assert [(r.txn_no, r.closes, r.window_start - base - zone) for r in got] == anchored_brute(times, d)


# -- starts -----------------------------------------------------------------------------------


def test_seek_to_offset(spark):
    log = log_of(spark, 20)
    assert starts.read_from(log, starts.seek(log, 1)).count() == 16
    assert starts.read_from(log, starts.seek(log, 5)).count() == 0
    for wrong in (-1, 6):
        with pytest.raises(Exception, match="cannot seek"):
            starts.read_from(log, starts.seek(log, wrong)).count()


def test_large_start_maps_are_joined(spark, monkeypatch):
    log = log_of(spark, 40)
    start_map = starts.seek(log, 3)
    expected = sorted(map(str, starts.read_from(log, start_map).collect()))
    monkeypatch.setattr(starts, "LITERAL_PARTITIONS", 1)
    assert sorted(map(str, starts.read_from(log, start_map).collect())) == expected


def test_seek_to_timestamp_past_the_end(spark):
    log = log_of(spark, 8)
    assert {r.start_offset for r in starts.seek_to_timestamp(log, "2030-01-01").collect()} == {2}


def test_selection_needs_exactly_one_way():
    for wrong in ({}, {"topics": ["a"], "pattern": "b"}):
        with pytest.raises(ValueError):
            selection(**wrong)


def test_pattern_matches_whole_names(spark):
    log = log_of(spark, 4, topic="topic1").unionByName(log_of(spark, 4, topic="topic10"))
    assert log.where(selection(pattern="topic.")).count() == 4
    assert log.where(selection(pattern="topic1|x")).count() == 4


def test_unknown_topic(spark):
    with pytest.raises(ValueError):
        catalog.list_partitions(log_of(spark, 4), "nope")


def test_live_options():
    options = kafka_options("host:1", assignment=[("t", 0), ("t", 2)], starting={"t": {0: 5, 2: 7}}, isolation="read_committed")
    assert options["assign"] == '{"t": [0, 2]}'
    assert options["startingOffsets"] == '{"t": {"0": 5, "2": 7}}'
    assert options["kafka.isolation.level"] == "read_committed"
    assert kafka_options("h", pattern="a.*", starting="latest")["subscribePattern"] == "a.*"


# -- records, headers, bytes ------------------------------------------------------------------


def test_last_header_wins(spark):
    df = spark.createDataFrame([("x",)], "v string").select(
        with_headers(F.lit(None).cast(LOG["headers"].dataType), F.struct(F.lit("header1").alias("key"), F.unhex(F.lit("00")).alias("value")), header("h", F.lit("a")), header("h", F.col("v"))).alias("headers")
    )
    row = df.select(
        last_header(F.col("headers"), "h").alias("h"),
        last_header_bytes(F.col("headers"), "header1").alias("b"),
        last_header(F.col("headers"), "none").alias("n"),
    ).first()
    assert (row.h, bytes(row.b), row.n) == ("x", b"\x00", None)


def test_integers_round_trip(spark):
    values = [0, 1, -1, 255, 2**31 - 1, -(2**31)]
    df = spark.createDataFrame([(v,) for v in values], "v int").select("v", int_to_bytes(F.col("v")).alias("b"))
    got = df.select("v", "b", bytes_to_int(F.col("b")).alias("back")).collect()
    assert all(r.back == r.v and bytes(r.b) == r.v.to_bytes(4, "big", signed=True) for r in got)
    assert spark.sql("SELECT X'0102' AS b").select(bytes_to_int(F.col("b"))).first()[0] is None


def test_person_bytes(spark):
    rows = [(1, "foo", "bär", None), (2, "", "b", "x@y")]
    df = spark.createDataFrame(rows, "id int, first_name string, last_name string, email string")
    data = df.select(encode_layout({n: F.col(n) for n, _ in PERSON}, PERSON).alias("data"))
    assert sorted(tuple(r) for r in decode_layout(data, "data", PERSON).select(*[n for n, _ in PERSON]).collect()) == rows


@pytest.mark.parametrize("broken", ["", "000000", "00000001", "00000001FFFFFFFF", "000000010000000361", "0000000100000001610000000162"])
def test_broken_bytes_go_to_dead_letters(spark, broken):
    df = spark.createDataFrame([(bytes.fromhex(broken),)], "data binary")
    row = decode_layout(df, "data", PERSON).first()
    assert (row.decoded_ok, row.id, row.first_name) == (False, None, None)


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    b = spark.createDataFrame([("x",), ("z",)], "v string")
    got = records.reconcile(a, b, ["v"]).collect()
    assert sorted((r.v, r.missing, r.extra) for r in got) == [("x", 1, 0), ("y", 1, 0), ("z", 0, 1)]


def test_processing_keeps_order_and_state_across_slices(narrow):
    log = log_of(narrow, 1000, 3).select("topic", "partition", "offset")
    out = records.process_by_partition(
        log,
        step=lambda pdf, before: pdf[["partition", "offset"]].assign(seen=range(before + 1, before + 1 + len(pdf))),
        schema="partition int, offset long, seen long",
        summary=len,
        combine=lambda a, b: a + b,
        initial=0,
    ).collect()
    assert len(out) == 1000 and all(r.seen == r.offset + 1 for r in out)


def test_take_beyond_the_pushed_limit(narrow, monkeypatch):
    monkeypatch.setattr(records, "LIMIT_PUSHED", 10)
    log = log_of(narrow, 1000)
    kept = records.take(log, 100, ["topic", "partition"], ["offset"])
    assert {(r.partition, r.offset) for r in kept.collect()} == {(p, o) for p in range(4) for o in range(100)}


def test_order_check(spark):
    log = log_of(spark, 12, 2).withColumn("v", F.when(F.col("offset") == 3, F.lit(0)).otherwise(F.col("offset").cast("int")))
    assert {r.violations for r in records.check_partition_order(log, "v").collect()} == {1}


# -- statistics and traces --------------------------------------------------------------------


def test_integrity(spark):
    sent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, body string")
    got = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c"), (3, "c"), (9, "z")], "id int, body string")
    found = stats.integrity_check(sent, got, "id", "body").collect()
    assert {r.id: r.status for r in found} == {2: "mismatched", 3: "duplicate", 4: "missing", 9: "unexpected"}


def test_compare_runs(spark):
    schema = "k string, records_per_sec double, latency_ms double"
    base = spark.createDataFrame([("a", 100.0, 10.0), ("b", 100.0, 1.0)], schema)
    new = spark.createDataFrame([("a", 40.0, 25.0), ("b", 60.0, 4.0)], schema)
    got = {r.k: (r.rate_ok, r.latency_ok) for r in stats.compare_runs(base, new, ["k"], 50).collect()}
    assert got == {"a": (False, False), "b": (True, True)}


def test_sampling_step(spark):
    sends = spark.range(25).select(F.col("id").alias("seq"))
    assert stats.sample_latencies(sends, 25, 10).count() == 13  # every second one
    assert stats.sample_latencies(sends, 25).count() == 25


def test_span_counts(spark):
    rows = [(1, i, "sender", "t", "p") for i in range(10)] + [(1, i, "receiver", "t", "c") for i in range(10)]
    spans = spark.createDataFrame(rows, "trace_id int, record_id int, span_type string, topic string, client_id string")
    report = tracing.trace_report(spans).collect()
    assert {(r.span_name, r.spans) for r in report} == {("t publish", 10), ("t receive", 10)}
    assert tracing.unmatched_spans(spans).first().unreceived == 0
