"""Commit policies, frontier, at-most-once and exactly-once outcomes."""

from pyspark.sql import functions as F

from logweave.operators import commits, delivery, frontier
from logweave.schema import TP
from workload import fixtures as fx
from workload import query
from workload.sql import A, C, L


@query(
    f"""WITH {L}, {A} SELECT part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, MAX(log_offset) > MAX_BY(log_offset, ack_seq) AS regressed FROM a GROUP BY part_id"""
)
def commit_in_order(spark, sf):
    return fx.plain(commits.commit_in_order(fx.acks(spark, sf)).drop("topic"))


@query(
    f"""WITH {L}, {A}, c AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY ack_seq) - 1) // 500 AS commit_no FROM a)
SELECT member_id, commit_no, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks FROM c GROUP BY ALL"""
)
def commit_by_size(spark, sf):
    return fx.plain(commits.commit_by_size(fx.acks(spark, sf), 500).drop("topic"))


@query(
    f"""WITH {L}, {A} SELECT member_id, time_bucket(INTERVAL 6 HOURS, ts) AS tick, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks FROM a GROUP BY ALL"""
)
def commit_by_interval(spark, sf):
    return fx.plain(commits.commit_by_interval(fx.acks(spark, sf), "6 hours").drop("topic"))


@query(
    f"""WITH {L}, {A}, t AS (SELECT *, date_trunc('day', ts) AS tick FROM a),
c AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY member_id, tick ORDER BY ack_seq) - 1) // 60 AS commit_no FROM t)
SELECT member_id, CAST(tick AS TIMESTAMP) AS tick, commit_no, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks FROM c GROUP BY ALL"""
)
def commit_size_or_interval(spark, sf):
    return fx.plain(commits.commit_by_size_or_interval(fx.acks(spark, sf), 60, "1 day").drop("topic"))


@query(
    f"""WITH {L}, {A}, k AS (SELECT *, COALESCE(SUM(CASE WHEN value > 150 THEN 1 ELSE 0 END) OVER (PARTITION BY member_id ORDER BY ack_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM a),
t AS (SELECT member_id, COUNT(*) FILTER (value > 150) AS made FROM a GROUP BY member_id)
SELECT member_id, CAST(CASE WHEN no < ANY_VALUE(made) THEN no ELSE -1 END AS BIGINT) AS commit_no, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks
FROM k JOIN t USING (member_id) GROUP BY member_id, no, part_id"""
)
def commit_each(spark, sf):
    """Members commit by hand after each record that took longer than 150."""
    calls = fx.acks(spark, sf, (F.col("value") > 150).alias("commit"))
    return fx.plain(commits.commit_each(calls).drop("topic"))


_BATCHED = "b AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY log_offset, part_id) - 1) // {n} AS batch_id FROM l)"


@query(
    f"""WITH {L}, {_BATCHED.format(n=200)} SELECT member_id, batch_id, part_id, MAX(log_offset) + 1 AS commit_offset, COUNT(*) AS records FROM b GROUP BY ALL"""
)
def auto_ack_commits(spark, sf):
    batched = commits.poll_batches(fx.event_log(spark, sf), 200, fx.member())
    return fx.plain(commits.auto_ack_commits(batched).drop("topic"))


@query(f"WITH {L}, {_BATCHED.format(n=200)} SELECT member_id, batch_id, part_id, MAX(log_offset) + 1 AS commit_offset FROM b GROUP BY ALL")
def txn_offsets(spark, sf):
    batched = commits.poll_batches(fx.event_log(spark, sf), 200, fx.member())
    return fx.plain(commits.txn_offsets(batched).drop("topic"))


_G = """g AS (SELECT *, value <= 250 AS acked, MIN(CASE WHEN value > 250 THEN log_offset END) OVER (PARTITION BY part_id) AS gap FROM l),
f AS (SELECT part_id, ANY_VALUE(member_id) AS member_id, MAX(CASE WHEN acked AND (gap IS NULL OR log_offset < gap) THEN log_offset END) + 1 AS commit_offset,
 COUNT(*) FILTER (acked AND log_offset > gap) AS deferred_count FROM g GROUP BY part_id)"""


@query(f"WITH {L}, {_G} SELECT part_id, commit_offset, deferred_count FROM f")
def commit_frontier(spark, sf):
    return fx.plain(frontier.commit_frontier(fx.marked(spark, sf)).drop("topic"))


@query(f"WITH {L}, {_G} SELECT part_id, commit_offset, deferred_count FROM f")
def commit_frontier_joined(spark, sf):
    """The same frontier with acknowledgements as a separate table."""
    marked = frontier.mark_acked(fx.event_log(spark, sf).select(*TP, "offset"), fx.acks(spark, sf))
    return fx.plain(frontier.commit_frontier(marked).drop("topic"))


@query(
    f"""WITH {L}, {_G} SELECT member_id, CAST(SUM(deferred_count) AS BIGINT) AS deferred_total, SUM(deferred_count) >= 100 AS would_pause FROM f GROUP BY member_id"""
)
def deferred_pause(spark, sf):
    return frontier.deferred_pause(frontier.commit_frontier(fx.marked(spark, sf)), 100, fx.member())


@query(f"WITH {L}, {_G} SELECT part_id, commit_offset, deferred_count FROM f WHERE part_id <> 1")
def frontier_revoked(spark, sf):
    revoked = fx.event_log(spark, sf).where(F.col("partition") == 1).select(*TP).distinct()
    return fx.plain(frontier.commit_frontier(fx.marked(spark, sf), revoked).drop("topic"))


@query(
    f"""WITH {L} SELECT member_id, COUNT(*) AS delivered, COUNT(*) FILTER (value <= 250) AS acknowledged, COUNT(*) FILTER (value > 250) AS in_flight FROM l GROUP BY member_id"""
)
def in_flight(spark, sf):
    return frontier.in_flight(fx.marked(spark, sf), fx.member())


_LEDGER = """p AS (SELECT part_id, log_offset, COALESCE(LAG(log_offset) OVER (PARTITION BY part_id ORDER BY log_offset) + 6, -1) AS c FROM l)"""


@query(
    f"""WITH {L}, {_LEDGER} SELECT part_id, log_offset, CASE WHEN log_offset >= c THEN 'sync' WHEN c - log_offset >= 2 THEN 'async' ELSE 'none' END AS kind, log_offset + 6 AS committed FROM p"""
)
def at_most_once_ledger(spark, sf):
    return fx.plain(delivery.at_most_once_ledger(fx.event_log(spark, sf), 5, contiguous=True).drop("topic"))


@query(
    """WITH RECURSIVE l AS (SELECT CAST(user_id % 4 AS INT) AS part_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS o FROM events),
v AS (SELECT part_id, o, LEAD(o) OVER (PARTITION BY part_id ORDER BY o) AS succ FROM l WHERE event_type = 'error'),
n AS (SELECT part_id, o, CASE WHEN succ <= o + 4 THEN succ ELSE (SELECT MIN(b.o) FROM v b WHERE b.part_id = a.part_id AND b.o >= a.o + 6) END AS nxt FROM v a),
h(part_id, o, prev) AS (SELECT part_id, MIN(o), CAST(NULL AS BIGINT) FROM v GROUP BY part_id
 UNION ALL SELECT n.part_id, n.nxt, n.o FROM h JOIN n ON n.part_id = h.part_id AND n.o = h.o WHERE n.nxt IS NOT NULL),
j AS (SELECT v.part_id, v.o, h.o AS hit, h.prev, MAX(h.o) OVER (PARTITION BY v.part_id ORDER BY v.o) AS last_hit FROM v LEFT JOIN h ON v.part_id = h.part_id AND v.o = h.o)
SELECT part_id, o AS log_offset, CASE WHEN hit IS NULL THEN 'none' WHEN prev IS NULL OR o >= prev + 6 THEN 'sync' ELSE 'async' END AS kind, last_hit + 6 AS committed FROM j"""
)
def at_most_once_gaps(spark, sf):
    """A reader that is only delivered error events: offsets have gaps."""
    log = fx.deliveries(spark, sf).where(F.col("kind") == "error")
    ledger = delivery.at_most_once_ledger(log, 5)
    return fx.plain(ledger.drop("topic"))


@query(f"WITH {L} SELECT part_id, MAX(log_offset) + 1 AS rewind_to, MAX(log_offset) + 6 AS committed FROM l GROUP BY part_id")
def commit_ahead_undo(spark, sf):
    ledger = delivery.at_most_once_ledger(fx.event_log(spark, sf), 5, contiguous=True)
    return fx.plain(delivery.commit_ahead_undo(ledger).drop("topic"))


@query(
    f"""WITH {L}, {_BATCHED.format(n=10)}, s AS (SELECT member_id, batch_id, COUNT(*) AS records, MAX(CASE WHEN value > 400 THEN 1 ELSE 0 END) AS bad FROM b GROUP BY ALL),
f AS (SELECT member_id, MIN(batch_id) AS abort FROM s WHERE bad = 1 GROUP BY member_id)
SELECT member_id, batch_id, records, CASE WHEN abort IS NULL OR batch_id < abort THEN 'committed' WHEN batch_id = abort THEN 'aborted' ELSE 'not_started' END AS state FROM s LEFT JOIN f USING (member_id)"""
)
def exactly_once_abort(spark, sf):
    """Batches of ten; a record slower than 400 fails its batch and ends the loop."""
    batched = commits.poll_batches(fx.deliveries(spark, sf), 10, fx.member())
    return delivery.exactly_once_outcome(batched, F.col("value") > 400).drop("last_seq")


@query(f"WITH {L}, {A} SELECT part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset FROM a GROUP BY part_id")
def final_commit(spark, sf):
    return fx.plain(commits.final_commit(fx.acks(spark, sf)).drop("topic"))


@query(
    f"""WITH {L}, {C} SELECT part_id, COUNT(*) FILTER (value <= 250 AND log_offset >= COALESCE(commit_offset, 0)) AS redelivered,
 COUNT(*) FILTER (value > 250 AND log_offset < COALESCE(commit_offset, 0)) AS lost FROM l LEFT JOIN cm USING (part_id) GROUP BY part_id"""
)
def delivery_audit(spark, sf):
    newest = fx.commits(spark, sf).groupBy(*TP).agg(F.max_by("commit_offset", "commit_no").alias("commit_offset"))
    audit = delivery.delivery_audit(fx.event_log(spark, sf), fx.acks(spark, sf), newest)
    return fx.plain(audit.drop("topic"))
