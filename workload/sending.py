"""Sends, results, error policies, chains, transactions."""

from pyspark.sql import functions as F

from logweave.functions.routing import route_integer_key, send_time
from logweave.operators import send, transactions
from logweave.schema import TP
from logweave.session import new_dir
from logweave.sources import isolation
from logweave.sources.catalog import topic_bounds
from logweave.sources.topic_log import TopicLog
from workload import fixtures as fx
from workload import query
from workload.sql import R


def _routed(spark, sf):
    requests = fx.requests(spark, sf)
    return requests.withColumn("partition", route_integer_key(F.col("partition"), F.col("user_id"), 4))


@query(
    f"""WITH {R} SELECT seq AS correlation, part_id,
 CASE WHEN error IS NULL THEN ROW_NUMBER() OVER (PARTITION BY part_id, error IS NULL ORDER BY seq) - 1 END AS log_offset, error AS exception FROM r"""
)
def send_append(spark, sf):
    sent = send.assign_offsets(_routed(spark, sf))
    return fx.plain(sent.select("correlation", "partition", "offset", F.col("error").alias("exception")))


@query(
    f"""WITH {R}, e AS (SELECT CAST(user_id % 4 AS INT) AS part_id, COUNT(*) AS n FROM events GROUP BY 1)
SELECT seq AS correlation, part_id, n + ROW_NUMBER() OVER (PARTITION BY part_id ORDER BY seq) - 1 AS log_offset FROM r JOIN e USING (part_id) WHERE error IS NULL"""
)
def send_append_existing(spark, sf):
    """Appending to the topic that already holds the events."""
    ends = topic_bounds(fx.event_log(spark, sf))
    requests = _routed(spark, sf).withColumn("topic", F.lit("events"))
    sent = send.assign_offsets(requests, ends).where(F.col("offset").isNotNull())
    return fx.plain(sent.select("correlation", "partition", "offset"))


@query(f"WITH {R} SELECT seq, part_id FROM r")
def route_partition(spark, sf):
    return fx.plain(_routed(spark, sf).select("seq", "partition"))


@query(
    """SELECT event_id AS seq, CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-02-01' ELSE ts END AS ts, TIMESTAMP '2024-02-01' AS appended FROM events"""
)
def default_timestamp(spark, sf):
    """Views come without a timestamp; ``appended`` is what a log-append-time topic stores."""
    own = F.when(F.col("sender_id") != "view", F.col("timestamp"))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    requests = fx.requests(spark, sf)
    return fx.plain(
        requests.select("seq", send_time(own, at).alias("timestamp"), send_time(own, at, log_append=True).alias("appended"))
    )


_RESULTS = """SELECT seq AS correlation, CASE WHEN error IS NULL THEN part_id END AS part_id,
 CASE WHEN error IS NULL THEN {offset} END AS log_offset, CASE WHEN error IS NULL THEN ts END AS ts, error AS exception FROM r"""


@query(f"WITH {R} " + _RESULTS.format(offset="ROW_NUMBER() OVER (PARTITION BY part_id, error IS NULL ORDER BY seq) - 1"))
def send_results(spark, sf):
    return fx.plain(send.send_results(send.assign_offsets(_routed(spark, sf))).drop("topic"))


@query(f"WITH {R} " + _RESULTS.format(offset="CAST(-1 AS BIGINT)"))
def send_results_acks0(spark, sf):
    return fx.plain(send.send_results(send.assign_offsets(_routed(spark, sf)), acks="0").drop("topic"))


_CUT = """c AS (SELECT sender_id, MIN(seq) AS cut FROM r WHERE {bad} GROUP BY sender_id),
d AS (SELECT r.* FROM r LEFT JOIN c USING (sender_id) WHERE cut IS NULL OR seq < cut)"""
_STOP = _CUT.format(bad="error IS NOT NULL")
_FATAL = _CUT.format(bad="error = 'AuthenticationException'")


@query(f"WITH {R}, {_STOP} SELECT sender_id, seq AS correlation, part_id, ROW_NUMBER() OVER (PARTITION BY part_id ORDER BY seq) - 1 AS log_offset FROM d")
def send_stop_on_error(spark, sf):
    sent = send.assign_offsets(send.stop_on_error(_routed(spark, sf)))
    return fx.plain(sent.select("sender_id", "correlation", "partition", "offset"))


@query(
    f"""WITH {R}, {_FATAL}, f AS (SELECT sender_id, MIN_BY(error, seq) AS first_error FROM r WHERE error IS NOT NULL GROUP BY sender_id)
SELECT sender_id, COUNT(*) AS results, COUNT(error) AS failed, ANY_VALUE(first_error) AS first_error FROM d LEFT JOIN f USING (sender_id) GROUP BY sender_id"""
)
def send_continue_on_error(spark, sf):
    """Results per sender, and the error each sender reports in the end."""
    requests = _routed(spark, sf)
    results = (
        send.continue_on_error(requests)
        .groupBy("sender_id")
        .agg(F.count(F.lit(1)).alias("results"), F.count("error").alias("failed"))
    )
    return results.join(send.send_status(requests).select("sender_id", "first_error"), "sender_id", "left")


@query(
    f"""WITH {R} SELECT seq AS correlation, user_id, CASE WHEN error IS NULL THEN part_id END AS result_partition,
 CASE WHEN error IS NULL THEN ROW_NUMBER() OVER (PARTITION BY part_id, error IS NULL ORDER BY seq) - 1 END AS result_offset, error AS result_exception FROM r"""
)
def correlate_results(spark, sf):
    requests = _routed(spark, sf)
    results = send.send_results(send.assign_offsets(requests))
    matched = send.correlate(requests, results)
    return matched.select("correlation", "user_id", "result_partition", "result_offset", "result_exception")


@query(f"WITH {R}, {_STOP} SELECT sender_id, seq AS correlation FROM r WHERE seq NOT IN (SELECT seq FROM d)")
def resume_remaining(spark, sf):
    """What is left to send after every sender stopped at its first error."""
    requests = _routed(spark, sf)
    results = send.send_results(send.assign_offsets(send.stop_on_error(requests)))
    return send.remaining(requests, results).select("sender_id", "correlation")


_LINKS = ["click", "view", "purchase"]


@query(
    """WITH r AS (SELECT event_id AS seq, CAST(user_id % 4 AS INT) AS part_id, event_type = 'view' AND value > 300 AS bad,
 CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS link_no FROM events WHERE event_type IN ('click', 'view', 'purchase')),
c AS (SELECT MIN({'l': link_no, 's': seq}) AS cut FROM r WHERE bad),
d AS (SELECT r.* FROM r, c WHERE cut IS NULL OR {'l': link_no, 's': seq} < cut)
SELECT link_no, seq AS correlation, part_id, ROW_NUMBER() OVER (PARTITION BY part_id ORDER BY link_no, seq) - 1 AS log_offset FROM d"""
)
def send_chain(spark, sf):
    """Three sends one after the other; a slow view fails."""
    base = fx.requests(spark, sf).withColumn("partition", fx.user_partition())
    failing = F.when((F.col("sender_id") == "view") & (F.col("slowness") > 300), "TimeoutException")
    links = [
        base.where(F.col("sender_id") == kind).withColumns({"error": failing, "sender_id": F.lit("chained")})
        for kind in _LINKS
    ]
    sent = send.assign_chain_offsets(send.chain(links))
    return fx.plain(sent.select("link_no", "correlation", "partition", "offset"))


@query(
    f"""WITH {R}, {_FATAL} SELECT part_id, COUNT(*) AS entries, MAX(seq) AS last_seq FROM d WHERE error IS NULL GROUP BY part_id"""
)
def fire_and_forget(spark, sf):
    requests = _routed(spark, sf).withColumn("timestamp", F.timestamp_micros(F.col("seq")))
    entries = send.fire_and_forget(requests)
    return fx.plain(
        entries.groupBy("partition").agg(
            F.count(F.lit(1)).alias("entries"), F.unix_micros(F.max("timestamp")).alias("last_seq")
        )
    )


# -- transactions: two senders, transactions of 500 consecutive event ids --------------------

_TX = """q AS (SELECT CAST(user_id % 2 AS INT) AS sender_id, event_id AS seq, event_id // 500 AS txn_no, ts, CAST(user_id % 4 AS INT) AS part_id, value > 400 AS bad FROM events),
cut AS (SELECT sender_id, MIN(seq) AS cut, MIN(txn_no) AS abort_no FROM q WHERE bad GROUP BY sender_id),
st AS (SELECT sender_id, txn_no, COUNT(*) AS requests, MAX(seq) AS last_seq, CASE WHEN ANY_VALUE(abort_no) IS NULL OR txn_no < ANY_VALUE(abort_no) THEN 'committed'
 WHEN txn_no = ANY_VALUE(abort_no) THEN 'aborted' ELSE 'not_started' END AS state FROM q LEFT JOIN cut USING (sender_id) GROUP BY sender_id, txn_no)"""


def _transactional(spark, sf):
    error = F.when(F.col("slowness") > 400, "TimeoutException")
    return fx.requests(spark, sf).withColumns(
        {
            "sender_id": F.pmod("user_id", F.lit(2)).cast("int"),
            "txn_no": F.call_function("div", F.col("seq"), F.lit(500)),
            "partition": fx.user_partition(),
            "error": error,
        }
    )


@query(f"WITH {_TX} SELECT sender_id, txn_no, requests, state FROM st")
def txn_status(spark, sf):
    return transactions.txn_status(_transactional(spark, sf)).drop("last_seq")


@query(
    f"""WITH {_TX}, sent AS (SELECT q.sender_id, txn_no, seq, part_id FROM q LEFT JOIN cut USING (sender_id) WHERE cut IS NULL OR seq < cut),
e AS (SELECT sender_id, txn_no, seq, part_id, FALSE AS is_control FROM sent
 UNION ALL SELECT DISTINCT sender_id, txn_no, last_seq, part_id, TRUE FROM sent JOIN st USING (sender_id, txn_no)),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY part_id ORDER BY seq, is_control) - 1 AS log_offset FROM e)
SELECT part_id, COUNT(*) FILTER (state = 'committed' AND NOT is_control) AS visible, MAX(log_offset) FILTER (state = 'committed' AND NOT is_control) AS last_visible,
 MAX(log_offset) + 1 AS end_offset, COUNT(*) FILTER (is_control) AS markers FROM o JOIN st USING (sender_id, txn_no) GROUP BY part_id"""
)
def send_transactional(spark, sf):
    """What readers see of a transactional send: markers take up offsets, aborted data stays hidden."""
    entries, markers = transactions.send_transactional(_transactional(spark, sf))
    log = TopicLog(spark, new_dir(spark, "transactional"))
    log.append(entries)
    entries = log.read(topics=["dest"])
    ends = entries.groupBy(*TP).agg(
        (F.max("offset") + 1).alias("end_offset"), F.count_if("is_control").alias("markers")
    )
    seen = isolation.read_committed(entries, markers).groupBy(*TP).agg(
        F.count(F.lit(1)).alias("visible"), F.max("offset").alias("last_visible")
    )
    return fx.plain(ends.join(seen, TP, "left").withColumn("visible", F.coalesce("visible", F.lit(0))).drop("topic"))


@query(f"WITH {R} SELECT sender_id, seq, (ROW_NUMBER() OVER (PARTITION BY sender_id ORDER BY seq) - 1) // 100 AS txn_no FROM r")
def txn_count_window(spark, sf):
    return transactions.count_windows(fx.requests(spark, sf), 100).select("sender_id", "seq", "txn_no")


_ANCHORED = """WITH RECURSIVE q AS (SELECT CAST(user_id % 4 AS INT) AS sender_id, event_id AS seq, epoch_us(ts) // 1000 AS ms FROM events),
w(sender_id, txn_no, start_ms, close_ms) AS (
 SELECT f.sender_id, CAST(0 AS BIGINT), f.s, (SELECT MIN(ms) FROM q WHERE q.sender_id = f.sender_id AND q.ms >= f.s + {d}) FROM (SELECT sender_id, MIN(ms) AS s FROM q GROUP BY sender_id) f
 UNION ALL
 SELECT w.sender_id, w.txn_no + 1, w.close_ms, (SELECT MIN(ms) FROM q WHERE q.sender_id = w.sender_id AND q.ms >= w.close_ms + {d}) FROM w WHERE w.close_ms IS NOT NULL)"""
_SIX_HOURS = 6 * 3600 * 1000


@query(
    _ANCHORED.format(d=_SIX_HOURS)
    + """ SELECT q.sender_id, seq, txn_no, start_ms AS window_start, COALESCE(ms = close_ms, FALSE) AS closes FROM q JOIN w ON q.sender_id = w.sender_id
 AND (q.ms > w.start_ms OR (q.ms = w.start_ms AND txn_no = 0)) AND (w.close_ms IS NULL OR q.ms <= w.close_ms)"""
)
def txn_anchored_window(spark, sf):
    """Transactions of at least six hours; event times are distinct to the millisecond here."""
    requests = fx.requests(spark, sf).withColumn("sender_id", fx.user_partition())
    windows = transactions.anchored_windows(requests, _SIX_HOURS)
    return windows.select("sender_id", "seq", "txn_no", "window_start", "closes")
