"""Statistics, trace headers and client counters."""

from pyspark.sql import functions as F

from logweave.operators import stats, tracing
from logweave.operators.commits import poll_batches
from logweave.plans.quantiles import nearest_rank
from workload import fixtures as fx
from workload import query
from workload.sending import _ANCHORED
from workload.sql import L, S, rank_at

_RATES = """1000.0::DOUBLE * records / {e}::DOUBLE AS records_per_sec, 1000.0::DOUBLE * b / {e}::DOUBLE / 1048576.0::DOUBLE AS mb_per_sec, lat / records::DOUBLE AS avg_latency_ms"""
_SUMS = "COUNT(*) AS records, CAST(SUM(bytes) AS BIGINT) AS b, CAST(SUM(latency) AS BIGINT) AS lat, MAX(latency) AS max_latency_ms"
_HOUR = 3600000


@query(
    f"""WITH {S}, w AS (SELECT end_ms - end_ms % {_HOUR} AS window_start_ms, {_SUMS} FROM s GROUP BY 1)
SELECT window_start_ms, records, max_latency_ms, {_RATES.format(e=_HOUR)} FROM w"""
)
def producer_window_stats(spark, sf):
    return stats.window_throughput(fx.sends(spark, sf), _HOUR)


@query(
    _ANCHORED.format(d=_HOUR)
    + f""", {S}, j AS (SELECT s.*, w.txn_no AS window_no, w.start_ms AS window_start_ms, w.close_ms FROM s JOIN w ON s.sender_id = w.sender_id AND w.close_ms IS NOT NULL
 AND (s.end_ms > w.start_ms OR (s.end_ms = w.start_ms AND txn_no = 0)) AND s.end_ms <= w.close_ms),
g AS (SELECT sender_id, window_no, window_start_ms, close_ms - window_start_ms AS elapsed_ms, {_SUMS} FROM j GROUP BY ALL)
SELECT sender_id, window_no, window_start_ms, elapsed_ms, records, max_latency_ms, {_RATES.format(e="elapsed_ms")} FROM g"""
)
def producer_window_stats_anchored(spark, sf):
    return stats.anchored_throughput(fx.sends(spark, sf), _HOUR)


@query(
    f"""WITH {S}, w AS (SELECT {_SUMS}, MAX(end_ms) - MIN(start_ms) AS elapsed_ms FROM s)
SELECT records, max_latency_ms, elapsed_ms, {_RATES.format(e="elapsed_ms")} FROM w"""
)
def producer_totals(spark, sf):
    return stats.totals(fx.sends(spark, sf))


_HISTOGRAM = "c AS (SELECT latency, SUM(n) OVER (ORDER BY latency) AS cum, SUM(n) OVER () AS total FROM (SELECT latency, COUNT(*) AS n FROM {t} GROUP BY 1))"
_PRODUCER = ", ".join(f"{rank_at(str(p))} AS {n}" for n, p in stats.PRODUCER_PERCENTILES.items())
_END_TO_END = ", ".join(f"{rank_at(str(p))} AS {n}" for n, p in stats.LATENCY_PERCENTILES.items())


@query(f"WITH {S}, {_HISTOGRAM.format(t='s')} SELECT {_PRODUCER} FROM c")
def latency_percentiles(spark, sf):
    return stats.latency_percentiles(fx.sends(spark, sf))


@query(
    f"""WITH {S}, k AS (SELECT GREATEST(1, COUNT(*) // LEAST(COUNT(*), 2000)) AS k FROM s)
SELECT seq, latency FROM s, k WHERE seq % k = 0"""
)
def latency_sample(spark, sf):
    """The sampling operator itself: at most 2000 latencies of the run, evenly spaced."""
    sends = fx.sends(spark, sf)
    sample = stats.sample_latencies(sends, sends.count(), 2000)
    return sample.select("seq", (F.col("end_ms") - F.col("start_ms")).alias("latency"))


@query(
    f"""WITH {L}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY log_offset, part_id) - 1 AS rn FROM l),
b AS (SELECT member_id, rn // 1000 AS block_no, COUNT(*) AS block_messages, CAST(SUM(4 + strlen(props)) AS BIGINT) AS bytes, MAX(epoch_us(ts) // 1000) AS time_ms FROM r GROUP BY ALL)
SELECT member_id, block_no, block_messages, time_ms, CAST(SUM(block_messages) OVER w AS BIGINT) AS messages,
 CAST(SUM(bytes) OVER w AS BIGINT) / 1048576.0::DOUBLE AS mb, bytes / 1048576.0::DOUBLE AS block_mb FROM b WINDOW w AS (PARTITION BY member_id ORDER BY block_no)"""
)
def consumer_blocks(spark, sf):
    consumed = poll_batches(fx.event_log(spark, sf), 500, fx.member()).select(
        "member_id", "delivery_seq", stats.payload_bytes().alias("bytes"), F.unix_millis("timestamp").alias("time_ms")
    )
    return stats.consumer_progress(consumed, 1000)


@query(
    """WITH t AS (SELECT COUNT(*) AS messages, SUM(4 + strlen(props)) / 1048576.0::DOUBLE AS total_mb, epoch_us(MAX(ts)) // 1000 - epoch_us(MIN(ts)) // 1000 AS elapsed_ms FROM events)
SELECT messages, total_mb, elapsed_ms, total_mb / (elapsed_ms::DOUBLE / 1000.0::DOUBLE) AS mb_per_sec, messages / (elapsed_ms::DOUBLE / 1000.0::DOUBLE) AS messages_per_sec FROM t"""
)
def consumer_totals(spark, sf):
    return stats.consumer_totals(fx.event_log(spark, sf))


def _sent_and_received(spark, sf):
    """Received at the event time, sent as much earlier as the record was slow."""
    sends = fx.sends(spark, sf)
    sent = sends.select(F.col("seq").alias("id"), F.col("start_ms").alias("sent_ms"), "event_type")
    return sent, sends.select(F.col("seq").alias("id"), F.col("end_ms").alias("received_ms"))


@query(
    f"""WITH {S}, {_HISTOGRAM.format(t='s')}, t AS (SELECT COUNT(*) AS messages, CAST(SUM(latency) AS BIGINT) / COUNT(*)::DOUBLE AS avg_latency_ms FROM s)
SELECT ANY_VALUE(messages) AS messages, ANY_VALUE(avg_latency_ms) AS avg_latency_ms, {_END_TO_END} FROM c, t"""
)
def e2e_latency(spark, sf):
    return stats.latency_summary(*_sent_and_received(spark, sf), "id")


@query(
    f"""WITH {S}, c AS (SELECT event_type, latency, SUM(n) OVER (PARTITION BY event_type ORDER BY latency) AS cum, SUM(n) OVER (PARTITION BY event_type) AS total
 FROM (SELECT event_type, latency, COUNT(*) AS n FROM s GROUP BY ALL)), t AS (SELECT event_type, COUNT(*) AS messages, CAST(SUM(latency) AS BIGINT) / COUNT(*)::DOUBLE AS avg_latency_ms FROM s GROUP BY ALL)
SELECT event_type, ANY_VALUE(messages) AS messages, ANY_VALUE(avg_latency_ms) AS avg_latency_ms, {_END_TO_END} FROM c JOIN t USING (event_type) GROUP BY event_type"""
)
def e2e_latency_by_type(spark, sf):
    return stats.latency_summary(*_sent_and_received(spark, sf), "id", ["event_type"])


@query(
    """SELECT event_id AS id, CAST(1 AS BIGINT) AS sent, CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 2 ELSE 1 END AS BIGINT) AS received,
 CASE event_type WHEN 'error' THEN 'missing' WHEN 'click' THEN 'duplicate' ELSE 'mismatched' END AS status FROM events WHERE event_type IN ('error', 'click', 'view')"""
)
def e2e_integrity(spark, sf):
    """Errors get lost, clicks arrive twice, views arrive changed."""
    sent = fx.events(spark, sf).select(F.col("event_id").alias("id"), "event_type", F.encode("props", "UTF-8").alias("payload"))
    changed = F.when(F.col("event_type") == "view", F.concat("payload", F.encode(F.lit("!"), "UTF-8"))).otherwise(F.col("payload"))
    copies = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "error", 0).otherwise(1)
    received = sent.select("id", changed.alias("payload"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return stats.integrity_check(sent, received.drop("copy"), "id", "payload")


@query(
    f"""WITH {S}, x AS (SELECT event_type, end_ms >= 1705363200000 AS late, start_ms, end_ms, latency FROM s),
t AS (SELECT event_type, late, 1000.0::DOUBLE * COUNT(*) / (MAX(end_ms) - MIN(start_ms))::DOUBLE AS rate, COUNT(*) AS total FROM x GROUP BY ALL),
c AS (SELECT event_type, late, latency, SUM(n) OVER (PARTITION BY event_type, late ORDER BY latency) AS cum FROM (SELECT event_type, late, latency, COUNT(*) AS n FROM x GROUP BY ALL)),
q AS (SELECT event_type, late, ANY_VALUE(rate) AS rate, {rank_at("0.75")} AS p75 FROM c JOIN t USING (event_type, late) GROUP BY ALL),
j AS (SELECT b.event_type, b.rate AS base_rate, b.p75 AS base_latency, n.rate AS new_rate, n.p75 AS new_latency, (b.rate - n.rate) * 100.0::DOUBLE / b.rate AS rate_loss_percent,
 (n.p75 - b.p75) * 100.0::DOUBLE / b.p75 AS latency_gain_percent FROM q b JOIN q n ON b.event_type = n.event_type AND NOT b.late AND n.late)
SELECT *, rate_loss_percent <= 2 AS rate_ok, latency_gain_percent <= 2 OR new_latency < 5 AS latency_ok FROM j"""
)
def compare_runs(spark, sf):
    """The second half of January against the first, per event type: rate and p75 latency."""
    sends = fx.sends(spark, sf).withColumns(
        {"late": F.col("end_ms") >= 1705363200000, "latency_ms": F.col("end_ms") - F.col("start_ms")}
    )
    elapsed = (F.max("end_ms") - F.min("start_ms")).cast("double")
    rates = sends.groupBy("event_type", "late").agg((F.lit(1000.0) * F.count(F.lit(1)) / elapsed).alias("records_per_sec"))
    latency = nearest_rank(sends, "latency_ms", {"p75": 0.75}, ["event_type", "late"])
    runs = rates.join(latency.withColumnRenamed("p75", "latency_ms"), ["event_type", "late"])
    return stats.compare_runs(runs.where(~F.col("late")), runs.where("late"), ["event_type"], 2.0)


@query(
    """WITH m AS (SELECT 'ev-' || event_type AS topic, CAST(user_id % 4 AS INT) AS part_id FROM events)
SELECT topic, part_id, COUNT(*) AS records FROM m GROUP BY ROLLUP (topic, part_id)"""
)
def partition_counts(spark, sf):
    return fx.plain(stats.partition_counts(fx.topic_log(spark, sf).read(pattern="ev-.*")))


@query(
    f"""WITH {L} SELECT part_id, log_offset, 4 AS header_count, 'trace,h,trace,trace' AS header_keys,
 'span-' || part_id || '-' || log_offset AS last_trace FROM l"""
)
def inject_headers(spark, sf):
    """A new trace header goes behind the existing ones and wins the lookup."""
    log = fx.event_log(spark, sf)
    traced = tracing.inject_trace(log, {"trace": F.concat_ws("-", F.lit("span"), "partition", "offset")})
    found = tracing.extract_trace(traced, {"last_trace": "trace"})
    keys = F.concat_ws(",", F.transform("headers", lambda h: h["key"]))
    return fx.plain(found.select("partition", "offset", F.size("headers").alias("header_count"), keys.alias("header_keys"), "last_trace"))


@query(f"WITH {L} SELECT part_id, log_offset, CAST(event_id + 1 AS VARCHAR) AS trace, 'a' AS h, CAST(NULL AS VARCHAR) AS absent FROM l")
def extract_header(spark, sf):
    found = tracing.extract_trace(fx.event_log(spark, sf), {"trace": "trace", "h": "h", "absent": "no-such-key"})
    return fx.plain(found.select("partition", "offset", "trace", "h", "absent"))


_SPANS = """sp AS (SELECT event_id // 5 AS trace_id, event_id AS record_id, 'sender' AS span_type, 'events publish' AS span_name, 'producer-1' AS client_id FROM events
UNION ALL SELECT event_id // 5, event_id, 'receiver', 'events receive', 'consumer-1' FROM events WHERE value <= 250)"""


@query(f"WITH {_SPANS} SELECT trace_id, span_name, span_type, client_id, COUNT(*) AS spans FROM sp GROUP BY ALL")
def trace_report(spark, sf):
    return tracing.trace_report(fx.spans(spark, sf))


@query("SELECT event_id // 5 AS trace_id, COUNT(*) FILTER (value > 250) AS unreceived, CAST(0 AS BIGINT) AS unpublished FROM events GROUP BY 1")
def trace_orphans(spark, sf):
    return tracing.unmatched_spans(fx.spans(spark, sf))


@query(
    f"""WITH {L} SELECT 'consumer-' || member_id AS client_id, COUNT(*) AS records, CAST(SUM(4 + strlen(props)) AS BIGINT) AS bytes, 'blue' AS deployment FROM l GROUP BY 1"""
)
def client_metrics(spark, sf):
    client = F.concat(F.lit("consumer-"), fx.member().cast("string"))
    return tracing.client_metrics(fx.event_log(spark, sf), client, {"deployment": "blue"})
