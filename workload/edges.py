"""The cases at the edges: starts inside transactions, late partitions, several senders, null
groups, copies, streams that close their windows."""

from pyspark.sql import functions as F

from logweave.functions.codec import bytes_to_int, bytes_to_text, decode_json
from logweave.operators import commits, records, send, stats
from logweave.plans.quantiles import nearest_rank
from logweave.schema import LOG, TP
from logweave.sources import isolation, starts
from logweave.sources.catalog import topic_bounds
from logweave.streaming import metrics, runs, stateful
from workload import ORACLES, query
from workload import fixtures as fx
from workload.flows import process_by_partition as bounded_process  # noqa: F401  defines the oracle
from workload.measures import _HOUR, _RATES, _SUMS
from workload.sending import _routed
from workload.sql import A, C, L, R, S, T
from workload.streams import folder, replay, replay_log

#: Offsets before the end of a partition: later than the first record of the open transaction.
TAIL = 20


@query(
    f"""WITH {L}, {T}, s AS (SELECT l.*, state, MAX(log_offset) OVER (PARTITION BY part_id) + 1 - {TAIL} AS start_at FROM l LEFT JOIN ts_state ON event_type <> 'signup' AND event_id // 500 = no),
v AS (SELECT *, MIN(CASE WHEN state = 'open' THEN log_offset END) OVER (PARTITION BY part_id) AS stable FROM s WHERE part_id <> 2)
SELECT part_id, log_offset, ts FROM v WHERE log_offset >= start_at AND (stable IS NULL OR log_offset < stable) AND (state IS NULL OR state <> 'aborted')
UNION ALL SELECT part_id, log_offset, ts FROM s WHERE part_id = 2 AND (state IS NULL OR state <> 'aborted') AND log_offset < (SELECT MIN(log_offset) FROM s WHERE part_id = 2 AND state = 'open')"""
)
def read_committed_from(spark, sf):
    """A start behind the first record of the open transaction, but for one partition read from its
    begin."""
    log = fx.event_log(spark, sf)
    late = topic_bounds(log).select(*TP, F.when(F.col("partition") == 2, 0).otherwise(F.col("end_offset") - TAIL).alias("start_offset"))
    visible = isolation.read(log, fx.txns(spark, sf), "read_committed", late)
    return fx.plain(visible.select("partition", "offset", "timestamp"))


@query(f"WITH {L} SELECT part_id, log_offset FROM l WHERE log_offset >= CASE WHEN part_id IN (1, 3) THEN 7 ELSE 0 END")
def seek_some_partitions(spark, sf):
    """A seek map for two of four partitions; the others stay at their begin."""
    log = fx.event_log(spark, sf)
    some = log.select(*TP).distinct().where("partition in (1, 3)").withColumn("start_offset", F.lit(7).cast("long"))
    return fx.plain(starts.read_from(log, starts.seek(log, some.unionAll(some))).select("partition", "offset"))


@query(f"WITH {L}, {C} SELECT part_id, log_offset, ts FROM l LEFT JOIN cm USING (part_id) WHERE log_offset >= CASE WHEN part_id = 3 THEN 0 ELSE commit_offset END")
def resume_group_late_partition(spark, sf):
    """The map was made before partition 3 existed."""
    known = fx.event_log(spark, sf).where("partition < 3")
    start_map = starts.resume(known, fx.commits(spark, sf), "g")
    out, checkpoint = folder(spark)
    replay_log(spark, sf, lambda log: runs.to_files(starts.read_from(log.read_stream(topics=["events"]), start_map), out, checkpoint))
    return fx.plain(spark.read.schema(LOG).parquet(out).select("partition", "offset", "timestamp"))


def _amounts(log):
    amount = F.get_json_object(bytes_to_text(F.col("value")), "$.k").cast("long")
    return log.select("topic", "partition", "offset", amount.alias("amount"))


@query(f"WITH {L} SELECT part_id, log_offset, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * 2 AS doubled FROM l")
def process_by_partition_stateless(spark, sf):
    doubled = records.process_by_partition(
        _amounts(fx.event_log(spark, sf)),
        step=lambda pdf, _: pdf[["partition", "offset"]].assign(doubled=pdf["amount"] * 2),
        schema="partition int, offset long, doubled long",
        stateless=True,
    )
    return fx.plain(doubled)


@query(ORACLES["process_by_partition"])
def process_by_partition_stream(spark, sf):
    """The running balance of every partition over three micro-batches."""
    out, checkpoint = folder(spark)
    each = stateful.by_partition(
        out,
        step=lambda pdf, opening: pdf[["partition", "offset"]].assign(balance=pdf["amount"].cumsum() + opening),
        schema="partition int, offset long, balance long",
        summary=lambda pdf: int(pdf["amount"].sum()),
        combine=lambda a, b: a + b,
        initial=0,
    )
    replay_log(spark, sf, lambda log: runs.start(_amounts(log.read_stream(topics=["events"])), each, checkpoint))
    return fx.plain(spark.read.parquet(f"{out}/rows").drop("batch_id"))


@query(
    """SELECT event_id AS correlation, ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY event_id // 2, event_id % 2) - 1 AS log_offset FROM events"""
)
def send_two_senders(spark, sf):
    """Two senders that count for themselves send into the same partitions."""
    requests = fx.events(spark, sf).select(
        F.pmod("event_id", F.lit(2)).alias("sender_id"),
        F.floor(F.col("event_id") / 2).alias("seq"),
        F.lit("dest").alias("topic"),
        fx.user_partition().alias("partition"),
        F.col("event_id").alias("correlation"),
        F.lit(None).cast("string").alias("error"),
    )
    return fx.plain(send.assign_offsets(requests.repartition(7), senders=2).select("correlation", "offset"))


@query(
    f"""WITH {R}, f AS (SELECT sender_id, MIN(seq) FILTER (error = 'AuthenticationException') AS cut FROM r GROUP BY sender_id)
SELECT sender_id, COUNT(*) AS requests, COUNT(error) AS failed, MIN_BY(error, seq) FILTER (error IS NOT NULL) AS first_error FROM r JOIN f USING (sender_id) WHERE cut IS NULL OR seq <= cut GROUP BY sender_id"""
)
def send_status_attempts(spark, sf):
    """Requests behind a fatal error were never attempted."""
    return send.send_status(_routed(spark, sf))


@query(
    f"""WITH {S}, g AS (SELECT CASE WHEN event_type <> 'click' THEN event_type END AS kind, latency FROM s), o AS (SELECT kind, latency, ROW_NUMBER() OVER (PARTITION BY kind ORDER BY latency) - 1 AS place, COUNT(*) OVER (PARTITION BY kind) AS n FROM g)
SELECT kind, MAX(latency) FILTER (place = floor(0.5::DOUBLE * n)) AS p50, MAX(latency) FILTER (place = floor(0.99::DOUBLE * n)) AS p99 FROM o GROUP BY kind"""
)
def e2e_latency_null_group(spark, sf):
    sends = fx.sends(spark, sf).select(F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"), (F.col("end_ms") - F.col("start_ms")).alias("latency"))
    return nearest_rank(sends, "latency", {"p50": 0.5, "p99": 0.99}, ["kind"])


@query(
    """SELECT event_id AS id, CAST(2 AS BIGINT) AS sent, CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 3 ELSE 2 END AS BIGINT) AS received,
 event_type = 'error' AS missing, FALSE AS unexpected, event_type = 'click' AS duplicate, event_type IN ('click', 'view') AS mismatched FROM events"""
)
def e2e_integrity_copies(spark, sf):
    """Everything is sent twice; errors arrive once, clicks three times and changed, views changed."""
    sent = fx.events(spark, sf).select(F.col("event_id").alias("id"), "event_type", F.encode("props", "UTF-8").alias("payload"))
    changed = F.when(F.col("event_type").isin("view", "click"), F.concat("payload", F.encode(F.lit("!"), "UTF-8"))).otherwise(F.col("payload"))
    copies = F.when(F.col("event_type") == "click", 3).when(F.col("event_type") == "error", 1).otherwise(2)
    received = sent.select("id", changed.alias("payload"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")
    return stats.integrity_flags(sent.unionAll(sent), received, "id", "payload")


@query(f"WITH {L} SELECT part_id, log_offset, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM l")
def decode_by_schema(spark, sf):
    """Values decoded by a JSON schema."""
    log = decode_json(fx.event_log(spark, sf), "value", "k long")
    return fx.plain(log.where("decoded_ok").select("partition", "offset", "k"))


@query(
    f"""WITH {L} SELECT part_id, log_offset, CASE log_offset % 4 WHEN 2 THEN FALSE ELSE TRUE END AS decoded_ok,
 CASE WHEN log_offset % 4 = 3 THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k FROM l"""
)
def decode_null_fields(spark, sf):
    """Of four values one has a null field, one has no field and one is cut off; only that one cannot be read."""
    turn = F.pmod("offset", F.lit(4))
    text = F.when(turn == 0, '{"k":null}').when(turn == 1, "{}").when(turn == 2, '{"k":').otherwise(bytes_to_text(F.col("value")))
    log = fx.event_log(spark, sf).select("partition", "offset", F.encode(text, "UTF-8").alias("value"))
    return fx.plain(decode_json(log, "value", "k long").drop("value"))


@query(
    f"""WITH {L}, {A}, w AS (SELECT member_id, time_bucket(INTERVAL 6 HOURS, ts) AS tick, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks FROM a GROUP BY ALL)
SELECT * FROM w WHERE tick + INTERVAL 6 HOURS <= date_trunc('millisecond', (SELECT MAX(ts) FROM a))"""
)
def commit_by_interval_append_stream(spark, sf):
    """Every interval once, when it is over."""
    acks = fx.acks(spark, sf)
    out, checkpoint = folder(spark)

    def run(path):
        stream = spark.readStream.schema(acks.schema).parquet(path).withWatermark("ack_time", "0 seconds")
        return runs.start(commits.commit_by_interval(stream, "6 hours"), runs.batches_to(out), checkpoint)

    replay(acks, "ack_time", run)
    return fx.plain(runs.read_batches(spark, out).drop("batch_id", "topic"))


@query(
    f"""WITH {S}, w AS (SELECT end_ms - end_ms % {_HOUR} AS window_start_ms, {_SUMS} FROM s GROUP BY 1)
SELECT window_start_ms, records, max_latency_ms, {_RATES.format(e=_HOUR)} FROM w WHERE window_start_ms + {_HOUR} <= (SELECT MAX(end_ms) FROM s)"""
)
def producer_window_stats_append_stream(spark, sf):
    """Every window once, when it is over."""
    sends = fx.sends(spark, sf).withColumn("at", F.timestamp_millis("end_ms"))
    out, checkpoint = folder(spark)

    def run(path):
        stream = spark.readStream.schema(sends.schema).parquet(path).withWatermark("at", "0 seconds")
        return runs.start(stats.window_throughput(stream, _HOUR, time="at"), runs.batches_to(out), checkpoint)

    replay(sends, "at", run)
    return runs.read_batches(spark, out).drop("batch_id")


@query(f"WITH {L} SELECT 'consumer-1' AS client_id, COUNT(*) AS records, CAST(SUM(4 + strlen(props)) AS BIGINT) AS bytes, 'blue' AS deployment FROM l")
def client_metrics_stream(spark, sf):
    """Counters of all micro-batches, with two progress reports retained."""
    out, checkpoint = folder(spark)
    retained = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(retained)
    spark.conf.set(retained, "2")
    try:
        replay_log(spark, sf, lambda log: runs.start(log.read_stream(topics=["events"], max_files=1), metrics.count_batches(out, "consumer-1"), checkpoint))
    finally:
        spark.conf.set(retained, before)
    table = metrics.counted(spark, out, {"deployment": "blue"})
    return table.groupBy("client_id", "deployment").agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))


@query(
    f"""WITH {R} SELECT seq AS correlation, part_id,
 CASE WHEN error IS NULL THEN ROW_NUMBER() OVER (PARTITION BY part_id, error IS NULL ORDER BY seq) - 1 END AS log_offset, error AS exception FROM r"""
)
def send_stream(spark, sf):
    """Requests sent micro-batch by micro-batch; offsets go on where the last one ended."""
    requests = _routed(spark, sf)
    out, checkpoint = folder(spark)
    timed = _timed(requests)
    replay(timed, "seq_time", lambda path: runs.start(spark.readStream.schema(timed.schema).parquet(path), stateful.send(out), checkpoint))
    results = runs.read_batches(spark, f"{out}/results")
    asked = requests.select("correlation", F.col("partition").alias("asked"))
    return fx.plain(results.join(asked, "correlation").select("correlation", F.col("asked").alias("partition"), "offset", "exception"))


def _timed(requests):
    """Requests arrive in the order of their numbers."""
    return requests.withColumn("seq_time", F.timestamp_seconds("seq"))


@query(f"WITH {L} SELECT 3 - part_id AS part_id, log_offset, CAST(user_id AS INT) AS user_id FROM l")
def transfer_stream(spark, sf):
    """Records of one topic copied to another, partitions in reverse, as a stream."""
    out, checkpoint = folder(spark)

    def copies(log):
        return log.read_stream(topics=["events"]).select(
            F.col("offset").alias("seq"), F.lit("copy").alias("topic"), (3 - F.col("partition")).alias("partition"), "timestamp",
            "key", "value", "headers", F.struct(*TP, "offset").alias("correlation"), F.lit(None).cast("string").alias("error"),
        )

    replay_log(spark, sf, lambda log: runs.start(copies(log), stateful.send(out), checkpoint))
    sent = runs.read_batches(spark, f"{out}/entries")
    return fx.plain(sent.select("partition", "offset", bytes_to_int(F.col("key")).alias("user_id")))
