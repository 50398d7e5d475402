"""Sources, start positions, catalogue and isolation."""

from pyspark.sql import functions as F

from logweave.functions.codec import bytes_to_int, bytes_to_text
from logweave.operators.commits import poll_batches as polled
from logweave.operators.records import record_metadata as metadata
from logweave.operators.send import send_results, source_ledger
from logweave.operators.send import assign_offsets, continue_on_error
from logweave.schema import TP
from logweave.sources import catalog, isolation, starts
from workload import fixtures as fx
from workload import query
from workload.sql import C, L, M, T

POINT = ["topic", "partition", "offset"]


@query(f"WITH {L} SELECT part_id, log_offset, ts, CAST(user_id AS INT) AS user_id, props FROM l")
def scan_topic(spark, sf):
    log = fx.topic_log(spark, sf).read(topics=["events"])
    return fx.plain(
        log.select("partition", "offset", "timestamp", bytes_to_int(F.col("key")).alias("user_id"), bytes_to_text(F.col("value")).alias("props"))
    )


@query(f"WITH {M} SELECT topic, part_id, log_offset, ts FROM m WHERE regexp_full_match(topic, 'ev-(click|view)')")
def scan_pattern(spark, sf):
    return fx.plain(fx.topic_log(spark, sf).read(pattern="ev-(click|view)").select(*POINT, "timestamp"))


@query(
    f"""WITH {L}, {M} SELECT topic, part_id, log_offset FROM m WHERE topic = 'ev-error' AND part_id IN (0, 3)
UNION ALL SELECT 'events' AS topic, part_id, log_offset FROM l WHERE part_id = 1"""
)
def scan_assignment(spark, sf):
    wanted = [("events", 1), ("ev-error", 0), ("ev-error", 3)]
    return fx.plain(fx.topic_log(spark, sf).read(assignment=wanted).select(*POINT))


def _counted(log, start_map):
    """A start map and how many entries a reader gets from it."""
    read = starts.read_from(log, start_map).groupBy(*TP).agg(F.count(F.lit(1)).alias("records"))
    return fx.plain(
        start_map.join(read, TP, "left").select("partition", "start_offset", F.coalesce("records", F.lit(0)).alias("records"))
    )


@query(
    f"""WITH {L}, {C}, e AS (SELECT part_id, COUNT(*) AS n FROM l GROUP BY part_id)
SELECT part_id, COALESCE(commit_offset, n) AS start_offset, n - COALESCE(commit_offset, n) AS records FROM e LEFT JOIN cm USING (part_id)"""
)
def scan_reset_latest(spark, sf):
    log = fx.event_log(spark, sf)
    return _counted(log, starts.resume(log, fx.commits(spark, sf), "g", "latest", fx.event_bounds(spark, sf)))


@query(
    f"""WITH {L}, {C} SELECT part_id, log_offset, ts FROM l LEFT JOIN cm USING (part_id) WHERE log_offset >= COALESCE(commit_offset, 0)"""
)
def resume_group(spark, sf):
    log = fx.event_log(spark, sf)
    return fx.plain(
        starts.read_from(log, starts.resume(log, fx.commits(spark, sf), "g")).select("partition", "offset", "timestamp")
    )


@query(f"WITH {L} SELECT part_id, log_offset FROM l WHERE log_offset >= 1")
def seek_offset(spark, sf):
    log = fx.event_log(spark, sf)
    return fx.plain(starts.read_from(log, starts.seek(log, 1, fx.event_bounds(spark, sf))).select("partition", "offset"))


@query(f"WITH {L} SELECT part_id, MIN(log_offset) AS start_offset, COUNT(*) AS records FROM l GROUP BY part_id")
def seek_begin(spark, sf):
    log = fx.event_log(spark, sf)
    return _counted(log, starts.seek_to_beginning(log))


@query(f"WITH {L} SELECT part_id, MAX(log_offset) + 1 AS start_offset, CAST(0 AS BIGINT) AS records FROM l GROUP BY part_id")
def seek_end(spark, sf):
    log = fx.event_log(spark, sf)
    return _counted(log, starts.seek_to_end(log, fx.event_bounds(spark, sf)))


@query(
    f"""WITH {L}, t AS (SELECT part_id, COALESCE(MIN(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN log_offset END), MAX(log_offset) + 1) AS s FROM l GROUP BY part_id)
SELECT part_id, log_offset, ts FROM l JOIN t USING (part_id) WHERE log_offset >= s"""
)
def seek_timestamp(spark, sf):
    log = fx.event_log(spark, sf)
    found = starts.seek_to_timestamp(log, "2024-01-15 00:00:00")
    return fx.plain(starts.read_from(log, found).select("partition", "offset", "timestamp"))


@query(
    f"""WITH {L}, e AS (SELECT part_id, COUNT(*) AS n FROM l GROUP BY part_id)
SELECT part_id, log_offset FROM l JOIN e USING (part_id) WHERE log_offset >= n - n // 10"""
)
def start_resolver(spark, sf):
    """The user function starts at the last tenth of every partition."""
    log = fx.event_log(spark, sf)

    def last_tenth(assigned):
        size = F.col("end_offset") - F.col("begin_offset")
        return assigned.withColumn("start_offset", F.col("end_offset") - F.call_function("div", size, F.lit(10)))

    return fx.plain(starts.read_from(log, starts.resolve(log, last_tenth, fx.event_bounds(spark, sf))).select("partition", "offset"))


@query(
    f"""WITH {L}, {M} SELECT DISTINCT topic, part_id FROM m UNION SELECT DISTINCT 'events' AS topic, part_id FROM l
UNION SELECT DISTINCT 'people' AS topic, CAST(c_custkey % 4 AS INT) AS part_id FROM customer"""
)
def list_partitions(spark, sf):
    return fx.plain(catalog.list_partitions(fx.topic_log(spark, sf).all()))


@query(
    f"""WITH {L} SELECT part_id, MIN(log_offset) AS begin_offset, MAX(log_offset) + 1 AS end_offset, COUNT(*) AS entries FROM l GROUP BY part_id"""
)
def topic_bounds(spark, sf):
    return fx.plain(fx.event_bounds(spark, sf).drop("topic"))


@query(
    f"""WITH {L} SELECT part_id, COALESCE(MIN(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN log_offset END), MAX(log_offset) + 1) AS start_offset FROM l GROUP BY part_id"""
)
def offsets_for_time(spark, sf):
    return fx.plain(catalog.offsets_for_time(fx.event_log(spark, sf), "2024-01-15 00:00:00").drop("topic"))


@query(
    f"""WITH {M}, t AS (SELECT topic, part_id, MAX(ts) AS target FROM m WHERE value <= 100 GROUP BY ALL)
SELECT topic, part_id, MIN(CASE WHEN ts >= target THEN log_offset END) AS found_offset FROM m JOIN t USING (topic, part_id) GROUP BY ALL"""
)
def offsets_for_times(spark, sf):
    """The target of a partition is the time of its last event that was not slow."""
    log = fx.topic_log(spark, sf)
    targets = (
        fx.events(spark, sf)
        .where(F.col("value") <= 100)
        .groupBy(F.concat(F.lit("ev-"), "event_type").alias("topic"), fx.user_partition().alias("partition"))
        .agg(F.max("ts").alias("target"))
    )
    return fx.plain(log.offsets_for_times(targets))


@query(
    f"""WITH {L}, {C}, e AS (SELECT part_id, MIN(log_offset) AS begin_offset, COUNT(*) AS end_offset FROM l GROUP BY part_id)
SELECT part_id, begin_offset, end_offset, commit_offset, COALESCE(commit_offset, begin_offset) AS position,
 end_offset - COALESCE(commit_offset, begin_offset) AS lag FROM e LEFT JOIN cm USING (part_id)"""
)
def consumer_lag(spark, sf):
    lag = catalog.consumer_lag(None, fx.commits(spark, sf), "g", bounds=fx.event_bounds(spark, sf))
    return fx.plain(lag.drop("topic"))


@query(
    f"""WITH {L}, {T}, s AS (SELECT l.*, state FROM l LEFT JOIN ts_state ON event_type <> 'signup' AND event_id // 500 = no),
v AS (SELECT *, MIN(CASE WHEN state = 'open' THEN log_offset END) OVER (PARTITION BY part_id) AS stable FROM s)
SELECT part_id, log_offset, ts FROM v WHERE (stable IS NULL OR log_offset < stable) AND (state IS NULL OR state <> 'aborted')"""
)
def read_committed(spark, sf):
    visible = fx.topic_log(spark, sf).read_committed(fx.txns(spark, sf), topics=["events"])
    return fx.plain(visible.select("partition", "offset", "timestamp"))


@query(f"WITH {L} SELECT part_id, COUNT(*) AS visible, MAX(log_offset) AS last_visible FROM l GROUP BY part_id")
def read_uncommitted(spark, sf):
    log = isolation.read(fx.event_log(spark, sf))
    return fx.plain(log.groupBy("partition").agg(F.count(F.lit(1)).alias("visible"), F.max("offset").alias("last_visible")))


@query(
    f"""WITH {L} SELECT member_id, part_id, log_offset, (ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY log_offset, part_id) - 1) // 500 AS batch_id FROM l"""
)
def poll_batches(spark, sf):
    batched = polled(fx.event_log(spark, sf), 500, fx.member())
    return fx.plain(batched.select("member_id", "partition", "offset", "batch_id"))


@query(
    f"""WITH {L} SELECT 'events' AS topic, part_id, log_offset, ts, 0 AS timestamp_type, CAST(-1 AS BIGINT) AS checksum,
 4 AS key_size, CAST(strlen(props) AS INT) AS value_size, 3 AS header_count FROM l"""
)
def record_metadata(spark, sf):
    found = metadata(fx.event_log(spark, sf)).withColumnRenamed("timestampType", "timestamp_type")
    return fx.plain(found)


@query("SELECT c_custkey AS id FROM customer WHERE c_acctbal >= 0")
def source_commit(spark, sf):
    """The customer table as the source: ids count as done once their send succeeded."""
    requests = fx.people(spark, sf).select(
        F.lit("source").alias("sender_id"),
        F.col("id").cast("long").alias("seq"),
        F.lit("people").alias("topic"),
        F.pmod("id", F.lit(4)).cast("int").alias("partition"),
        F.timestamp_seconds(F.lit(0)).alias("timestamp"),
        F.col("id").cast("long").alias("correlation"),
        F.when(F.col("balance") < 0, "InvalidTopicException").alias("error"),
    )
    return source_ledger(send_results(assign_offsets(continue_on_error(requests)))).withColumnRenamed("correlation", "id")
