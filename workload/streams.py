"""Streaming forms. The input arrives in three portions by time; after each one the query is
started again from its checkpoint, handles what is new, and stops."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.codec import bytes_to_int
from logweave.operators import commits, records, stats
from logweave.schema import LOG, TP
from logweave.session import new_dir
from logweave.sources import starts
from logweave.sources.offset_stream import read_by_offsets
from logweave.sources.topic_log import TopicLog
from logweave.streaming import runs, slices, stateful
from logweave.streaming.transactional import TransactionAborted, TxnSink, exactly_once
from workload import ORACLES, query, scans  # noqa: F401  scans defines two of the oracles
from workload import fixtures as fx
from workload.flows import PEOPLE
from workload.measures import _HOUR, _RATES, _SUMS
from workload.sending import _ANCHORED, _SIX_HOURS
from workload.sql import A, L, S

PORTIONS = 3


def replay(rows: DataFrame, time: str, run: Callable[[str], object], partition_by=()) -> None:
    """Bring ``rows`` into a fresh folder portion by portion and ``run(folder)`` after each. The
    portions are written in one job and their files moved when it is their turn."""
    spark = rows.sparkSession
    path, waiting = new_dir(spark, "arrivals"), new_dir(spark, "portions")
    micros = F.unix_micros(time)
    low, high = rows.agg(F.min(micros), F.max(micros)).first()
    later = [(micros >= low + (high - low + 1) * k // PORTIONS).cast("int") for k in range(1, PORTIONS)]
    rows.withColumn("portion", sum(later, F.lit(0))).write.partitionBy("portion", *partition_by).parquet(waiting)
    for i in range(PORTIONS):
        arrive(spark, f"{waiting}/portion={i}", path)
        query = run(path)
        if query is not None:
            query.awaitTermination()


def arrive(spark, source: str, target: str) -> None:
    """Move the data files below ``source`` to the same places below ``target``; one writer's files
    in several portions have equal names, so they get the number of theirs in front."""
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = new_path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(new_path(target))
    if not files.exists(new_path(source)):
        return
    base = files.makeQualified(new_path(source)).toString()
    found = files.listFiles(new_path(source), True)
    while found.hasNext():
        file = found.next().getPath()
        folder_of = new_path(target + file.getParent().toString()[len(base) :])
        files.mkdirs(folder_of)
        if not files.rename(file, new_path(folder_of, f"{source.rsplit('=', 1)[1]}-{file.getName()}")):
            raise OSError(f"cannot move {file}")


def replay_log(spark, sf, run: Callable[[TopicLog], object]) -> None:
    log = fx.event_log(spark, sf)
    replay(log, "timestamp", lambda path: run(TopicLog(spark, path)), TP)


def folder(spark) -> tuple[str, str]:
    base = new_dir(spark, "stream")
    return f"{base}/out", f"{base}/checkpoint"


@query(f"WITH {L} SELECT part_id, log_offset, ts, CAST(user_id AS INT) AS user_id FROM l")
def receive_stream(spark, sf):
    out, checkpoint = folder(spark)
    replay_log(spark, sf, lambda log: runs.to_files(log.read_stream(topics=["events"]), out, checkpoint))
    received = spark.read.schema(LOG).parquet(out)
    return fx.plain(received.select("partition", "offset", "timestamp", bytes_to_int(F.col("key")).alias("user_id")))


@query(f"WITH {L} SELECT part_id, log_offset FROM l")
def receive_batches(spark, sf):
    out, checkpoint = folder(spark)
    replay_log(spark, sf, lambda log: runs.start(log.read_stream(pattern="event.*"), runs.batches_to(out), checkpoint))
    return fx.plain(records.flatten(runs.read_batches(spark, out)).select("partition", "offset"))


@query(
    f"""WITH {L} SELECT part_id, COUNT(*) AS records, MIN(log_offset) AS first_offset, MAX(log_offset) AS last_offset, COUNT(DISTINCT log_offset) AS distinct_offsets,
 SUM(user_id)::BIGINT AS users, MAX(ts) AS ts, TRUE AS bounded FROM l GROUP BY part_id"""
)
def receive_by_offsets_stream(spark, sf):
    """Batches of at most a ninth of the records, cut at offsets, whatever files there are."""
    out, checkpoint = folder(spark)
    bound = fx.event_log(spark, sf).count() // 9 + 1

    def run(log):
        log.describe()
        stream = read_by_offsets(spark, log.path, topics=["events"], max_records=bound, position=f"{checkpoint}-position")
        runs.drain(stream, runs.batches_to(out), checkpoint)

    replay_log(spark, sf, run)
    received = runs.read_batches(spark, out)
    largest = received.groupBy("batch_id").count().agg(F.coalesce(F.max("count") <= bound, F.lit(True)).alias("bounded"))
    by_partition = received.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.countDistinct("offset").alias("distinct_offsets"),
        F.sum(bytes_to_int(F.col("key")).cast("int").cast("long")).alias("users"),
        F.max("timestamp").alias("timestamp"),
    )
    return fx.plain(by_partition.withColumn("bounded", F.lit(largest.first()[0])))


@query(f"WITH {L} SELECT part_id, MAX(log_offset) + 1 AS commit_offset FROM l GROUP BY part_id")
def auto_ack_stream(spark, sf):
    out, checkpoint = folder(spark)
    replay_log(spark, sf, lambda log: runs.start(log.read_stream(topics=["events"]), runs.commit_batches(out), checkpoint))
    return fx.plain(runs.newest(spark.read.parquet(out), TP).drop("topic"))


def _updates(stream, out, checkpoint):
    return runs.start(stream, runs.batches_to(out), checkpoint, mode="update")


@query(
    f"""WITH {L}, {A} SELECT member_id, time_bucket(INTERVAL 6 HOURS, ts) AS tick, part_id, MAX_BY(log_offset, ack_seq) + 1 AS commit_offset, COUNT(*) AS acks FROM a GROUP BY ALL"""
)
def commit_by_interval_stream(spark, sf):
    acks = fx.acks(spark, sf)
    out, checkpoint = folder(spark)

    def run(path):
        stream = spark.readStream.schema(acks.schema).parquet(path).withWatermark("ack_time", "1 day")
        return _updates(commits.commit_by_interval(stream, "6 hours"), out, checkpoint)

    replay(acks, "ack_time", run)
    return fx.plain(runs.newest(spark.read.parquet(out), ["member_id", "tick", *TP]).drop("topic"))


@query(
    f"""WITH {L}, c AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY event_id) - 1) // 500 AS commit_no FROM l WHERE value <= 250)
SELECT member_id, commit_no, part_id, MAX_BY(log_offset, event_id) + 1 AS commit_offset, COUNT(*) AS acks FROM c GROUP BY ALL"""
)
def commit_by_size_stream(spark, sf):
    """Records acknowledged in the order they were sent."""
    acks = (
        fx.deliveries(spark, sf)
        .where(F.col("value") <= fx.ACK_LIMIT)
        .select(fx.member().alias("member_id"), *TP, "offset", F.col("id").alias("ack_seq"), F.col("timestamp").alias("ack_time"))
    )
    out, checkpoint = folder(spark)

    def run(path):
        stream = spark.readStream.schema(acks.schema).parquet(path)
        return runs.start(stream, stateful.commits_by_size(out, 500), checkpoint)

    replay(acks, "ack_time", run)
    return fx.plain(stateful.whole_cycles(spark.read.parquet(f"{out}/cycles")).drop("topic"))


def _deliveries_and_acks(spark, sf):
    """An acknowledgement follows its delivery after as many hours as the record was slow."""
    rows = fx.deliveries(spark, sf)
    delivered = rows.select(F.lit("delivered").alias("kind"), *TP, "offset", F.col("timestamp").alias("at"))
    later = F.timestamp_micros(F.unix_micros("timestamp") + (F.col("value") * 3600000000).cast("long"))
    acked = rows.where(F.col("value") <= fx.ACK_LIMIT).select(F.lit("acked").alias("kind"), *TP, "offset", later.alias("at"))
    return delivered.unionByName(acked)


@query(
    f"""WITH {L}, g AS (SELECT *, value <= 250 AS acked, MIN(CASE WHEN value > 250 THEN log_offset END) OVER (PARTITION BY part_id) AS gap FROM l)
SELECT part_id, MAX(CASE WHEN acked AND (gap IS NULL OR log_offset < gap) THEN log_offset END) + 1 AS commit_offset, COUNT(*) FILTER (acked AND log_offset > gap) AS deferred_count FROM g GROUP BY part_id"""
)
def commit_frontier_stream(spark, sf):
    happened = _deliveries_and_acks(spark, sf)
    out, checkpoint = folder(spark)

    def run(path):
        return runs.start(spark.readStream.schema(happened.schema).parquet(path), stateful.frontier(out), checkpoint)

    replay(happened, "at", run)
    return fx.plain(stateful.latest_frontier(spark.read.parquet(f"{out}/commits")).drop("topic"))


@query(ORACLES["commit_frontier_stream"])
def commit_frontier_keyed_stream(spark, sf):
    """The same commits with state per slice of a partition."""
    happened = _deliveries_and_acks(spark, sf)
    out, checkpoint = folder(spark)

    def run(path):
        changes = slices.slice_changes(spark.readStream.schema(happened.schema).parquet(path))
        return runs.start(changes, slices.keyed_frontier(out), checkpoint, "update")

    replay(happened, "at", run)
    return fx.plain(stateful.latest_frontier(spark.read.parquet(f"{out}/commits")).drop("topic"))


@query(
    f"""WITH {L} SELECT part_id, time_bucket(INTERVAL 6 HOURS, ts) AS period_start, MAX(log_offset) AS log_offset, MAX_BY(ts, log_offset) AS ts FROM l GROUP BY 1, 2"""
)
def sample_latest_stream(spark, sf):
    out, checkpoint = folder(spark)

    def run(log):
        stream = log.read_stream(topics=["events"]).select(*TP, "offset", "timestamp").withWatermark("timestamp", "1 day")
        return _updates(records.sample_latest(stream, "6 hours"), out, checkpoint)

    replay_log(spark, sf, run)
    return fx.plain(runs.newest(spark.read.parquet(out), [*TP, "period_start"]).drop("topic"))


@query(
    f"""WITH {S}, w AS (SELECT end_ms - end_ms % {_HOUR} AS window_start_ms, {_SUMS} FROM s GROUP BY 1)
SELECT window_start_ms, records, max_latency_ms, {_RATES.format(e=_HOUR)} FROM w"""
)
def producer_window_stats_stream(spark, sf):
    sends = fx.sends(spark, sf).withColumn("at", F.timestamp_millis("end_ms"))
    out, checkpoint = folder(spark)

    def run(path):
        stream = spark.readStream.schema(sends.schema).parquet(path)
        return _updates(stats.window_throughput(stream, _HOUR), out, checkpoint)

    replay(sends, "at", run)
    return runs.newest(spark.read.parquet(out), ["window_start_ms"])


@query(
    _ANCHORED.format(d=_SIX_HOURS)
    + """ SELECT q.sender_id, q.ms, txn_no, start_ms AS window_start, COALESCE(ms = close_ms, FALSE) AS closes FROM q JOIN w ON q.sender_id = w.sender_id
 AND (q.ms > w.start_ms OR (q.ms = w.start_ms AND txn_no = 0)) AND (w.close_ms IS NULL OR q.ms <= w.close_ms)"""
)
def txn_anchored_stream(spark, sf):
    out, checkpoint = folder(spark)

    def run(log):
        requests = log.read_stream(topics=["events"]).select(
            F.col("partition").alias("sender_id"), F.col("offset").alias("seq"), "timestamp"
        )
        return runs.start(requests, stateful.anchored(out, _SIX_HOURS), checkpoint)

    replay_log(spark, sf, run)
    done = spark.read.parquet(f"{out}/windows")
    return done.select("sender_id", F.unix_millis("timestamp").alias("ms"), "txn_no", "window_start", "closes")


@query(ORACLES["read_committed"])
def read_committed_stream(spark, sf):
    """The marker of a transaction is known once the stream has passed its last record."""
    out, checkpoint = folder(spark)
    newest = []

    def markers():
        spans = fx.event_log(spark, sf).where(F.col("txn_id").isNotNull()).groupBy("txn_id").agg(F.max("timestamp").alias("last"))
        known = spans.where(F.col("last") < newest[-1]).select("txn_id")
        return fx.txns(spark, sf).join(known, "txn_id", "left_semi")

    def each(batch, batch_id):
        newest.append(batch.agg(F.max("timestamp")).first()[0])
        stateful.read_committed(out, markers)(batch, batch_id)

    replay_log(spark, sf, lambda log: runs.start(log.read_stream(topics=["events"]), each, checkpoint))
    return fx.plain(spark.read.parquet(f"{out}/visible").select("partition", "offset", "timestamp"))


@query(ORACLES["resume_group"])
def resume_group_stream(spark, sf):
    """A new stream that starts at the committed offsets of a group."""
    start_map = starts.resume(fx.event_log(spark, sf), fx.commits(spark, sf), "g")
    out, checkpoint = folder(spark)
    replay_log(
        spark, sf, lambda log: runs.to_files(starts.read_from(log.read_stream(topics=["events"]), start_map), out, checkpoint)
    )
    return fx.plain(spark.read.schema(LOG).parquet(out).select("partition", "offset", "timestamp"))


def _copy(batch):
    """Requests that copy records to another topic, partitions in reverse."""
    return batch.select(
        F.col("offset").alias("seq"), F.lit("copy").alias("topic"), (3 - F.col("partition")).alias("partition"),
        "timestamp", "key", "value", "headers", F.lit(None).cast("string").alias("error"),
    )


def _copied(sink):
    """Visible records, end of the log and committed source offset per partition."""
    seen = sink.read().groupBy("partition").agg(
        F.count(F.lit(1)).alias("visible"), F.countDistinct("offset").alias("distinct_offsets")
    )
    ends = sink.entries().groupBy("partition").agg(F.max("offset").alias("end_offset"))
    committed = sink.committed().select((3 - F.col("partition")).alias("partition"), F.col("commit_offset").alias("source_commit"))
    return fx.plain(seen.join(ends, "partition").join(committed, "partition"))


def _run_transactions(spark, sf, transform, **options):
    """Feed a transactional sink portion by portion until a transaction is aborted."""
    out, checkpoint = folder(spark)
    sink = TxnSink(spark, out, "copy", **options)
    stopped = []

    def run(log):
        if stopped:
            return
        query = runs.start(log.read_stream(topics=["events"]), exactly_once(transform, sink), checkpoint)
        try:
            query.awaitTermination()
        except Exception as failure:
            if TransactionAborted.__name__ not in str(failure):
                raise
            stopped.append(failure)

    replay_log(spark, sf, run)
    return sink


@query(
    f"""WITH {L} SELECT 3 - part_id AS part_id, COUNT(*) AS visible, COUNT(DISTINCT log_offset) AS distinct_offsets, MAX(log_offset) + {PORTIONS} AS end_offset, MAX(log_offset) + 1 AS source_commit FROM l GROUP BY part_id"""
)
def txn_visible(spark, sf):
    """One transaction per portion: all records visible, one control entry per portion and
    partition, source offsets committed."""
    return _copied(_run_transactions(spark, sf, _copy))


@query(ORACLES["txn_visible"])
def txn_compacted(spark, sf):
    """The same, with closed transactions moved into parts along the way and at the end."""
    sink = _run_transactions(spark, sf, _copy, compact_every=1)
    sink.compact()
    return _copied(sink)


@query(
    f"""WITH {L}, b AS (SELECT MIN(epoch_us(ts)) AS lo, MAX(epoch_us(ts)) - MIN(epoch_us(ts)) + 1 AS span FROM l),
p AS (SELECT l.*, (SELECT COUNT(*) FROM range(1, {PORTIONS}) r(i), b WHERE epoch_us(ts) >= lo + span * i // {PORTIONS}) AS portion FROM l),
f AS (SELECT MIN(portion) AS stop FROM p WHERE ts >= TIMESTAMP '2024-01-15')
SELECT 3 - part_id AS part_id, COUNT(*) AS visible, MAX(log_offset) + 1 AS source_commit FROM p, f WHERE stop IS NULL OR portion < stop GROUP BY part_id"""
)
def exactly_once_stream(spark, sf):
    """Records from the 15th on cannot be sent: the portion with the first of them is aborted
    as a whole, and only the portions before it are visible."""

    def transform(batch):
        failing = F.when(F.col("timestamp") >= "2024-01-15", "TimeoutException")
        return _copy(batch).withColumn("error", failing)

    sink = _run_transactions(spark, sf, transform)
    seen = sink.read().groupBy("partition").agg(F.count(F.lit(1)).alias("visible"))
    committed = sink.committed().select((3 - F.col("partition")).alias("partition"), F.col("commit_offset").alias("source_commit"))
    return fx.plain(seen.join(committed, "partition"))


_IN_PORTIONS = f"""WITH {L}, b AS (SELECT MIN(epoch_us(ts)) AS lo, MAX(epoch_us(ts)) - MIN(epoch_us(ts)) + 1 AS span FROM l),
p AS (SELECT l.*, (SELECT COUNT(*) FROM range(1, {PORTIONS}) r(i), b WHERE epoch_us(ts) >= lo + span * i // {PORTIONS}) AS portion FROM l)"""


def _mixed_transactions(spark, sf, send):
    """Each portion goes to ``send(sink, batch, batch_id)``; visible records and committed source
    offsets by source partition."""
    out, checkpoint = folder(spark)
    sink = TxnSink(spark, out, "copy")
    replay_log(spark, sf, lambda log: runs.start(log.read_stream(topics=["events"]), lambda batch, i: send(sink, batch, i), checkpoint))
    seen = sink.read().groupBy((3 - F.col("partition")).alias("partition")).agg(F.count(F.lit(1)).alias("visible"))
    committed = sink.committed().select("partition", F.col("commit_offset").alias("source_commit"))
    return fx.plain(seen.join(committed, "partition", "left"))


def _next_offsets(batch):
    return batch.groupBy(*TP).agg((F.max("offset") + 1).alias("commit_offset"))


@query(
    f"""{_IN_PORTIONS} SELECT part_id, COUNT(*) AS visible, MAX(log_offset) + 1 AS source_commit FROM p
 WHERE (portion = 0 AND part_id < 3) OR (portion = 2 AND part_id >= 2) GROUP BY part_id"""
)
def txn_after_abort(spark, sf):
    """The second transaction is aborted after its records and offsets were written; the first and
    the third touch different partitions. Offsets of the first stay, those of the second never count."""

    def send(sink, batch, batch_id):
        part = batch.where("partition < 3" if batch_id == 0 else "partition >= 2")
        if batch_id == 1:
            sink.write_data(_copy(batch), batch_id, ("seq",))
            sink.send_offsets(_next_offsets(batch), batch_id)
            sink.abort(batch_id)
        else:
            sink.run(_copy(part), batch_id, _next_offsets(part))

    return _mixed_transactions(spark, sf, send)


@query(
    f"""{_IN_PORTIONS} SELECT part_id, COUNT(*) AS visible, MAX(CASE WHEN portion = 0 OR (portion = 2 AND part_id >= 2) THEN log_offset END) + 1 AS source_commit
 FROM p GROUP BY part_id"""
)
def txn_batch_without_offsets(spark, sf):
    """The second transaction carries no consumer offsets, the third only those of two partitions."""

    def send(sink, batch, batch_id):
        offsets = None if batch_id == 1 else _next_offsets(batch.where("partition >= 2") if batch_id else batch)
        sink.run(_copy(batch), batch_id, offsets)

    return _mixed_transactions(spark, sf, send)


@query(
    f"""WITH {PEOPLE} SELECT id, 'by-first' AS topic, lower(first_name) || '@first.example' AS email FROM p
UNION ALL SELECT id, 'by-last' AS topic, lower(last_name) || '@last.example' AS email FROM p"""
)
def fan_out(spark, sf):
    """One read of the person stream, two independent outputs."""
    people = fx.people(spark, sf).withColumn("at", F.timestamp_seconds(F.col("id").cast("long")))
    out, checkpoint = folder(spark)

    def branch(topic, column, domain):
        def write(batch, batch_id):
            derived = batch.select("id", F.lit(topic).alias("topic"), records.derive_email(F.col(column), domain).alias("email"))
            runs.overwrite(derived, f"{out}/{topic}", batch_id)

        return write

    both = runs.fan_out(branch("by-first", "first_name", "first.example"), branch("by-last", "last_name", "last.example"))
    replay(people, "at", lambda path: runs.start(spark.readStream.schema(people.schema).parquet(path), both, checkpoint))
    outputs = [spark.read.parquet(f"{out}/{t}").drop("batch_id") for t in ("by-first", "by-last")]
    return records.merge(*outputs)


@query(f"WITH {L} SELECT part_id, log_offset FROM l")
def external_sink(spark, sf):
    """Writing to an external store whose first attempt fails in every batch."""
    out, checkpoint = folder(spark)
    tried = set()

    def writer(batch, batch_id):
        if batch_id not in tried:
            tried.add(batch_id)
            raise OSError("store not reachable")
        runs.overwrite(batch.select("partition", "offset"), out, batch_id)

    each = runs.sink_then_commit(writer, pause_seconds=0.0)
    replay_log(spark, sf, lambda log: runs.start(log.read_stream(topics=["events"]), each, checkpoint))
    return fx.plain(spark.read.parquet(out).drop("batch_id"))
