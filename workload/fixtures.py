"""Inputs of the registered queries, all derived from the given tables.

``events`` becomes the topic ``events`` and, per event type, ``ev-<type>``; ``customer`` becomes
the topic ``people``. The log is written once per session and data folder to the shared folder
and then read like any topic log. Every definition here has its SQL twin in ``sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.codec import encode_layout, int_to_bytes, text_to_bytes
from logweave.functions.headers import header
from logweave.operators.records import expand
from logweave.operators.send import assign_offsets
from logweave.plans.ordered import div
from logweave.schema import LOG_COLUMNS, TP
from logweave.session import new_dir, slice_width
from logweave.sources.topic_log import TopicLog

#: Bytes of a person record.
PERSON = [("id", "int"), ("first_name", "string"), ("last_name", "string"), ("email", "string_or_null")]

#: Records slower than this are never acknowledged.
ACK_LIMIT = 250.0

_written: dict[tuple, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The event table with ``ts`` as an instant (the files hold UTC wall-clock times)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def user_partition():
    return F.pmod(F.col("user_id"), F.lit(4)).cast("int")


def member():
    """Two members: even and odd partitions."""
    return F.pmod(F.col("partition"), F.lit(2))


def stored(spark: SparkSession, sf: str, name: str, write) -> str:
    """Path of a table written once per session; ``write(path)`` fills it."""
    key = (spark.sparkContext.applicationId, sf, name, slice_width(spark))
    if key not in _written:
        path = new_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _event_requests(spark: SparkSession, sf: str) -> DataFrame:
    source = events(spark, sf).select(
        F.col("event_id").alias("seq"),
        user_partition().alias("partition"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("key_id"),
        text_to_bytes(F.col("props")).alias("value"),
        F.col("value").alias("measure"),
        F.col("event_type").alias("kind"),
    )
    first = {"topic": F.lit("events"), "in_txn": F.col("kind") != "signup"}
    return expand(source, first, {"topic": F.concat(F.lit("ev-"), "kind"), "in_txn": F.lit(False)}).withColumn("traced", F.lit(True))


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as persons: segment and name as first and last name, no email."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.col("c_acctbal").alias("balance"),
    )


def _people_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Persons in bytes; those with a negative balance arrive cut off after nine bytes."""
    persons = people(spark, sf)
    data = encode_layout({n: F.col(n) for n, _ in PERSON}, PERSON)
    return persons.select(
        F.col("id").cast("long").alias("seq"),
        F.pmod("id", F.lit(4)).cast("int").alias("partition"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"),
        F.col("id").cast("long").alias("key_id"),
        F.when(F.col("balance") < 0, F.substring(data, 1, 9)).otherwise(data).alias("value"),
        F.lit("people").alias("topic"),
        F.col("balance").alias("measure"),
        F.col("first_name").alias("kind"),
        F.lit(False).alias("in_txn"),
        F.lit(False).alias("traced"),
    )


def _in_full(sent: DataFrame) -> DataFrame:
    """Entries and send results of narrow requests. What follows from a row alone is made here, after
    the shuffle and both sorts: an array of headers is larger than all the rest of a row."""
    headers = F.array(header("trace", F.col("seq")), header("h", F.lit("a")), header("trace", F.col("seq") + 1))
    return sent.withColumns(
        {
            "key": int_to_bytes(F.col("key_id")),
            "headers": F.when(F.col("traced"), headers),
            "txn_id": F.when(F.col("in_txn"), F.concat(F.lit("t"), div(F.col("seq"), 500).cast("string"))),
            "timestampType": F.lit(0),
            "is_control": F.lit(False),
            # send results are kept next to the entries; readers of the log never select them
            "correlation": F.struct(F.col("seq").alias("id"), F.col("measure").alias("value"), "kind"),
        }
    ).select(*LOG_COLUMNS, "correlation")


def _write_log(spark: SparkSession, sf: str, path: str) -> None:
    requests = _event_requests(spark, sf).unionByName(_people_requests(spark, sf))
    sent = assign_offsets(requests.withColumn("error", F.lit(None).cast("string")))
    _in_full(sent.sortWithinPartitions(*TP, "offset")).write.partitionBy(*TP).parquet(path)
    TopicLog(spark, path).describe()


def topic_log(spark: SparkSession, sf: str) -> TopicLog:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return TopicLog(spark, stored(spark, sf, "log", lambda path: _write_log(spark, sf, path)))


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return topic_log(spark, sf).read(topics=["events"])


def event_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Begin, end and number of entries of topic ``events``, from the manifest of the log."""
    return topic_log(spark, sf).bounds(topics=["events"])


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of topic ``events`` with what their sender knows: ``id``, ``value``, ``kind``."""
    path = topic_log(spark, sf).path
    return (
        spark.read.parquet(path)
        .where(F.col("topic") == "events")
        .select(*TP, "offset", "timestamp", "correlation.*")
    )


def acks(spark: SparkSession, sf: str, *extra) -> DataFrame:
    """Acknowledgements in a shuffled order (a permutation inside runs of 10007 ids)."""
    shuffled = div(F.col("id"), 10007) * 10007 + F.pmod(F.col("id") * 7919, F.lit(10007))
    return (
        deliveries(spark, sf)
        .where(F.col("value") <= ACK_LIMIT)
        .select(member().alias("member_id"), *TP, "offset", shuffled.alias("ack_seq"), F.col("timestamp").alias("ack_time"), *extra)
    )


def marked(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries of topic ``events`` and whether they were acknowledged."""
    return deliveries(spark, sf).select(*TP, "offset", (F.col("value") <= ACK_LIMIT).alias("acked"))


def commits(spark: SparkSession, sf: str) -> DataFrame:
    """Group ``g`` committed a quarter, then half of partitions 0 to 2, and nothing of 3."""
    ends = event_log(spark, sf).where(F.col("partition") < 3).groupBy(*TP).agg((F.max("offset") + 1).alias("n"))
    step = F.explode(F.array(*[F.struct(F.lit(no).alias("commit_no"), div(F.col("n"), d).alias("commit_offset")) for no, d in ((1, 4), (2, 2))]))
    return ends.select(*TP, step.alias("c")).select(F.lit("g").alias("group_id"), *TP, "c.*")


def txns(spark: SparkSession, sf: str) -> DataFrame:
    """Markers of the transactions in topic ``events``: those with a very slow record were
    aborted, the newest one has no marker yet."""
    per = (
        events(spark, sf)
        .where(F.col("event_type") != "signup")
        .groupBy(div(F.col("event_id"), 500).alias("no"))
        .agg(F.max("value").alias("slowest"))
    )
    newest = per.agg(F.max("no").alias("no"))
    return per.join(newest, "no", "left_anti").select(
        F.concat(F.lit("t"), F.col("no").cast("string")).alias("txn_id"),
        F.when(F.col("slowest") > 350, "aborted").otherwise("committed").alias("state"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Send requests, one sender per event type. Every second one names its partition; very
    fast ones go to a topic that does not exist, very slow ones meet a fatal error."""
    error = F.when(F.col("value") < 0.1, "InvalidTopicException").when(F.col("value") > 380, "AuthenticationException")
    return events(spark, sf).select(
        F.col("event_type").alias("sender_id"),
        F.col("event_id").alias("seq"),
        F.lit("dest").alias("topic"),
        F.when(F.col("event_id") % 2 == 1, F.pmod("event_id", F.lit(4)).cast("int")).alias("partition"),
        "user_id",
        F.col("ts").alias("timestamp"),
        int_to_bytes(F.col("user_id")).alias("key"),
        text_to_bytes(F.col("props")).alias("value"),
        F.array(header("h", F.lit("a"))).alias("headers"),
        F.col("event_id").alias("correlation"),
        error.alias("error"),
        F.col("value").alias("slowness"),
    )


def sends(spark: SparkSession, sf: str) -> DataFrame:
    """Completed sends: end time = event time, latency = rounded value."""
    end = F.unix_millis("ts")
    return events(spark, sf).select(
        user_partition().alias("sender_id"),
        F.col("event_id").alias("seq"),
        (end - F.round("value").cast("int")).alias("start_ms"),
        end.alias("end_ms"),
        F.octet_length("props").alias("bytes"),
        "event_type",
    )


def spans(spark: SparkSession, sf: str) -> DataFrame:
    """A publish span per event and a receive span per acknowledged event; five records per trace."""
    base = events(spark, sf).select(
        div(F.col("event_id"), 5).alias("trace_id"), F.col("event_id").alias("record_id"),
        F.lit("events").alias("topic"), "value",
    )
    sent = base.withColumns({"span_type": F.lit("sender"), "client_id": F.lit("producer-1")})
    got = base.where(F.col("value") <= ACK_LIMIT).withColumns({"span_type": F.lit("receiver"), "client_id": F.lit("consumer-1")})
    return sent.unionByName(got).drop("value")


def plain(df: DataFrame) -> DataFrame:
    """Output names that no SQL dialect reserves, and wall-clock UTC timestamps."""
    df = df.withColumnsRenamed({"partition": "part_id", "offset": "log_offset", "timestamp": "ts"})
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return df
