"""Record flows: projection, expansion, ordered processing, sampling, comparison, codecs."""

from pyspark.sql import functions as F

from logweave.functions.codec import bytes_to_int, bytes_to_text, decode_layout, encode_layout
from logweave.functions.report import format_record as record_line
from logweave.operators import commits, records, send
from workload import fixtures as fx
from workload import query
from workload.sql import L, M

PEOPLE = "p AS (SELECT CAST(c_custkey AS INT) AS id, c_mktsegment AS first_name, c_name AS last_name, c_acctbal FROM customer)"


@query(f"WITH {PEOPLE} SELECT id, first_name, last_name, lower(first_name) || '@example.org' AS email FROM p")
def transform_project(spark, sf):
    people = fx.people(spark, sf)
    return people.withColumn("email", records.derive_email(F.col("first_name"), "example.org")).drop("balance")


@query(f"WITH {PEOPLE} SELECT id, upper(first_name) AS first_name, upper(last_name) AS last_name, CAST(NULL AS VARCHAR) AS email FROM p")
def transform_upper(spark, sf):
    return records.upper_person(fx.people(spark, sf)).drop("balance")


@query(f"WITH {L} SELECT part_id, log_offset FROM l WHERE CAST(regexp_extract(props, '[0-9]+') AS INT) >= 50")
def filter_records(spark, sf):
    amount = F.get_json_object(bytes_to_text(F.col("value")), "$.k").cast("int")
    return fx.plain(fx.event_log(spark, sf).where(amount >= 50).select("partition", "offset"))


_EXPANDED = f"""WITH {PEOPLE} SELECT id, 'by-first' AS topic, lower(first_name) || '@first.example' AS email FROM p
UNION ALL SELECT id, 'by-last' AS topic, lower(last_name) || '@last.example' AS email FROM p"""


def two_copies(people):
    return records.expand(
        people,
        {"topic": F.lit("by-first"), "email": records.derive_email(F.col("first_name"), "first.example")},
        {"topic": F.lit("by-last"), "email": records.derive_email(F.col("last_name"), "last.example")},
    ).select("id", "topic", "email")


@query(_EXPANDED)
def expand_records(spark, sf):
    return two_copies(fx.people(spark, sf))


@query(f"WITH {M} SELECT topic, part_id, log_offset, ts FROM m WHERE topic IN ('ev-click', 'ev-error')")
def merge_streams(spark, sf):
    log = fx.topic_log(spark, sf)
    merged = records.merge(log.read(topics=["ev-click"]), log.read(topics=["ev-error"]))
    return fx.plain(merged.select("topic", "partition", "offset", "timestamp"))


@query(f"WITH {L} SELECT member_id, part_id, log_offset, ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY log_offset, part_id) - 1 AS delivery_seq FROM l")
def flatten_batches(spark, sf):
    batched = commits.poll_batches(fx.event_log(spark, sf), 500, fx.member())
    return fx.plain(records.flatten(batched).select("member_id", "partition", "offset", "delivery_seq"))


@query(
    f"""WITH {L}, k AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS amount FROM l)
SELECT part_id, log_offset, CAST(SUM(amount) OVER (PARTITION BY part_id ORDER BY log_offset) AS BIGINT) AS balance FROM k"""
)
def process_by_partition(spark, sf):
    """A user function that keeps a running balance per partition."""
    amount = F.get_json_object(bytes_to_text(F.col("value")), "$.k").cast("long")
    log = fx.event_log(spark, sf).select("topic", "partition", "offset", amount.alias("amount"))
    return fx.plain(
        records.process_by_partition(
            log,
            step=lambda pdf, opening: pdf[["partition", "offset"]].assign(balance=pdf["amount"].cumsum() + opening),
            schema="partition int, offset long, balance long",
            summary=lambda pdf: int(pdf["amount"].sum()),
            combine=lambda a, b: a + b,
            initial=0,
        )
    )


@query(
    f"""WITH {L} SELECT part_id, time_bucket(INTERVAL 6 HOURS, ts) AS period_start, MAX(log_offset) AS log_offset, MAX_BY(ts, log_offset) AS ts,
 MAX_BY(CAST(user_id AS INT), log_offset) AS user_id FROM l GROUP BY 1, 2"""
)
def sample_latest(spark, sf):
    log = fx.event_log(spark, sf).select("topic", "partition", "offset", "timestamp", bytes_to_int(F.col("key")).alias("user_id"))
    return fx.plain(records.sample_latest(log, "6 hours").drop("topic"))


@query(f"WITH {L} SELECT member_id, part_id, log_offset FROM l QUALIFY ROW_NUMBER() OVER (PARTITION BY member_id ORDER BY log_offset, part_id) <= 100")
def take_n(spark, sf):
    log = fx.event_log(spark, sf).select("partition", "offset", fx.member().alias("member_id"))
    return fx.plain(records.take(log, 100, ["member_id"], ["offset", "partition"]))


@query(
    f"""WITH {L} SELECT member_id, part_id, log_offset FROM l
QUALIFY COUNT(*) FILTER (value > 250) OVER (PARTITION BY member_id ORDER BY log_offset, part_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0"""
)
def take_while(spark, sf):
    log = fx.deliveries(spark, sf).select("partition", "offset", fx.member().alias("member_id"), "value")
    kept = records.take_while(log, F.col("value") <= 250, ["member_id"], ["offset", "partition"])
    return fx.plain(kept.drop("value"))


@query(
    f"""WITH {L}, g AS (SELECT part_id, MIN(CASE WHEN value > 300 THEN event_id END) AS cut FROM l GROUP BY part_id)
SELECT part_id, MAX(log_offset) + 1 AS commit_offset, COUNT(*) AS transferred FROM l JOIN g USING (part_id) WHERE cut IS NULL OR event_id < cut GROUP BY part_id"""
)
def transfer_commits(spark, sf):
    """Copying to another topic; a record slower than 300 cannot be sent and stops its partition.
    The source offset travels as correlation and is committed after its send."""
    source = fx.deliveries(spark, sf)
    outgoing = source.select(
        F.concat_ws("-", "topic", "partition").alias("sender_id"),
        F.col("id").alias("seq"),
        F.lit("copy").alias("topic"),
        (3 - F.col("partition")).alias("partition"),
        "timestamp",
        F.struct("topic", "partition", "offset").alias("correlation"),
        F.when(F.col("value") > 300, "TimeoutException").alias("error"),
    )
    results = send.send_results(send.assign_offsets(send.stop_on_error(outgoing)))
    acked = results.where(F.col("exception").isNull()).select("correlation.*").withColumn("ack_seq", F.col("offset"))
    return fx.plain(
        acked.groupBy("partition").agg(
            (F.max_by("offset", "ack_seq") + 1).alias("commit_offset"), F.count(F.lit(1)).alias("transferred")
        )
    )


@query(
    f"""WITH {L}, p AS (SELECT *, LAG(user_id) OVER (PARTITION BY part_id ORDER BY log_offset) AS prev FROM l)
SELECT part_id, COUNT(*) AS records, COUNT(*) FILTER (user_id <= prev) AS violations FROM p GROUP BY part_id"""
)
def partition_order_check(spark, sf):
    log = fx.event_log(spark, sf).withColumn("user_id", bytes_to_int(F.col("key")))
    return fx.plain(records.check_partition_order(log, "user_id").drop("topic"))


@query(
    """WITH e AS (SELECT CAST(user_id % 4 AS INT) AS part_id, CAST(user_id AS INT) AS user_id, props, event_type FROM events),
d AS (SELECT part_id, user_id, props, SUM(CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN -1 ELSE 0 END) AS d FROM e GROUP BY ALL)
SELECT part_id, user_id, props, CAST(GREATEST(d, 0) AS BIGINT) AS missing, CAST(GREATEST(-d, 0) AS BIGINT) AS extra FROM d WHERE d <> 0"""
)
def reconcile_topics(spark, sf):
    """Everything sent, against a reader that lost the errors and got the clicks twice."""
    log = fx.topic_log(spark, sf)
    columns = ["partition", "user_id", "props"]

    def decoded(df):
        return df.select("partition", bytes_to_int(F.col("key")).alias("user_id"), bytes_to_text(F.col("value")).alias("props"))

    received = records.merge(log.read(pattern="ev-(click|view|signup|purchase)"), log.read(topics=["ev-click"]))
    difference = records.reconcile(decoded(log.read(topics=["events"])), decoded(received), columns)
    return fx.plain(difference.withColumns({c: F.col(c).cast("long") for c in ("missing", "extra")}))


def _people_log(spark, sf):
    log = fx.topic_log(spark, sf).read(topics=["people"])
    return decode_layout(log.select("partition", "offset", "key", "value"), "value", fx.PERSON)


@query(f"WITH {PEOPLE} SELECT id, first_name, last_name, CAST(NULL AS VARCHAR) AS email, id AS key_id FROM p WHERE c_acctbal >= 0")
def decode_topic(spark, sf):
    decoded = _people_log(spark, sf).where("decoded_ok")
    return decoded.select(*[n for n, _ in fx.PERSON], bytes_to_int(F.col("key")).alias("key_id"))


@query(
    f"""WITH {PEOPLE} SELECT CAST(id % 4 AS INT) AS part_id, log_offset, 9 AS size FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY id % 4 ORDER BY id) - 1 AS log_offset FROM p) WHERE c_acctbal < 0"""
)
def decode_dead_letter(spark, sf):
    broken = _people_log(spark, sf).where(~F.col("decoded_ok"))
    return fx.plain(broken.select("partition", "offset", F.octet_length("value").alias("size")))


_HEX = "printf('%08x', id) || printf('%08x', strlen(first_name)) || lower(hex(encode(first_name))) || printf('%08x', strlen(last_name)) || lower(hex(encode(last_name))) || '00000000'"


@query(f"WITH {PEOPLE} SELECT id, {_HEX} AS bytes, TRUE AS same FROM p")
def encode_roundtrip(spark, sf):
    people = fx.people(spark, sf)
    encoded = people.select("*", encode_layout({n: F.col(n) for n, _ in fx.PERSON}, fx.PERSON).alias("data"))
    fields = [n for n, _ in fx.PERSON]
    before = encoded.select("data", F.struct(*fields).alias("before"))
    back = decode_layout(before, "data", fx.PERSON)
    same = F.col("before").eqNullSafe(F.struct(*fields))
    return back.select("id", F.lower(F.hex("data")).alias("bytes"), same.alias("same"))


@query(
    f"""WITH {L} SELECT part_id, log_offset, 'topic-partition=events-' || part_id || ' offset=' || log_offset || ' timestamp='
 || strftime(ts, '%H:%M:%S:') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || strftime(ts, ' UTC %d %b %Y') || ' key=' || user_id || ' value=' || props AS line FROM l"""
)
def format_record(spark, sf):
    line = record_line(
        F.col("topic"), F.col("partition"), F.col("offset"), F.col("timestamp"),
        bytes_to_int(F.col("key")).cast("string"), bytes_to_text(F.col("value")),
    )
    return fx.plain(fx.event_log(spark, sf).select("partition", "offset", line.alias("line")))
