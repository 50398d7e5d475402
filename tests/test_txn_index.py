"""Committed reads by the index of transactions against the log itself."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logweave.schema import LOG, TP
from logweave.sources import isolation, topic_log, txn_index
from logweave.sources.topic_log import TopicLog
from tests.test_manifest import T0, rows

STATES = ["committed", "aborted", None]


@pytest.fixture
def made(spark, tmp_path):
    """Transactions that interleave, cross partitions and appends; some never decided."""
    rng, log = random.Random(11), TopicLog(spark, f"{tmp_path}/log")
    states = {f"t{i}": rng.choices(STATES, [6, 3, 1])[0] for i in range(60)}
    for n in range(3):
        data = []
        for topic, partition in (("a b", 0), ("a b", 1), ("c", 0)):
            for i in range(n * 80, n * 80 + 80):
                # older transactions first; partition 1 holds no transaction in the second append
                txn = None if rng.random() < 0.3 or (n == 1 and partition == 1) else f"t{min(59, i // 5 + rng.randrange(8))}"
                data.append((i, T0, 0, b"k", b"v", None, txn, txn is not None and rng.random() < 0.1, topic, partition))
        log.append(spark.createDataFrame(data, LOG).repartition(3))
    markers = [(t, s) for t, s in states.items() if s] + [("elsewhere", "aborted"), ("t1", states["t1"] or "open")]
    return log, spark.createDataFrame(markers, "txn_id string, state string")


def keys(df):
    return rows(df, "topic", "partition", "offset")


@pytest.mark.parametrize("markers", ["few", "many"])
def test_same_as_from_the_log(spark, made, monkeypatch, markers):
    log, txns = made
    if markers == "many":
        monkeypatch.setattr(topic_log, "bounded", lambda df: None)
    for chosen in ({"topics": ["a b"]}, {"pattern": ".*"}, {"assignment": [("c", 0), ("a b", 1)]}, {"topics": ["none"]}):
        entries = log.read(**chosen)
        assert keys(log.read_committed(txns, **chosen)) == keys(isolation.read(entries, txns, "read_committed"))
        starts = entries.select(*TP).distinct().withColumn("start_offset", F.lit(9).cast("long") + F.col("partition"))
        assert keys(log.read_committed(txns, **chosen, starts=starts)) == keys(isolation.read(entries, txns, "read_committed", starts))


def test_open_transactions_hide_and_aborted_ones_are_few(spark, made):
    log, txns = made
    spans = txn_index.spans(spark, log.path)
    stable = txn_index.stable_offsets(spans, txns)
    assert rows(stable, *TP, "stable_offset") == rows(isolation.last_stable_offsets(log.all(), txns), *TP, "stable_offset")
    met = {r.txn_id for r in txn_index.aborted_within(spans, txns, stable).collect()}
    below = log.all().join(stable, TP, "left").where("stable_offset is null or offset < stable_offset")
    assert met == {r.txn_id for r in below.join(txns.where("state = 'aborted'"), "txn_id").select("txn_id").distinct().collect()}
    assert "elsewhere" not in met
    only_late = log.all().select(*TP).distinct().withColumn("start_offset", F.lit(10**6).cast("long"))
    assert txn_index.aborted_within(spans, txns, stable, only_late).count() == 0


def test_files_of_others_count_at_once_and_are_described_later(spark, made):
    log, txns = made
    data = [(240 + i, T0, 0, b"k", b"v", None, "new" if i == 4 else None, False, "c", 0) for i in range(9)]
    spark.createDataFrame(data, LOG).coalesce(1).write.mode("append").partitionBy(*TP).parquet(log.path)
    want = keys(isolation.read(log.all(), txns, "read_committed"))
    assert keys(log.read_committed(txns, pattern=".*")) == want
    log.describe()
    log.describe()
    assert txn_index._undescribed(spark, log.path).isEmpty()
    assert keys(log.read_committed(txns, pattern=".*")) == want


def test_the_log_is_read_once(spark, made):
    log, txns = made
    plan = log.read_committed(txns, topics=["a b"])._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in re.findall(r"FileScan parquet [^\n]*", plan) if "_spans" not in s]
    assert len(scans) == 1 and "HashAggregate" not in plan


def test_an_empty_log(spark, tmp_path):
    log = TopicLog(spark, f"{tmp_path}/log")
    log.append(spark.createDataFrame([], LOG))
    assert log.read_committed(spark.createDataFrame([], "txn_id string, state string"), pattern=".*").count() == 0
