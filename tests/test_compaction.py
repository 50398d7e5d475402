"""Compaction of a transactional sink: the same rows with few files, for readers before and after."""

import os

import pytest
from pyspark.sql import functions as F

from logweave.streaming import compaction, runs
from logweave.streaming.transactional import TxnSink
from test_streams import T0, _committed, _offsets, _requests


def rows(df):
    return sorted((r.topic, r.partition, r.offset, r.txn_id, bool(r.is_control)) for r in df.collect())


def files(path):
    return sum(f.endswith(".parquet") for _, _, found in os.walk(path) for f in found)


def fill(sink, spark, first, last, aborted=()):
    for batch in range(first, last):
        if batch in aborted:
            sink.write_data(_requests(spark, batch % 2, batch), batch, ("seq",))
            sink.abort(batch)
        else:
            sink.run(_requests(spark, batch % 2, batch), batch, _offsets(spark, (0, batch + 1)))


def test_same_rows_and_readers_outlive_a_compaction(spark, tmp_path):
    sink = TxnSink(spark, f"{tmp_path}/sink")
    assert not sink.compact() and rows(sink.entries()) == []
    fill(sink, spark, 0, 6, aborted=(2,))
    early = {level: (sink.read(level), rows(sink.read(level))) for level in ("read_committed", "read_uncommitted")}
    assert sink.compact() and not sink.compact()
    for level, (reader, before) in early.items():
        assert rows(reader) == before == rows(sink.read(level))
    assert compaction.Snapshot(spark, sink.path).upto == 3
    assert [sink.state(b) for b in range(7)] == ["committed"] * 2 + ["aborted"] + ["committed"] * 3 + [None]
    assert sorted((r.txn_id, r.state) for r in sink.txns().collect())[2] == ("txn-2", "aborted")
    # a repeated old batch is not run again, later ones go on where the log ends
    sink.run(_requests(spark, 0, 77), 1, _offsets(spark, (0, 1000)))
    fill(sink, spark, 6, 9)
    assert _committed(sink) == [(0, 9)]
    places = [(r[1], r[2]) for r in rows(sink.entries())]
    assert len(places) == len(set(places)) == 18
    middle = sink.read()
    seen = rows(middle)
    assert sink.compact()
    assert rows(middle) == seen == rows(sink.read())
    # the first generation's folders are gone now
    assert runs.batches_in(spark, f"{sink.path}/txns") == [4, 5, 6, 7, 8]
    assert not any(n.endswith(("-0", "-3")) for n in os.listdir(f"{sink.path}/data"))


@pytest.mark.parametrize("step", ["_write", "overwrite", "_clean"])
def test_crash_changes_nothing(spark, tmp_path, step, monkeypatch):
    sink = TxnSink(spark, f"{tmp_path}/sink")
    fill(sink, spark, 0, 3)
    before = rows(sink.read())
    real = getattr(compaction, step)

    def crash(*args):
        if step == "overwrite":  # the manifest is there but not complete
            real(*args)
            os.remove(f"{runs.batch_dir(*args[1:])}/_SUCCESS")
        raise OSError("machine lost")

    monkeypatch.setattr(compaction, step, crash)
    with pytest.raises(OSError):
        sink.compact()
    monkeypatch.setattr(compaction, step, real)
    assert rows(sink.read()) == before
    fill(sink, spark, 3, 4)
    before = rows(sink.read())
    assert sink.compact()
    assert rows(sink.read()) == before and _committed(sink) == [(0, 4)]


def test_many_batches_leave_few_files(spark, tmp_path, monkeypatch):
    """Markers and entries of many batches, written without the sink so that there can be many."""
    monkeypatch.setattr(compaction, "FAN", 3)
    sink, counts, total = TxnSink(spark, f"{tmp_path}/sink"), [], 120
    for low in range(0, total, 8):
        made = spark.range(low, low + 8, 1, 1).select(
            F.concat(F.lit("txn-"), "id").alias("txn_id"), F.col("id").alias("offset"), F.lit(T0).alias("timestamp"), F.lit(0).alias("timestampType"),
            F.lit(b"k").alias("key"), F.lit(b"v").alias("value"), F.lit(False).alias("is_control"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        )
        made.write.mode("append").partitionBy("txn_id", "topic", "partition").parquet(f"{sink.path}/data")
        marks = spark.range(low, low + 8, 1, 1).select(
            F.concat(F.lit("txn-"), "id").alias("txn_id"), F.lit("committed").alias("state"), F.col("id").alias("batch_id"),
            F.lit(None).cast("long").alias("ends"), F.lit(None).cast("long").alias("offsets"),
        )
        marks.write.mode("append").partitionBy("batch_id").parquet(f"{sink.path}/txns")
        sink.compact()
        counts.append(files(f"{sink.path}/data") + files(f"{sink.path}/parts"))
    assert sorted(r.offset for r in sink.read().collect()) == list(range(total))
    assert max(counts[len(counts) // 2 :]) <= 40 and files(f"{sink.path}/txns") <= 20
    parts = compaction.Snapshot(spark, sink.path).parts
    assert parts[0]["first"] == 0 and all(a["last"] + 1 == b["first"] for a, b in zip(parts, parts[1:]))
    assert all(sum(p["tier"] == t for p in parts) < 3 for t in range(5))


def test_sink_compacts_on_its_own(spark, tmp_path):
    sink = TxnSink(spark, f"{tmp_path}/sink", compact_every=2)
    fill(sink, spark, 0, 4)
    assert compaction.Snapshot(spark, sink.path).upto == 1
    assert len(rows(sink.read("read_uncommitted"))) == 4 and _committed(sink) == [(0, 4)]
