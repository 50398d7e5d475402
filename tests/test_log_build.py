"""The topic log that the queries read, from made events and customers."""

from datetime import datetime

from pyspark.sql import types as T

from workload import fixtures as fx


def test_wide_columns_are_made_after_the_shuffle(spark, tmp_path, monkeypatch):
    """Arrays of headers and the send results went through the shuffle and both sorts with every row."""
    at = datetime(2024, 1, 1)
    kinds = ["signup", "click", None]
    made = [(i, at, i * 7, kinds[i % 3], float(i), None if i == 5 else f'{{"k": {i}}}') for i in range(1200)]
    spark.createDataFrame(
        made, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame(
        [(i, "SEG", f"Name {i}", float(i - 3)) for i in range(6)], "c_custkey long, c_mktsegment string, c_name string, c_acctbal double"
    ).write.parquet(str(tmp_path / "customer.parquet"))
    seen = []
    assign = fx.assign_offsets
    monkeypatch.setattr(fx, "assign_offsets", lambda requests: seen.append(requests.schema) or assign(requests))
    log = spark.read.parquet(fx.topic_log(spark, str(tmp_path)).path)
    assert [f.name for s in seen for f in s if isinstance(f.dataType, T.ArrayType | T.StructType)] == []
    assert not {"headers", "correlation"} & {n for s in seen for n in s.names}

    rows = log.collect()
    assert len(rows) == 2 * 1200 + 6
    found = {(r.topic, r.correlation.id): r for r in rows if r.topic == "events" or r.topic == "people"}
    offsets = dict.fromkeys(range(4), 0)
    for i, _, user, kind, value, props in made:
        r = found["events", i]
        assert (r.partition, r.offset) == (user % 4, offsets[user % 4])
        offsets[user % 4] += 1
        assert [(h.key, bytes(h.value)) for h in r.headers] == [("trace", str(i).encode()), ("h", b"a"), ("trace", str(i + 1).encode())]
        assert r.txn_id == (f"t{i // 500}" if kind and kind != "signup" else None)
        assert (r.correlation.value, r.correlation.kind) == (value, kind)
        assert int.from_bytes(r.key, "big") == user and (r.value and bytes(r.value)) == (props and props.encode())
    copies = [r for r in rows if r.topic not in ("events", "people")]
    assert len(copies) == 1200 and all(r.txn_id is None and len(r.headers) == 3 for r in copies)
    people = [found["people", i] for i in range(6)]
    assert all(r.headers is None and r.txn_id is None and r.correlation.kind == "SEG" for r in people)
    assert [len(r.value) == 9 for r in people] == [True] * 3 + [False] * 3
