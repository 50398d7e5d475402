"""Commits with keyed state: against the definition, over restarts and crashes; what a batch touches."""

import random

import pytest
from pyspark.sql import functions as F

from logweave.streaming import runs, slices, stateful

SCHEMA = "kind string, topic string, partition int, offset long"
PROVIDERS = "org.apache.spark.sql.execution.streaming.state."


@pytest.fixture(params=["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def stores(spark, request):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, PROVIDERS + request.param)
    yield spark
    spark.conf.unset(name)


def feed(spark, base, rows, bits, wrap=lambda each: each):
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = slices.slice_changes(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), bits)
    query = runs.start(stream, wrap(slices.keyed_frontier(f"{base}/out")), f"{base}/cp", "update")
    query.awaitTermination()
    return query


def latest(spark, base):
    rows = stateful.latest_frontier(spark.read.parquet(f"{base}/out/commits")).collect()
    return {(r.topic, r.partition): (r.commit_offset, r.deferred_count) for r in rows}


def expected(delivered, acked):
    found = {}
    for key, offsets in delivered.items():
        gap = min((o for o in offsets if o not in acked[key]), default=None)
        ready = [o for o in offsets if o in acked[key] and (gap is None or o < gap)]
        late = [o for o in offsets if o in acked[key] and gap is not None and o > gap]
        found[key] = (max(ready) + 1 if ready else None, len(late))
    return found


@pytest.mark.parametrize("bits", [5, 4096])
def test_random_events_over_restarts(spark, tmp_path, bits):
    rng = random.Random(bits)
    keys = [("t", 0), ("t", 1), ("u", 0)]
    delivered, acked, next_offset = {k: [] for k in keys}, {k: set() for k in keys}, dict.fromkeys(keys, 0)
    for turn in range(5):
        rows = []
        for k in keys[: 2 if turn == 3 else 3]:
            for _ in range(rng.randrange(12)):
                delivered[k].append(next_offset[k])
                rows.append(("delivered", *k, next_offset[k]))
                next_offset[k] += rng.choice([1, 1, 1, 2, 9])
            waiting = [o for o in delivered[k] if o not in acked[k]]
            for o in rng.sample(waiting, len(waiting) if turn == 4 else len(waiting) // 2):
                acked[k].add(o)
                rows.append(("acked", *k, o))
            rows.append(("acked", *k, 10**6))  # never delivered
            rows.append(("other", *k, 0))
        rows += rng.sample(rows, len(rows) // 3)
        rng.shuffle(rows)
        feed(spark, tmp_path, rows, bits)
        assert latest(spark, tmp_path) == {k: v for k, v in expected(delivered, acked).items() if delivered[k]}


def test_a_batch_touches_the_slices_of_its_events(stores, tmp_path):
    spark = stores
    many = [("delivered", "t", 0, o) for o in range(1000)]
    state = feed(spark, tmp_path, many, 10).recentProgress[0]["stateOperators"][0]
    assert (state["numRowsTotal"], state["numRowsUpdated"]) == (100, 100)
    state = feed(spark, tmp_path, [("acked", "t", 0, o) for o in (0, 1, 999)], 10).recentProgress[0]["stateOperators"][0]
    assert (state["numRowsTotal"], state["numRowsUpdated"]) == (100, 2)
    assert latest(spark, tmp_path) == {("t", 0): (2, 1)}
    # finished slices leave the state, and slices before the gap the table
    state = feed(spark, tmp_path, [("acked", "t", 0, o) for o in range(995)], 10).recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 1
    assert latest(spark, tmp_path) == {("t", 0): (995, 1)}
    assert spark.read.parquet(f"{tmp_path}/out/slices/batch_id=2").count() == 1


def test_a_finished_slice_behind_a_gap_goes_on(spark, tmp_path):
    feed(spark, tmp_path, [("delivered", "t", 0, 0), *[(k, "t", 0, o) for o in (10, 11) for k in ("delivered", "acked")]], 10)
    assert latest(spark, tmp_path) == {("t", 0): (None, 2)}
    feed(spark, tmp_path, [("delivered", "t", 0, 12), ("delivered", "t", 0, 13), ("acked", "t", 0, 13)], 10)
    assert latest(spark, tmp_path) == {("t", 0): (None, 3)}
    feed(spark, tmp_path, [("acked", "t", 0, 0)], 10)
    assert latest(spark, tmp_path) == {("t", 0): (12, 1)}


@pytest.mark.parametrize("lost", ["changed", "partitions", "commits", "slices"])
def test_crash_between_steps(spark, tmp_path, lost, monkeypatch):
    feed(spark, tmp_path, [("delivered", "t", 0, o) for o in range(25)], 10)
    acks = [("acked", "t", 0, o) for o in (*range(12), 20, 21)]
    steps = {name: getattr(slices, name) for name in ("overwrite", "store_state")}

    def crash(step):
        def run(df, path, batch_id):
            if path.endswith(lost) and batch_id == 1:
                raise OSError("machine lost")
            steps[step](df, path, batch_id)

        return run

    for name in steps:
        monkeypatch.setattr(slices, name, crash(name))
    with pytest.raises(Exception, match="machine lost"):
        feed(spark, tmp_path, acks, 10)
    for name, step in steps.items():
        monkeypatch.setattr(slices, name, step)
    feed(spark, tmp_path, [], 10)
    assert latest(spark, tmp_path) == {("t", 0): (12, 2)}
    feed(spark, tmp_path, [("acked", "t", 0, o) for o in range(25)], 10)
    assert latest(spark, tmp_path) == {("t", 0): (25, 0)}
    assert spark.read.parquet(f"{tmp_path}/out/commits").where(F.col("deferred_count") < 0).isEmpty()
