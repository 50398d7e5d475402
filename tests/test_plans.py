"""Shared plan shapes against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.plans import chains
from logweave.plans.ordered import Running, positions, previous, running
from logweave.plans.quantiles import nearest_rank
from logweave.plans.small import attach, bounded


def numbers(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for group, size in (("hot", 700), ("warm", 90), ("single", 1)):
        rows += [(group, n, rng.randrange(-50, 50), rng.random() < 0.3) for n in rng.sample(range(2000), size)]
    return rows, spark.createDataFrame(rows, "g string, n long, v int, missing boolean")


def test_running_values_cross_slices(narrow):
    rows, df = numbers(narrow)
    value = F.when(~F.col("missing"), F.col("v"))
    measures = [
        Running("total", "sum", value),
        Running("total_before", "sum", value, inclusive=False),
        Running("top", "max", value),
        Running("low", "min", value, inclusive=False),
        Running("latest", "last", value),
    ]
    got = {(r.g, r.n): r for r in running(df, ["g"], ["n"], measures).collect()}
    assert len(got) == len(rows)
    state = {}
    for g, n, v, missing in sorted(rows):
        seen = state.setdefault(g, [])
        r = got[g, n]
        assert r.total_before == sum(seen)
        assert r.low == (min(seen) if seen else None)
        if not missing:
            seen.append(v)
        assert (r.total, r.top, r.latest) == (sum(seen), max(seen, default=None), seen[-1] if seen else None)


def test_positions_and_previous(narrow):
    rows, df = numbers(narrow, 5)
    ranked = {(r.g, r.n): r.position for r in positions(df, ["g"], ["n"]).collect()}
    value = F.when(~F.col("missing"), F.col("v"))
    before = {(r.g, r.n): r.prev for r in previous(df, ["g"], ["n"], {"prev": value}).collect()}
    last, count = {}, {}
    for g, n, v, missing in sorted(rows):
        assert ranked[g, n] == count.get(g, 0)
        assert before[g, n] == last.get(g)
        count[g] = count.get(g, 0) + 1
        last[g] = None if missing else v


def walk(values, near, far, first_hits):
    out, seen, last = {}, 0, None if first_hits else values[0]
    for v in values:
        hit = last is None or v >= last + far or (last < v <= last + near)
        out[v] = (hit, seen, last)
        if hit:
            seen, last = seen + 1, v
    return out


@pytest.mark.parametrize("block,fan", [(16, 16), (200, 16), (16, 2), (5, 3), (1, 4)])
@pytest.mark.parametrize("near,far,first_hits", [(0, 7, False), (0, 40, False), (4, 6, True), (3, 6, True), (0, 1, True), (2, 30, True)])
def test_chains(narrow, monkeypatch, block, fan, near, far, first_hits):
    monkeypatch.setattr(chains, "MAX_BLOCK", block)
    monkeypatch.setattr(chains, "FAN", fan)
    narrow.conf.set("spark.logweave.sliceWidth", str(block))
    rng = random.Random(far)
    rows, expected = [], {}
    for g, size in (("hot", 500), ("warm", 60), ("single", 1)):
        values = sorted(rng.sample(range(1000), size))
        rows += [(g, v) for v in values]
        expected |= {(g, v): r for v, r in walk(values, near, far, first_hits).items()}
    nodes = narrow.createDataFrame(rows, "g string, v long")
    got = chains.hits(nodes, ["g"], "v", near, far, first_hits).collect()
    assert {(r.g, r.v): (r.is_hit, r.hits_before, r.last_hit) for r in got} == expected


def test_no_node_holds_more_than_one_span(spark, monkeypatch):
    """Maps at every level stay within ``far`` of their first value, and a task gets FAN of them."""
    monkeypatch.setattr(chains, "MAX_BLOCK", 8)
    monkeypatch.setattr(chains, "FAN", 4)
    monkeypatch.setattr(chains, "slice_width", lambda spark: 8)
    kept, sizes = chains._composed, []
    monkeypatch.setattr(chains, "_composed", lambda maps, *args: sizes.append(kept(maps, *args)) or sizes[-1])
    values = sorted(random.Random(8).sample(range(4000), 1500))
    nodes = spark.createDataFrame([("hot", v) for v in values], "g string, v long")
    far = 50
    got = chains.hits(nodes, ["g"], "v", 0, far, False)
    assert {r.v: (r.is_hit, r.hits_before, r.last_hit) for r in got.collect()} == walk(values, 0, far, False)
    assert len(sizes) == 4  # 500 blocks, then 125, 32, 8 and 2 nodes
    for level in sizes:
        for r in level.groupBy("__block").agg(F.min("__entry").alias("first"), F.max("__entry").alias("last"), F.count("*").alias("n")).collect():
            within = [v for v in values if r.first <= v < r.first + far]
            assert r.n <= len(within) + 1
    assert chains.widest(sizes[-1], ["g"]) <= 4


def test_chain_of_compose_equals_block_map():
    rng = np.random.default_rng(3)
    for near, far in ((0, 9), (2, 12), (5, 6), (0, 60)):
        values = np.array(sorted(rng.choice(400, 150, replace=False)))
        parts = [p for p in np.split(values, np.searchsorted(values, [50, 90, 91, 200, 310])) if len(p)]
        whole = chains.block_map(values, near, far)
        got = chains.compose((chains.block_map(p, near, far) for p in parts), near, far)
        for a, b in zip(got, whole):
            assert a.tolist() == b.tolist()


def test_chain_continues_from_carry(narrow):
    values = sorted(random.Random(1).sample(range(5000), 400))
    whole = walk(values, 0, 90, False)
    cut = 200
    late = values[cut:]
    hit, seen, last = whole[late[0]]
    nodes = narrow.createDataFrame([("a", v) for v in late], "g string, v long")
    carry = narrow.createDataFrame([("a", last)], "g string, after long")
    got = chains.hits(nodes, ["g"], "v", 0, 90, False, carry).collect()
    assert {r.v: (r.is_hit, r.hits_before + seen, r.last_hit) for r in got} == {v: whole[v] for v in late}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_broadcast_and_salted_join_agree(spark, how):
    big = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), F.col("id").alias("offset"))
    small = spark.createDataFrame([(0, "a"), (3, "b"), (99, "c")], "k long, name string")
    near = attach(big, small, ["k"], how)
    far = attach(big, small, ["k"], how, max_rows=1)
    assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))
    assert "Broadcast" in near._jdf.queryExecution().sparkPlan().toString()


def test_bounded(spark):
    assert bounded(spark.range(10), 10).num_rows == 10
    assert bounded(spark.range(11), 10) is None


def test_nearest_rank(spark):
    rng = random.Random(9)
    rows = [("a", rng.choice([5, 5, 5, rng.randrange(3000)])) for _ in range(999)] + [("b", 7)] + [("c", v) for v in (-3, -1, 0, 2)]
    df = spark.createDataFrame(rows, "g string, v long")
    wanted = {"p0": 0.0, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p999": 0.999}
    got = {r.g: r for r in nearest_rank(df, "v", wanted, ["g"]).collect()}
    for g in "abc":
        values = sorted(v for h, v in rows if h == g)
        for name, p in wanted.items():
            assert got[g][name] == values[int(p * len(values))], (g, name)
    everything = sorted(v for _, v in rows)
    assert nearest_rank(df, "v", {"p50": 0.5}).first().p50 == everything[int(0.5 * len(everything))]
