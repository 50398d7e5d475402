"""Chains whose last join turns into a broadcast while it runs."""

import pytest
from pyspark.sql import functions as F

from logweave.plans import chains
from test_plans import walk

LATE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def joined_late(narrow):
    """Joins are planned as sorted ones and broadcast once the size of a side is known."""
    before = {k: narrow.conf.get(k, None) for k in LATE}
    for k, v in LATE.items():
        narrow.conf.set(k, v)
    yield narrow
    for k, v in before.items():
        if v is None:
            narrow.conf.unset(k)
        else:
            narrow.conf.set(k, v)


@pytest.mark.parametrize("fan", [2, 16])
def test_a_block_stays_whole_when_its_join_is_broadcast(joined_late, monkeypatch, fan):
    monkeypatch.setattr(chains, "MAX_BLOCK", 64)
    monkeypatch.setattr(chains, "FAN", fan)
    n = 2000
    # neighbours are written by different tasks
    scattered = F.pmod(F.col("id") * 37, F.lit(n)) * 3
    nodes = joined_late.range(0, n, 1, 6).select((F.col("id") % 2).alias("g"), scattered.alias("v"))
    expected = {}
    for g in (0, 1):
        values = sorted(i * 37 % n * 3 for i in range(g, n, 2))
        expected |= {(g, v): r for v, r in walk(values, 0, 50, False).items()}
    got = chains.hits(nodes, ["g"], "v", 0, 50, False).collect()
    assert {(r.g, r.v): (r.is_hit, r.hits_before, r.last_hit) for r in got} == expected
    assert len(got) == n


def test_null_groups_and_values(narrow, monkeypatch):
    """Rows without a group or value harm no other chain."""
    monkeypatch.setattr(chains, "MAX_BLOCK", 64)
    monkeypatch.setattr(chains, "FAN", 2)
    values = list(range(0, 1500, 7))
    rows = [("a", v) for v in values] + [(None, v) for v in values] + [("a", None), ("b", None), (None, None), ("c", 5)]
    got = chains.hits(narrow.createDataFrame(rows, "g string, v long"), ["g"], "v", 0, 50, False).collect()
    named = {(r.g, r.v): (r.is_hit, r.hits_before, r.last_hit) for r in got if r.g is not None}
    expected = {(g, v): r for g, vs in (("a", values), ("c", [5])) for v, r in walk(vs, 0, 50, False).items()}
    assert named == expected
    assert sorted(r.v for r in got if r.g is None) == values and not any(r.is_hit for r in got if r.g is None)
