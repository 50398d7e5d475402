"""Near-dedup of the pipeline leaves no large tables behind, and shuffles what it compares once."""

import os

import pytest
from pyspark.sql import functions as F

from logweave.llm import shingles
from logweave.llm.common import drop, stage
from logweave.session import shared_dir


def folders(spark):
    top = f"{shared_dir(spark)}/logweave-{spark.sparkContext.applicationId}"
    return {name.rsplit("-", 1)[0]: name for name in os.listdir(top)} if os.path.isdir(top) else {}


def test_dropped_tables_are_gone(spark):
    kept, gone = (stage(spark.range(3), name) for name in ("scratch-kept", "scratch-gone"))
    drop(gone)
    assert "scratch-kept" in folders(spark) and "scratch-gone" not in folders(spark) and kept.count() == 3


def test_no_sets_left(spark):
    base = [f"word{i}" for i in range(60)]
    texts = [" ".join(base[:i] + [f"new{i}"] + base[i + 1 :]) for i in range(0, 60, 3)] + ["some other words", "some other words", None]
    before = set(folders(spark).values())
    kept = shingles.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    left = {name.rsplit("-", 1)[0] for name in set(folders(spark).values()) - before}
    assert not left & {"sketches", "distinct-sets", "sets", "wanted", "members"}, left
    assert kept.count() >= 2 and kept.where("text is null").count() == 1


def entries(spark):
    """Token 1 to 3 in the same two components, 4 in these and another, 5 in one, 6 in one component twice."""
    rows = [(t, fp, 10, fp) for t in (1, 2, 3) for fp in (7, 8)] + [(4, fp, 10, fp) for fp in (7, 8, 9)] + [(5, 7, 10, 7), (6, 20, 10, 20), (6, 21, 10, 20)]
    return spark.createDataFrame(rows, "token long, fp long, n long, component long")


def test_one_token_of_those_that_the_same_sets_share(spark):
    got = sorted((r.token, r.fp, r.component) for r in shingles.members(entries(spark)).collect())
    assert got == [(1, 7, 7), (1, 8, 8), (4, 7, 7), (4, 8, 8), (4, 9, 9)]


@pytest.mark.parametrize("tile", [4, 1024])
def test_every_pair_is_still_met(spark, monkeypatch, tile):
    monkeypatch.setattr(shingles, "TILE", tile)
    marks = spark.createDataFrame([(fp, bytearray(shingles.MARKS)) for fp in (7, 8, 9, 20, 21)], "fp long, marks binary")
    met = shingles.candidates(shingles.members(entries(spark)).join(marks, "fp"), nearest=False)
    assert sorted(map(tuple, met.select(F.least("a", "b"), F.greatest("a", "b")).collect())) == [(7, 8), (7, 9), (8, 9)]
