"""Line dedup against a loop over all documents, with filters so small that most hashes collide."""

import pytest
from pyspark.sql import functions as F
from rows import awkward, empty  # noqa: F401

from logweave.llm import bloom, lines

SPACE = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(lines.LAST if doc is None else doc)
    out = []
    for doc, text in rows:
        me = lines.LAST if doc is None else doc
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == me]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_lines(spark, awkward, monkeypatch, bits):
    monkeypatch.setattr(bloom, "SEGMENT_BITS", bits)
    extra = [(100 + i, f"  A shared LINE here\t\nown line number {i % 7}\n\nshort\n äöüß äöüß {i % 3}\nshort\x85line ending {i % 2}", "", "", 0) for i in range(60)]
    docs = awkward.union(spark.createDataFrame(extra, awkward.schema)).withColumn("key", F.lit("clash"))
    got = lines.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.text)) for r in got.collect()) == want


def test_nothing(empty):
    assert lines.dedup_lines(empty).count() == 0
    with pytest.raises(ValueError):
        lines.dedup_lines(empty.withColumn("n_lines", F.lit(1)))
