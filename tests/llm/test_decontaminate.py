"""Phrase and proximity matches against plain loops."""

import hashlib
import re

from pyspark.sql import functions as F
from rows import awkward, empty  # noqa: F401

from logweave.llm import decontaminate


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain(text, items, width):
    w, hit, names = words(text), set(), set()
    for item_id, item in items:
        t = words(item)
        n = min(width, len(t))
        for s in range(max(len(t) - width + 1, 1) if t else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == t[s : s + n]:
                    hit.update(range(p, p + n))
                    names.add("" if item_id is None else str(item_id))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "word"),
    (3, None),
    (4, "... !"),
    (10, "a B c d e f g h a b c d e"),
    (11, "Fox jumps over THE lazy dog and the quick"),
    (None, "wörds and"),
]


def test_phrases(spark, awkward):
    texts = ["the Quick brown-fox jumps over the lazy dog and the quick brown fox", "quick brown fox jumps over the lazy", "dog lazy the over"]
    docs = awkward.union(spark.createDataFrame([(50 + i, t, "", "", 0) for i, t in enumerate(texts)], awkward.schema))
    docs = docs.withColumn("term", F.lit("clash")).withColumn("__n", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination_report(docs, items, width=7).collect()
    want = [(r.doc_id, *plain(r.text, ITEMS, 7)) for r in docs.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)
    clean = decontaminate.keep_clean(docs, items, width=7)
    assert clean.columns == docs.columns and clean.count() == sum(not x[5] for x in want)


def test_empty_sides(spark, awkward, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination_report(empty, items).count() == 0
    clean = decontaminate.contamination_report(awkward, items.limit(0)).collect()
    assert len(clean) == awkward.count() and not any(r.contaminated for r in clean)


def test_proximity(spark):
    texts = ["x a y y b z", "a y y y y y b", "b a a b", "c only", None]
    docs = decontaminate.keyed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    index = decontaminate.postings(docs)
    found = decontaminate.proximity(index, spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, ["a", "nowhere"])], "query_id long, terms array<string>"), 3)
    got = {(r.query_id, int(r["__key"].split(":")[0])) for r in found.collect()}
    assert got == {(1, 0), (1, 2), (2, 3)}
