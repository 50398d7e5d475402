"""Repeated strings against a dictionary of all of them."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401

from logweave.llm import suffixes


def plain(texts, length):
    seen = Counter(hash(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[hash(t[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def assert_removed(docs, length, winnow, clean=True):
    rows = docs.collect()
    want = plain([(r.text or "").encode() for r in rows], length)
    got = suffixes.remove_repeats(docs, length, winnow).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in got) == sorted(str((r.doc_id, *w)) for r, w in zip(rows, want))
    assert any(w[1] for w in want)


def made(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("alphabet,length,winnow", [("abcdefghij ", 40, 17), ("ab", 60, 30), ("é\u0000a", 40, 32)])
def test_mixed_texts(spark, monkeypatch, alphabet, length, winnow):
    """Passages of many lengths between other text, in buckets small enough to be several."""
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffixes, "SAMPLE_ONE_IN", 1)
    rng = random.Random(length)
    shared = [made(rng, alphabet, rng.randrange(10, 150)) for _ in range(12)]
    texts = ["".join(rng.choice(shared) if rng.random() < 0.5 else made(rng, alphabet, rng.randrange(5, 90)) for _ in range(rng.randrange(9))) for _ in range(80)]
    texts += [texts[0] * 3, "a" * 300, "ab" * 200, "", None, "a" * (length - 1), texts[1], texts[1]]
    docs = spark.createDataFrame([(i if i < 86 else 85, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert_removed(docs.withColumn("start", F.lit("clash")), length, winnow)


def test_hot_passage_is_dealt_over_buckets(spark, monkeypatch):
    """More suffixes with the same leading bytes than a bucket takes: compared across boundaries."""
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(suffixes, "SAMPLE_ONE_IN", 1)
    rng = random.Random(1)
    passage = made(rng, "abcdefgh", 75)
    texts = [made(rng, "xyz", rng.randrange(60)) + passage[rng.randrange(12) :] + made(rng, "uvw", rng.randrange(60)) for _ in range(150)]
    assert_removed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 60, 20)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 500)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    rng = random.Random(2)
    long = made(rng, "abcdef", 4000)
    texts = [long, made(rng, "abcdef", 300) + long[1000:1900] + made(rng, "abcdef", 50), long[2500:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    small = [[a for a in suffixes.anchors([t.encode()], 100, 50)] for t in texts]
    assert all(sum(a.last - a.first + 1 for a in s) == len(t) - 99 for s, t in zip(small, texts))
    want = plain([t.encode() for t in texts], 100)
    found = [a for t in texts for a in suffixes.anchors([t.encode()], 100, 50)]
    hits = suffixes.repeated_strings([a.buffer[a.first : a.at] for a in found], [a.buffer[a.at : a.last + 100] for a in found], 100)
    assert hits.sum() > 2000 and docs.count() == len(want)


def test_multikey_quicksort():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 3, (3000, 5)).astype(np.uint64)
    order = suffixes.multikey_quicksort(keys)
    assert sorted(order.tolist()) == list(range(3000))
    assert [tuple(r) for r in keys[order]] == sorted(map(tuple, keys))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").where("doc_id % 3 = 0")
    assert_removed(docs, suffixes.LENGTH, suffixes.WINNOW)


def test_awkward(spark, awkward, empty):
    got = suffixes.remove_repeats(awkward).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[6].n_removed == by[6].n_bytes and by[7].n_removed == by[7].n_bytes and by[5].n_removed == 0
    assert suffixes.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(awkward.withColumn("kept", F.lit(1)))
