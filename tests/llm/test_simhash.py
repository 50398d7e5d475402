"""Fingerprints, bit-sliced distances and components against plain loops."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401

from logweave.llm import components, simhash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=4):
    """(key, fp) pairs to the smallest key reachable, by comparing everything."""
    fps = sorted({fp for _, fp in prints})
    labels = {f: f for f in fps}

    def root(f):
        while labels[f] != f:
            f = labels[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                labels[max(x, y)] = min(x, y)
    least = {}
    for key, fp in prints:
        r = root(fp)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return {fp: least.get(root(fp)) for fp in fps}


def assert_classes(docs):
    texts = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    classes = plain_classes(texts)
    want = sorted((str(k), f"{fp:016x}", str(classes[fp])) for k, fp in texts)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 40, np.uint64)
    values = np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(5)), base[:3]])
    for _ in range(4):
        values = np.where(rng.random(len(values)) < 0.5, values ^ (np.uint64(1) << rng.integers(0, 64, len(values)).astype(np.uint64)), values)
    got = {(int(a), int(b)) for x, y in simhash.sliced_pairs(values, values, radius, block=37) for a, b in zip(x, y)}
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= radius}
    assert got == want


@pytest.mark.parametrize("n", [100, 10**6, 10**9])
def test_tables_lose_no_pair(n):
    masks = simhash.masks_for(n, 4)
    rng = np.random.default_rng(1)
    for _ in range(500):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(m & flips == 0 for m in masks)


def test_documents(spark):
    assert_classes(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_awkward_and_tiles(spark, awkward, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 20)
    near = spark.range(300).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("lorem ipsum dolor sit amet " * 40), (F.col("id") % 150).cast("string")).alias("text"))
    docs = awkward.unionByName(near, allowMissingColumns=True).withColumn("fp", F.lit("clash"))
    assert_classes(docs)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    classes = plain_classes([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    assert kept.count() == len(set(classes.values()))


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_long_chain(spark):
    """A path and a star: the smallest node must reach the far end."""
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1100).select(F.lit(1050).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r.node: r.component for r in components.connect(chain.unionAll(star)).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{i: 1001 for i in range(1001, 1100)}}
