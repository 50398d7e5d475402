"""Near copies by word shingles against sets of tuples, all pairs compared."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401

import corpus_pipeline
from logweave.llm import shingles


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    if 4 * max(len(a), len(b)) > 5 * min(len(a), len(b)):
        return False
    common = len(a & b)
    return 5 * common >= 4 * (len(a) + len(b) - common)


def plain_kept(rows):
    """Rows (key, text) without null keys: the smallest keys of all components."""
    sets, label = [plain_set(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and similar(a, sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return sorted(min(k for (k, _), x in zip(rows, label) if x == c) for c in set(label))


def test_stage_keeps_no_near_copy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("size(split(text, ' ')) >= 20")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == plain_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("frequent", [0, 1000])
def test_border_and_dense_group(spark, monkeypatch, frequent):
    """Similarities on both sides of 0.8, a chain, and a large group of near copies."""
    monkeypatch.setattr(shingles, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(shingles, "FREQUENT", frequent)
    rng = np.random.default_rng(5)
    texts = []
    for base in range(12):
        words = [f"w{base}x{i}" for i in range(int(rng.integers(30, 120)))]
        for _ in range(10):
            texts.append(" ".join(words))
            words = [w if rng.random() > 0.015 else f"n{rng.integers(1 << 40)}" for w in words]
    one = [f"big{i}" for i in range(80)]
    texts += [" ".join([*one[:i], f"other{i}", *one[i + 1 :]]) for i in range(80)] + ["few words", "few words", "", " "]
    order = rng.permutation(len(texts))
    docs = spark.createDataFrame([(int(k), t) for k, t in zip(order, texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in shingles.keep_one(docs).collect()) == plain_kept([(int(k), t) for k, t in zip(order, texts)])


def variants(spark, size, seed=6):
    """Texts of 60 words with one other word each: near copies only of those changed close by."""
    rng = np.random.default_rng(seed)
    base = [f"base{i}" for i in range(60)]
    texts = []
    for i in range(size):
        words = base.copy()
        words[int(rng.integers(60))] = f"new{i}"
        texts.append(" ".join(words))
    return [(i, t) for i, t in enumerate(texts)]


def test_candidates_grow_with_the_texts(spark, monkeypatch):
    compared, kept = [], shingles.verified
    monkeypatch.setattr(shingles, "verified", lambda pairs, *rest: compared.append(pairs.count()) or kept(pairs, *rest))
    counts = {}
    for size in (100, 200, 400):
        rows = variants(spark, size)
        compared.clear()
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = sorted(r.doc_id for r in shingles.keep_one(docs).collect())
        if size == 100:
            assert found == plain_kept(rows)
        counts[size] = sum(compared)
    assert counts[400] <= 3 * counts[200] and counts[200] <= 3 * counts[100] and counts[400] < 40 * 400, counts


@pytest.mark.parametrize("tile", [4, 1024])
def test_tiles_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(shingles, "TILE", tile)
    rows = variants(spark, 60, seed=9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in shingles.keep_one(docs).collect()) == plain_kept(rows)


def test_awkward(awkward, empty):
    docs = awkward.withColumn("fp", F.lit("clash"))
    kept = shingles.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({frozenset(plain_set(r.text)) for r in docs.collect()})
    assert shingles.keep_one(empty).count() == 0


def test_fingerprints_link_copies_first(spark, monkeypatch):
    """Copies with nearly equal fingerprints are joined by the bit-sliced comparison; no rule but similarity joins them."""
    base = [f"word{i}" for i in range(400)]
    texts = [" ".join([*base[:i], f"other{i}", *base[i + 1 :]]) for i in range(0, 400, 40)] + ["quite another text of some words"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, kept = [], shingles.simhash.links
    monkeypatch.setattr(shingles.simhash, "links", lambda prints, *rest: seen.append(kept(prints, *rest)) or seen[-1])
    assert sorted(r.doc_id for r in shingles.keep_one(docs).collect()) == plain_kept(rows) == [0, 10]
    assert len(seen) == 1 and seen[0].count() > 0
    values = {r.id: r.print for r in shingles.sketches(docs.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("row"), "text")).collect()}
    for i, text in rows:
        items = shingles.shingles(text.encode())
        bits = sum((2 * sum(int(x) >> k & 1 for x in items) > len(items)) << k for k in range(64))
        assert values[i] % (1 << 64) == bits
    pairs = shingles.linked_prints(spark.createDataFrame([(1, 0), (5, 0), (7, 3), (9, -1)], "fp long, print long"))
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(1, 5), (1, 7)]
