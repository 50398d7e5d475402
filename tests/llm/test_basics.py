"""Sharding, mixing and quality rules: by hand-written loops on awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401

from logweave.llm import mixing, quality, sharding


def jump(key, shards):
    state, home, at = key % 2**64, -1, 0
    while at < shards:
        home = at
        state = (state * 2862933555777941757 + 1) % 2**64
        at = int((home + 1) * (float(1 << 31) / ((state >> 33) + 1)))
    return home


def test_jump_hash_is_the_published_one():
    keys = np.array([0, 1, 2, 10, 2**62, -1, -(2**63)] + list(range(1000, 1500)), np.int64)
    for shards in (1, 2, 40, 41, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


def test_shards(spark, awkward, monkeypatch):
    monkeypatch.setattr(sharding, "SLICE_ROWS", 3)
    rows = sharding.shard_documents(awkward.withColumn("shard", F.lit("clash")), 4).collect()
    assert len(rows) == awkward.count()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        key = sharding.NULL_KEY if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (jump(key, 4), jump(key, 5))
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in awkward.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts


def test_shards_of_nothing(empty):
    assert sharding.shard_documents(empty, 4).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(empty.withColumn("shard", F.lit(1)), "doc_id", 3)


def water(sizes, weights, most):
    """Clamp one at a time."""
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in clamped)
        share = {s: left * weights[s] / sum(weights[t] for t in sizes if t not in clamped) for s in sizes if s not in clamped}
        above = [s for s in share if share[s] > most * sizes[s]]
        if not above:
            return share | {s: most * sizes[s] for s in clamped}
        clamped.add(above[0])


def test_mixing(spark, awkward):
    rows = mixing.mix_report(awkward, [50, 2, 1], 3).collect()
    assert len(rows) == awkward.count()
    sizes = Counter()
    for r in awkward.collect():
        sizes[r.source] += len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    targets = water(sizes, {s: [50, 2, 1][i % 3] for i, s in enumerate(order)}, 3)
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    largest = {s: max(r.size for r in rows if r.source == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(awkward.repartition(5), [50, 2, 1], 3).collect()))


def test_mixing_of_billions_of_words(spark):
    """Sums below 2^31 whose product with a weight is above."""
    rows = [(i, 1_000_000 * (1 + i % 7), "abc"[i % 3]) for i in range(300)]
    sized, weights = spark.createDataFrame(rows, "doc_id long, size long, source string"), [5, 2, 1]
    sizes = {s: sum(n for _, n, own in rows if own == s) for s in "abc"}
    targets = water(sizes, dict(zip("abc", weights)), 3)
    assert sum(sizes.values()) < 2**31 < 5 * sum(sizes.values()) and max(targets.values()) > 2**29
    found, taken = mixing.repetitions(sized, weights, 3, 0).collect(), Counter()
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.size * r.copies
    assert all(abs(taken[s] - targets[s]) <= 7_000_000 for s in sizes)


def test_mixing_whole_rows(awkward, empty):
    mixed = mixing.mix(awkward, [1], 3)
    assert mixed.columns == awkward.columns
    want = {(r.doc_id, r.size): r.copies for r in mixing.mix_report(awkward, [1], 3).collect() if r.doc_id in (4, 8)}
    got = Counter(r.doc_id for r in mixed.where("doc_id in (4, 8)").collect())
    assert {k[0]: v for k, v in want.items() if v} == dict(got)
    assert mixing.mix(empty, [1], 3).count() == 0 and mixing.mix_report(empty, [5, 2, 1], 3).count() == 0


def repeated(words, width=8):
    seen = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    return len({p for i in range(len(words) - width + 1) if seen[tuple(words[i : i + width])] > 1 for p in range(i, i + width)})


def test_counts(spark, awkward):
    extra = spark.createDataFrame([(100 + i, " ".join("abcab"[(i * j) % 5] for j in range(40 + i)) + "\nl\n\n l\nl", "", "", 0) for i in range(30)], awkward.schema)
    for r in quality.quality_report(awkward.union(extra)).join(awkward.union(extra).select("doc_id", "text").distinct(), "doc_id").collect():
        text = r.text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_verdicts_follow_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = quality.quality_report(docs).where("not base_failed").join(labels, "doc_id")
    rate = {r.quality: r.rate for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.1


def test_keep_good(spark, awkward, empty):
    clash = awkward.withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(1.5))
    kept = quality.keep_good(clash)
    assert kept.columns == clash.columns
    failed = {r.doc_id for r in quality.quality_report(awkward).where("base_failed").collect()}
    assert not {r.doc_id for r in kept.collect()} & failed
    assert quality.keep_good(empty).count() == 0 and quality.quality_report(empty).count() == 0
    with pytest.raises(ValueError):
        quality.features(clash)
