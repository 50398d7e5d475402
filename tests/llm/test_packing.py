"""Packed sequences: pieces against the tokenizer, places, how full sequences are, the plan by itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from logweave.llm import packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(docs, limit=2048, end=0):
    tokenizer, out = Tokenizer.from_file(WORD), []
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [end]
        for i, start in enumerate(range(0, len(ids), limit)):
            part = np.array(ids[start : start + limit], "<u4")
            out.append((r.doc_id, i, start, len(part), zlib.crc32(part.tobytes())))
    return out


def check(rows, want, limit=2048):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= limit
    least = -(-sum(r.length for r in rows) // limit)
    return len(sequences), least


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n, least = check(entry_module.queries()["op12_packed_sequences"](spark, SF_DIR).collect(), plain_pieces(docs))
    assert n <= least + max(1, least // 200)


def test_awkward(spark, awkward):
    docs = awkward.withColumn("length", F.lit("clash")).withColumn("task", F.lit(1))
    packed = packing.pack(docs, WORD, 0, 100, by_word=True)
    n, least = check(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), plain_pieces(awkward, 100), 100)
    assert n <= least + 1
    whole = packing.sequences(packed).collect()
    assert len(whole) == n and all(len(r.ids) == 4 * r.length and r.offsets[0] == 0 and len(r.doc_ids) == len(r.offsets) for r in whole)
    assert sum(r.length for r in whole) == sum(p[3] for p in plain_pieces(awkward, 100))


def test_nothing(spark, empty):
    assert packing.pack(empty, WORD, 0, 2048, by_word=True).collect() == []


def one_by_one(counts, limit):
    """The method without repetition: a sequence at a time."""
    left, n = counts.copy(), 0
    while left.any():
        packing.fill(left, limit)
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_uses_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, np.int64), minlength=41)
    patterns = packing.plan(counts, 40)
    used = Counter()
    for times, pieces in patterns:
        assert 0 < sum(x * n for x, n in pieces) <= 40
        used.update({x: times * n for x, n in pieces})
    assert used == Counter(lengths)
    places = packing.Places.of(patterns, 40)
    spans = defaultdict(list)
    for x, n in used.items():
        for s, o in zip(*places.find(np.full(n, x), np.arange(n))):
            spans[int(s)].append((int(o), x))
    assert sorted(spans) == list(range(sum(t for t, _ in patterns)))
    for pieces in spans.values():
        assert [o for o, _ in sorted(pieces)] == [int(x) for x in np.cumsum([0, *(x for _, x in sorted(pieces))])[:-1]]


def test_two_replace_the_smallest():
    # greedily 60 + 30, gap 10; 30 goes back for 20 + 20, which fit exactly
    left = np.bincount([60, 30, 21, 19], minlength=101)
    assert packing.fill(left, 100) == {60: 1, 21: 1, 19: 1} and left[30] == 1


def test_as_many_as_one_by_one():
    rng = random.Random(3)
    for _ in range(20):
        counts = np.bincount([min(200, int(rng.lognormvariate(3.5, 1)) + 1) for _ in range(400)], minlength=201)
        patterns = packing.plan(counts, 200)
        least = -(-int((counts * np.arange(201)).sum()) // 200)
        assert least <= sum(t for t, _ in patterns) <= max(one_by_one(counts, 200), least) + 1
