"""The audit against plain loops; its SQL is in test_queries."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from rows import awkward, empty  # noqa: F401

from logweave.llm import divergence


def plain(rows, least_docs, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups.add((lang, source))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        of = {s: counts[lang, s] for x, s in groups if x == lang}
        everything = sum(of.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept))

        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, c in of.items():
            pair = [(-sum(f(share(c, t), share(d, t)) for t in kept), o.encode()) for o, d in of.items() if o != s]
            term = [(-f(share(c, t), share(everything, t)), t.encode()) for t in kept if c[t] and share(c, t) > share(everything, t)]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return Counter(out)


WORDS = ["alpha", "Beta", "gamma", "ÄÖ", "x", "日本", "delta", "eps", "zeta", "é"]


def some_rows(n=300):
    import random

    rng = random.Random(4)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "b", "ß", None, "hot", "hot", "hot"])
        text = rng.choice([" ", "-", "9", "\n"]).join(rng.choice(WORDS) for _ in range(rng.randrange(0, 12)))
        rows.append((text, rng.choice(["en", "de", None]), source))
    return rows + [("", "xx", "s"), ("rare", "xx", "t"), (None, "yy", "only")]


@pytest.mark.parametrize("block,chunk", [(400_000, 2_000), (7, 3), (1, 1)])
def test_small_blocks_and_chunks(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "PENDING", block)
    rows = some_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    for c in ("value", "rank", "shard", "term", "n"):
        docs = docs.withColumn(c, F.lit("clash"))
    assert Counter(map(tuple, divergence.audit(docs, least_docs=10, top=4).collect())) == plain(rows, 10, 4)


def test_awkward(spark, awkward):
    rows = [(r.text, r.lang, r.source) for r in awkward.collect()]
    assert Counter(map(tuple, divergence.audit(awkward, least_docs=1, top=10).collect())) == plain(rows, 1, 10)


def test_nothing(spark, empty):
    assert divergence.audit(empty).collect() == []


def test_merge_of_runs():
    blocks, want = [], defaultdict(Counter)
    for i, (text, lang, source) in enumerate(some_rows(60)):
        if i % 7 == 0:
            blocks.append(divergence.Block(5))
        blocks[-1].add((lang or "").encode(), (source or "").encode(), (text or "").encode())
        for t in divergence.terms((text or "").encode()):
            want[(lang or "").encode() + b"\xff" + t][(source or "").encode()] += 1
    chunks = [c for b in blocks for c in b.run()]
    found = [(key, Counter(dict(zip(sources, n)))) for key, _, sources, n in divergence.merged(sorted(chunks))]
    assert len(found) == len(want) and dict(found) == want and all(b.size == 0 for b in blocks)


def test_large_counts_are_exact(spark):
    n, total, kept = 30_000_000_000_123, 41_000_000_000_457, 9_999_999
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p"), divergence.share(F.lit(0), F.lit(0), F.lit(0)).alias("none")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * kept) and row.none is None
