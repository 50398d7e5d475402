"""Aligned tokens against plain loops over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from logweave.llm import alignment

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TOKENIZER, MODEL = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
TOKENIZER.encode_special_tokens = True
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTER = {chr(b if b in PRINTABLE else 256 + [x for x in range(256) if x not in PRINTABLE].index(b)): b for b in range(256)}


def tokens(text):
    """[(id, bytes)] of both sides, or None."""
    if not text:
        return None
    a = [(i, bytes(LETTER[c] for c in TOKENIZER.id_to_token(i))) for i in TOKENIZER.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in MODEL.encode(text):
        piece = MODEL.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None


def groups(text):
    """[(ids of A, ids of B)] between common ends."""
    if (found := tokens(text)) is None:
        return []
    ends = []
    for side in found:
        end, own = 0, []
        for _, piece in side:
            end += len(piece)
            own.append(end)
        ends.append(own)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out = [([], []) for _ in cuts]
    for k in (0, 1):
        g = 0
        for (i, _), end in zip(found[k], ends[k]):
            while end > cuts[g]:
                g += 1
            out[g][k].append(i)
    return out


def plain(rows):
    """rows: (doc_id, text)"""
    per, counts, best = [], Counter(), defaultdict(int)
    for doc_id, text in rows:
        found = groups(text)
        links = Counter((x, y) for a, b in found for x in a for y in b)
        counts.update(links.keys())
        per.append((doc_id, found, links))
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, found, links in per:
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append(
            (doc_id, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), sum(links.values()))
            + (sum(n for (x, y), n in links.items() if counts[x, y] == best[x]), sum(n * counts[p] for p, n in links.items()))
            + (hashlib.sha256(line.encode()).hexdigest() if line else "",)
        )
    return out


def same(report, rows):
    assert Counter(map(tuple, report.collect())) == Counter(plain(rows))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(entry_module.queries()["op13_token_alignment"](spark, SF_DIR), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


ODD = ["", " ", "  x", "a  b", "a\n  b", "a \n b\n", "\n", "x\n\n y ", "<|endoftext|> <s>x</s>", "▁x", "a▁b c", "日本語 テキスト", "naïve café", "é", "🙂🙂 👩‍👩‍👧", "\x1c a\x1d b", "a b", "a　 b", "don't we'll", "x=1;\r\n\ty", "\x00", "123456 7", "Ω" * 50, "퟿�"]


def test_odd_texts(spark, awkward):
    rng, pieces = random.Random(7), [" ", "  ", "\n", "\t", "\r\n", "a", "the", "▁", "<s>", "日", "é", "!", "\x1c", " ", "'s", "10", "🙂"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(r.doc_id, r.text) for r in awkward.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("clash")).withColumn("row", F.lit(0))
    same(alignment.alignment_report(docs, A, B), rows)
    # few common pairs: nearly all counts come by the join
    same(alignment.alignment_report(docs, A, B, common=5), rows)
    same(alignment.alignment_report(docs, A, B, common=0), rows)


def test_groups_as_text(spark):
    rows = [(1, "naïve tokenization"), (2, "x")]
    found = {r.doc_id: r.groups for r in alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B, with_groups=True).collect()}
    assert found == {i: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups(t)) for i, t in rows}


def test_broken_bytes(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text union all select 2L, 'ab'")
    found = {r.doc_id: r for r in alignment.alignment_report(docs, A, B).collect()}
    assert (found[1].n_a, found[1].groups_sha256) == (0, "") and found[2].n_a > 0


def test_nothing(spark, empty):
    assert alignment.alignment_report(empty, A, B).collect() == []


def test_labels_by_doubling():
    rng = np.random.default_rng(2)
    for _ in range(200):
        end = int(rng.integers(1, 60))
        cut = lambda: np.array(sorted({*rng.integers(1, end + 1, rng.integers(0, end + 1)).tolist(), end}))
        a, b = cut(), cut()
        of_a, of_b, n = alignment.group_labels(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert n == len(common)
        assert of_a.tolist() == np.searchsorted(common, a).tolist() and of_b.tolist() == np.searchsorted(common, b).tolist()


@pytest.mark.parametrize("wide", [0, 2, 1 << 16])
def test_wide_groups(monkeypatch, wide):
    monkeypatch.setattr(alignment, "WIDE", wide)
    of_a, of_b = np.array([0, 0, 0, 1, 2, 2]), np.array([0, 1, 1, 2, 2, 2])
    a, b, doc = np.array([5, 5, 6, 7, 8, 9]), np.array([1, 2, 2, 3, 3, 4]), np.array([0, 0, 3])
    keys, n = alignment.linked_pairs(doc, a, b, of_a, of_b, 3)
    want = Counter((int(doc[g]), int(x), int(y)) for g in range(3) for x in a[of_a == g] for y in b[of_b == g])
    assert {(k >> 40, k >> 20 & 0xFFFFF, k & 0xFFFFF): c for k, c in zip(keys.tolist(), n.tolist())} == want
