"""Token files: exact round trip, order, checksums, random access, cached words."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from rows import SF_DIR, awkward, empty  # noqa: F401
from tokenizers import Tokenizer

from logweave.llm import tokenbin
from logweave.session import new_dir

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def round_trip(spark, docs, path, by_word):
    target = new_dir(spark, "tokens")
    manifest = tokenbin.write(docs, target, path, 2, by_word)
    rows = tokenbin.read(spark, target, manifest, with_ids=True).collect()
    return target, manifest, rows


def plain(docs, path):
    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("path,by_word", [(WORD, True), (WORD, False), (BYTE, False)])
def test_round_trip(spark, awkward, path, by_word):
    docs = awkward.where("doc_id is null or doc_id <> 7").withColumn("start", F.lit("clash"))
    _, _, rows = round_trip(spark, docs, path, by_word)
    want = plain(docs, path)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    target, manifest, rows = round_trip(spark, docs, WORD, True)
    want = plain(docs, WORD)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    files, base = tokenbin.store(target)
    by_id = {r[0]: r[4] for r in want}
    parts = [r.part for r in manifest.where("n_records > 0").collect()]
    for part in random.Random(1).sample(parts, 3):
        name = f"{base}/part-{part:06d}"
        index = tokenbin.read_index(files, f"{name}.idx")
        for entry in random.Random(part).sample(list(index), 5):
            doc_id, ids = tokenbin.read_at(files, f"{name}.rec", int(entry["offset"]))
            assert doc_id == entry["doc_id"] and ids.tolist() == by_id[doc_id]


def test_words_apart_give_the_same_ids():
    rng, encode = random.Random(5), tokenbin.Encoder(WORD, True)
    pieces = ["don't", "'s", "́", "é", "ΟΔΟΣ", "İ", "<|endoftext|>", "a<|startoftext|>b", " ", "x y", "\x1c", "12", "日本", "퟿", "#$", "ͅ", "ß"]
    for _ in range(500):
        text = "".join(rng.choice(pieces + [" ", "\n", "\t", "\x0b ", "\r\n"]) for _ in range(12))
        assert encode.ids(text.encode()).tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_damage_is_found(tmp_path):
    files = fs.LocalFileSystem()
    good = tokenbin.record(5, tokenbin.array("H", [1, 2, 3]))
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 4
        (tmp_path / "x").write_bytes(bad)
        with pytest.raises((tokenbin.CorruptRecord, OSError)):
            tokenbin.read_at(files, str(tmp_path / "x"), 0)


def test_nothing(spark, empty):
    _, manifest, rows = round_trip(spark, empty, WORD, True)
    assert rows == [] and not manifest.agg(F.sum("n_records")).first()[0]
