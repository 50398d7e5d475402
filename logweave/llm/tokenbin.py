"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

File ``part-N.rec``: records ``length (u64) | masked checksum of length (u32) | payload | masked
checksum of payload (u32)``, little-endian. Payload: ``flags (u8) | doc_id (i64) | ids``, with ids
as u16 where the vocabulary has at most 65,536 entries and u32 otherwise. Flags: bit 0, the doc_id
is null; bit 1, ids are u32. File ``part-N.idx``: one entry ``doc_id (i64) | offset (u64) | ids
(u32)`` per record, then the masked checksum of the entries. Checksums are CRC-32, masked by
rotation and an offset so that a checksum of stored checksums stays useful.

Files are in ascending doc_id order over all parts, null first, rows of one doc_id by text. A task
writes under a name of its own and then moves the file into place, so a repeated or a second
attempt leaves the same file. Paths may be any that ``pyarrow.fs`` opens, and must be shared.

Edge cases: a null text is empty and gets the end id only; texts of any length are encoded whole;
an empty table writes no record; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm.common import parts_for, python_ready, stage, text_bytes

#: Text bytes behind one file, and entries of a worker's word cache.
PART_BYTES, CACHE_WORDS = 16 << 20, 400_000
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("n", "<u4")])
#: Fixed value of the masking rule.
MASK_DELTA = 0xA282EAD8


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return struct.pack("<I", ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF)


class CorruptRecord(ValueError):
    pass


def checked(data: bytes, checksum: bytes, what: str) -> bytes:
    if masked(data) != checksum:
        raise CorruptRecord(what)
    return data


def byte_letters() -> dict[int, int]:
    """The letter that byte-level tokenizers write for each byte: printable bytes are themselves,
    the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: b for b in printable}, **{b: 256 + i for i, b in enumerate(rest)}}


LETTERS = byte_letters()
#: Words that case folding and splitting leave whole: Latin letters, then punctuation marks or none.
PLAIN = re.compile("([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)([.,;:!?]*)")


class Words(dict):
    """Word to its ids as bytes, filled on demand."""

    def __init__(self, encoder: Encoder, older: dict[bytes, bytes]):
        self.encoder, self.older = encoder, older

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.older.get(word)) is None:
            ids = self.encoder.word_ids(word)
        self[word] = ids
        return ids


class Encoder:
    """Ids of a text. Tokens of a whitespace-dropping tokenizer never cross white space, so words are
    encoded once and their ids reused. The cache has two generations of CACHE_WORDS: a word found in
    the older one moves to the younger one, and when that is full the older one is forgotten.

    Most words are plain: lower-casing, normalisation and splitting leave the letters whole. For
    them the tokenizer's merges are asked directly, which takes a fifth of the time, provided that
    this gives the tokenizer's own ids for the probes."""

    probes = ["word", "Word.", "ÀÖØöøįéß", "Don", "end...", "mixedCASE,", "ÿñ?!", "a", "lllmeevett"]

    def __init__(self, path: str, by_word: bool):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.by_word = by_word
        self.words = Words(self, {})
        self.short = by_word and all(self.directly(PLAIN.fullmatch(p)) == self.whole(p) for p in self.probes)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def merged(self, part: str) -> list[int]:
        return [t.id for t in self.merges.tokenize(part.encode().decode("latin-1").translate(LETTERS))]

    def directly(self, found: re.Match) -> list[int]:
        letters, marks = found.groups()
        return self.merged(letters.lower()) + (self.merged(marks) if marks else [])

    def encode(self, text: str) -> list[int]:
        found = PLAIN.fullmatch(text) if self.short else None
        return self.directly(found) if found else self.whole(text)

    def word_ids(self, word: bytes) -> bytes:
        return array(self.code, self.encode(word.decode("utf-8", "replace"))).tobytes()

    def ids(self, text: bytes) -> array:
        if not self.by_word:
            return array(self.code, self.whole(text.decode("utf-8", "replace")))
        return array(self.code, b"".join(self.of_words(text.split())))

    def of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        if len(self.words) > CACHE_WORDS:
            self.words = Words(self, dict(self.words))
        return list(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str, by_word: bool) -> Encoder:
    return Encoder(path, by_word)


def record(doc_id: int | None, ids: array) -> bytes:
    flags = (doc_id is None) | (ids.itemsize == 4) << 1
    payload = struct.pack("<Bq", flags, doc_id or 0) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, masked(length), payload, masked(payload)))


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9)


def store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def put(files: fs.FileSystem, source: str, target: str) -> None:
    """Move a finished file into place; another attempt may have been first with the same bytes."""
    try:
        files.move(source, target)
    except OSError:
        if files.get_file_info(target).type == fs.FileType.NotFound:
            raise
        files.delete_file(source)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, by_word: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all rows of ``docs`` below ``path``; returns the manifest (part, n_records, n_tokens).

    ``by_word`` may be set for tokenizers that drop white space."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("__key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    parts = parts_for(text_bytes(docs, text), PART_BYTES)
    ranged = rows.repartitionByRange(parts, "__key").sortWithinPartitions("__key", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mine = TaskContext.get().partitionId(), uuid.uuid4().hex
        encode = encoder(tokenizer, by_word)
        files, base = store(path)
        files.create_dir(base)
        index, offset, tokens = [], 0, 0
        with files.open_output_stream(f"{base}/.{mine}.rec") as out:
            for batch in batches:
                for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encode.ids(body.as_py())
                    ids.append(end_id)
                    framed = record(doc_id, ids)
                    out.write(framed)
                    index.append((doc_id or 0, offset, len(ids)))
                    offset += len(framed)
                    tokens += len(ids)
        entries = np.array(index, INDEX).tobytes()
        with files.open_output_stream(f"{base}/.{mine}.idx") as out:
            out.write(entries + masked(entries))
        for kind in ("rec", "idx"):
            put(files, f"{base}/.{mine}.{kind}", f"{base}/part-{part:06d}.{kind}")
        yield pa.record_batch([pa.array([x], pa.int64()) for x in (part, len(index), tokens)], ["part", "n_records", "n_tokens"])

    return stage(ranged.mapInArrow(run, "part long, n_records long, n_tokens long"), "manifest")


def read_index(files: fs.FileSystem, name: str) -> np.ndarray:
    with files.open_input_stream(name) as source:
        data = source.read()
    return np.frombuffer(checked(data[:-4], data[-4:], name), INDEX)


def read_at(files: fs.FileSystem, name: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset: for reads in any order."""
    with files.open_input_file(name) as source:
        source.seek(offset)
        return next(frames(source, name))


def frames(source, name: str) -> Iterator[tuple[int | None, np.ndarray]]:
    while head := source.read(12):
        (length,) = struct.unpack("<Q", checked(head[:8], head[8:], f"{name}: length"))
        body = source.read(length + 4)
        yield parse(checked(body[:-4], body[-4:], f"{name}: payload"))


def read(spark: SparkSession, path: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every record of the files: doc_id, start (ids of all records before it), n_tokens,
    ids_crc32 and, if asked for, the ids. The manifest has one row per file."""
    python_ready(spark)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "starts")
    files_of = starts.select("part", "base").repartition(max(1, starts.count()), "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(path)
        for batch in batches:
            for part, start in zip(*(c.to_pylist() for c in batch.columns)):
                name, rows = f"{base}/part-{part:06d}", []
                index = read_index(files, f"{name}.idx")
                with files.open_input_stream(f"{name}.rec") as source:
                    for entry, (doc_id, ids) in zip(index, frames(source, name), strict=True):
                        if entry["n"] != len(ids) or entry["doc_id"] != (doc_id or 0):
                            raise CorruptRecord(f"{name}: index")
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, start, len(ids), crc, *([ids.tolist()] * with_ids)))
                        start += len(ids)
                        if len(rows) == 4096:
                            yield as_batch(rows)
                            rows = []
                yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)]
        return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return files_of.mapInArrow(run, schema)
