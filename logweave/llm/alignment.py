"""Tokens of two tokenizers over the same bytes, aligned by pointer jumping.

A text is encoded with a leading blank by tokenizer A (byte-level BPE) and tokenizer B (pieces, which
adds the blank itself). Every token points to the token of the other side that overlaps it and
reaches farthest to the right, if that reaches farther than itself; where both sides end together the
token of A is the end. Doubling the pointers of all tokens of many texts at once, as arrays, leads
every token to the last one of its group, which labels the group: both sides' tokens between two byte
offsets where tokens of A and of B end. All pairs of a token of A and one of B in a group are links.

The count of a pair of ids is the number of documents that link it. Pairs from a count on that leaves
at most ``COMMON`` of them are broadcast; all others go through a join.

Encoding asks the tokenizers once for every stretch between blanks: neither joins bytes across a
blank that follows other than white space (no piece of B may, which is checked for the vocabulary).

Edge cases: a text that is null, empty, not valid UTF-8, or that a tokenizer does not give back byte
for byte has no tokens, its numbers are 0 and its groups ''; names of special tokens inside texts are
plain text; texts of any length are aligned whole; equal rows count as a document each; a null doc_id
stays null; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import python_ready, small_batches, stage
from logweave.llm.tokenbin import LETTERS

#: Stretches that a worker remembers, twice; text bytes aligned in one step; pairs that are broadcast.
CACHE, STEP_BYTES, COMMON = 150_000, 1 << 20, 1 << 20
#: A pair of ids in one number: A's times 2^20, plus B's.
SHIFT = 20
#: Groups of more links than this are counted by their different ids.
WIDE = 1 << 16
#: Stands for a stretch that the tokenizer does not give back.
LOST = np.uint32(0xFFFFFFFF).tobytes()
ODD = re.compile(r"\s\s|^\s")
STRETCH = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+")
BLANK = "▁"


def stretches(text: str) -> list[str]:
    """A text cut at every blank that follows other than white space, without those blanks."""
    return [x[1:] for x in STRETCH.findall(" " + text)] if ODD.search(text) else text.split(" ")


class Side(dict):
    """Stretch to the ids of a blank and the stretch, filled on demand. Stretches found in the older
    generation move to the younger one; when that is full the older one is forgotten."""

    def __init__(self, pieces: list[bytes], encode):
        self.pieces, self.encode, self.older = pieces, encode, {}
        self.lengths = np.array([*map(len, pieces)], np.int32)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def __missing__(self, stretch: str) -> bytes:
        if (ids := self.older.get(stretch)) is None:
            found = self.encode(stretch)
            ids = np.array(found, np.uint32).tobytes() if self.joined(found) == b" " + stretch.encode() else LOST
        self[stretch] = ids
        return ids

    def ids(self, text: str, parts: list[str]) -> np.ndarray | None:
        """Of a whole text; None if its bytes are not given back."""
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()
        found = np.frombuffer(b"".join(map(self.__getitem__, parts)), np.uint32)
        if len(found) and found.max() == 0xFFFFFFFF:  # then only the whole can tell
            whole = self.encode(text)
            return np.array(whole, np.uint32) if self.joined(whole) == b" " + text.encode() else None
        return found


def byte_level(path: str) -> Side:
    """A byte-level vocabulary of the tokenizers library."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = {chr(c): b for b, c in LETTERS.items()}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
    pieces = [bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode() for name in names]
    return Side(pieces, lambda stretch: tokenizer.encode(" " + stretch, add_special_tokens=False).ids)


def with_blanks(path: str) -> Side:
    """A sentencepiece model that puts a blank before each text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(BLANK in name.lstrip(BLANK) for name in names):
        raise ValueError(f"{path} has pieces with a blank inside")
    pieces = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(BLANK, " ").encode() for i, name in enumerate(names)]
    return Side(pieces, lambda stretch: model.encode(stretch, num_threads=1))


@lru_cache(maxsize=2)
def both_sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    a, b = byte_level(path_a), with_blanks(path_b)
    if max(len(a.pieces), len(b.pieces)) > 1 << SHIFT:
        raise ValueError(f"vocabularies have more than {1 << SHIFT} ids")
    return a, b


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group number of every token of either side, from 0 in the order of bytes, and their number.
    The ends ascend and both sides end together."""
    n = len(ends_a)
    # the other side's token that holds a token's last byte overlaps it and reaches farthest
    beyond = np.searchsorted(ends_b, ends_a)
    at_end = ends_b[beyond] == ends_a
    to = np.concatenate([np.where(at_end, np.arange(n), n + beyond), np.searchsorted(ends_a, ends_b)]).astype(np.int32)
    while not np.array_equal(further := to[to], to):
        to = further
    number = (np.cumsum(at_end) - 1).astype(np.int32)
    label = number[to]
    return label[:n], label[n:], int(at_end.sum())


def linked_pairs(doc: np.ndarray, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The different (document, pair) of all links as doc << 40 | a << 20 | b, and how many links each
    has. ``doc``: of each group; ``of_a``, ``of_b``: groups of the tokens."""
    n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE
    reps = np.where(wide, 0, n_b)[of_a]
    left = np.repeat(np.arange(len(a)), reps)
    right = np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(first_b[of_a], reps)
    head = doc.astype(np.int64) << 2 * SHIFT
    key, times = np.unique(head[of_a[left]] | a[left].astype(np.int64) << SHIFT | b[right].astype(np.int64), return_counts=True)
    if not wide.any():
        return key, times
    keys, counts = [key], [times]
    for g in np.flatnonzero(wide):
        x, n_x = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        y, n_y = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        keys.append((head[g] | x.astype(np.int64)[:, None] << SHIFT | y.astype(np.int64)).ravel())
        counts.append(np.outer(n_x, n_y).ravel())
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return key, total


class Written:
    """The text form of groups, as bytes: ids by commas, sides by a bar, groups by a semicolon."""

    def __init__(self, ids: int):
        self.pieces, self.ids = [f"{mark}{i}".encode() for mark in ";,|" for i in range(ids)], ids

    def parts(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int) -> list[bytes]:
        """One entry per token, in the order in which they are written."""
        n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        first = lambda of: np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[of_a]] = np.where(first(of_a), 0, self.ids) + a
        out[np.arange(len(b)) + np.cumsum(n_a)[of_b]] = np.where(first(of_b), 2 * self.ids, self.ids) + b
        return list(map(self.pieces.__getitem__, out.tolist()))


def portions(batch: pa.RecordBatch) -> Iterator[list[tuple[int, bytes]]]:
    """(place, text) of the texts of a batch, about STEP_BYTES at a time."""
    some, size = [], 0
    for i, body in enumerate(batch.column(0)):
        text = body.as_py()
        some.append((i, text))
        size += len(text)
        if size > STEP_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """Staged, a row per document: (row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs,
    times): the different pairs of ids that it links and how often, and ``groups`` if asked for."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"))
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>" + ", groups string" * with_groups
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = both_sides(path_a, path_b)
        written = Written(max(len(a.pieces), len(b.pieces)))
        for batch in small_batches(batches):
            found = {n: np.zeros(batch.num_rows, np.int64) for n in numbers}
            texts, digests = [""] * batch.num_rows, [""] * batch.num_rows
            keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for some in portions(batch):
                place, ids_a, ids_b = [], [], []
                for i, body in some:
                    whole = body.decode("utf-8", "replace")
                    if not body or "�" in whole and whole.encode() != body:
                        continue
                    parts = stretches(whole)
                    if (x := a.ids(whole, parts)) is not None and (y := b.ids(whole, parts)) is not None:
                        place.append(i)
                        ids_a.append(x)
                        ids_b.append(y)
                if not place:
                    continue
                place, n_a, n_b = np.array(place), np.array([*map(len, ids_a)]), np.array([*map(len, ids_b)])
                all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
                of_a, of_b, groups = group_labels(np.cumsum(a.lengths[all_a]), np.cumsum(b.lengths[all_b]))
                last = of_a[np.cumsum(n_a) - 1]  # every text ends a group
                doc = np.searchsorted(last, np.arange(groups))
                links = np.bincount(of_a, minlength=groups) * np.bincount(of_b, minlength=groups)
                per = [n_a, n_b, np.diff(last, prepend=-1), np.add.reduceat(links, np.concatenate([[0], last[:-1] + 1]))]
                for name, values in zip(numbers, per):
                    found[name][place] = values
                pair, n = linked_pairs(place[doc], all_a, all_b, of_a, of_b, groups)
                keys.append(pair)
                times.append(n)
                tokens, end = written.parts(all_a, all_b, of_a, of_b, groups), 0
                for i, n in zip(place.tolist(), (n_a + n_b).tolist()):
                    line = b"".join(tokens[end : end + n])[1:]
                    end += n
                    digests[i] = hashlib.sha256(line).hexdigest()
                    if with_groups:
                        texts[i] = line.decode()
            key, n = np.concatenate(keys), np.concatenate(times)
            offsets = pa.array(np.searchsorted(key >> 2 * SHIFT, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (key & (1 << 2 * SHIFT) - 1, n.astype(np.int64))]
            yield pa.record_batch(
                [batch.column(1), batch.column(2), *(pa.array(found[x]) for x in numbers), pa.array(digests, pa.string()), *lists, *[pa.array(texts, pa.string())] * with_groups],
                ["row", "doc_id", *numbers, "groups_sha256", "pairs", "times", *["groups"] * with_groups],
            )

    return stage(rows.mapInArrow(run, schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Staged (pair, docs, best): documents that link a pair, and whether no pair of its id of A has more."""
    counted = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pairs")
    id_a = F.shiftright("pair", SHIFT).alias("id_a")
    most = counted.groupBy(id_a).agg(F.max("docs").alias("most"))
    # one row per id of A: at most 2^SHIFT rows of two numbers
    return stage(counted.withColumn("id_a", id_a).join(F.broadcast(most), "id_a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-counts")


def least_common(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or a larger one."""
    power = F.floor(F.log2("docs") + 1e-9).cast("int")
    held, floor = 0, 64
    for row in counts.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():  # 64 rows at most
        held += row["count"]
        if held > most:
            break
        floor = row["power"]
    return 1 << min(floor, 62)


def with_counts(aligned: DataFrame, counts: DataFrame, common: int = COMMON) -> DataFrame:
    """``aligned`` without its lists, with n_best (links whose pair no other of the id of A exceeds)
    and count_sum (over all links)."""
    floor = least_common(counts, common)
    table = counts.where(F.col("docs") >= floor).toArrow()
    columns = [table.column(x).to_numpy() for x in ("pair", "docs", "best")]
    order = np.argsort(columns[0])
    shared = aligned.sparkSession.sparkContext.broadcast([x[order] for x in columns])
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    schema = aligned.select(*kept).schema.add("n_best", "long").add("count_sum", "long")

    def looked_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = shared.value[0]
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        return at, known[at] == pairs if len(known) else np.zeros(len(pairs), bool)

    def lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs, times = (batch.column(batch.schema.get_field_index(x)) for x in ("pairs", "times"))
        rows = np.repeat(np.arange(batch.num_rows), pairs.value_lengths().to_numpy())
        return rows, pairs.flatten().to_numpy(), times.flatten().to_numpy()

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows, pairs, times = lists(batch)
            at, hit = looked_up(pairs)
            rows, at, times = rows[hit], at[hit], times[hit]
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(best, rows, times * shared.value[2][at])
            np.add.at(total, rows, times * shared.value[1][at])
            yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(best), pa.array(total)], schema.fieldNames())

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows, pairs, times = lists(batch)
            rest = ~looked_up(pairs)[1]
            yield pa.record_batch([batch.column(0).take(pa.array(rows[rest])), pa.array(pairs[rest]), pa.array(times[rest])], ["row", "pair", "times"])

    found = aligned.mapInArrow(known, schema)
    rare = counts.where(F.col("docs") < floor)
    if rare.isEmpty():
        return found
    links = aligned.select("row", "pairs", "times").mapInArrow(unknown, "row long, pair long, times long").join(rare, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more"))
    add = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c)
    return found.join(sums, "row", "left").select(*kept, add("n_best", "more_best"), add("count_sum", "more"))


def alignment_report(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", common: int = COMMON) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = align(docs, path_a, path_b, key, text)
    found = with_counts(aligned, pair_counts(aligned), common)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
