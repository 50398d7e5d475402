"""A topic log as a stream whose position is a map of offsets, with batches bounded by records.

Spark's file stream counts files: a batch is as large as the files of one trigger. Here the position of a
query is ``{topic: {partition: next offset}}``, so a batch ends inside a file if its bound says so, and the
offsets in the checkpoint are those of the log.

    spark.dataSource.register(OffsetStream)
    spark.readStream.format("topic_log").option("path", log).option("pattern", "event.*") \\
        .option("position", shared_folder).option("maxRecords", 100000).load()

Options

* ``path``: the log. What its manifest describes is there (``TopicLog.append`` and ``describe``); planning reads
  new manifest files only and never a log column.
* ``topics`` (comma-separated), ``pattern`` (whole name) or ``assignment`` (JSON ``{topic: [partition]}``): exactly one.
* ``startingOffsets``: ``earliest`` (default), ``latest`` or JSON ``{topic: {partition: offset}}``. Partitions that
  appear later, or are not named, are read from their first entry.
* ``maxRecords``: offsets of one batch in all, shared among partitions by what each has waiting.
* ``maxRecordsPerPartition``: offsets of one batch in each partition.
* ``position``: a folder of this query alone, needed with bounds or another start than ``earliest``. Spark does not tell a Python source where a
  restarted query stands, so the end of each batch is noted there once Spark has logged it.
* ``sliceRecords``: offsets of one task (default 2^17), so a hot partition is read by many tasks.

Bounds count offsets; control entries and gaps take part, so a batch never has more records. Spark's
``availableNow`` asks a Python source once and would end after one bounded batch: use :func:`logweave.streaming.runs.drain`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from logweave.schema import LOG
from logweave.session import ship_package

SLICE_RECORDS = 1 << 17

Position = dict[str, dict[str, int]]

#: The columns stored in the files; topic and partition are folder names.
STORED = pa.schema(
    [
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", "UTC")),
        ("timestampType", pa.int32()),
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))),
        ("txn_id", pa.string()),
        ("is_control", pa.bool_()),
    ]
)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Described:
    """A row of the manifest: one data file."""

    file: str
    topic: str
    partition: int
    first: int
    last: int


@dataclass
class Slice(InputPartition):
    """Offsets ``low`` to ``high`` - 1 of one partition and the files that overlap them."""

    files: list[str]
    topic: str
    partition: int
    low: int
    high: int


def share(waiting: dict, limit: int | None) -> dict:
    """``limit`` offsets among partitions, in proportion to what is ``waiting``; nobody gets more than waits,
    nothing of the limit is left while something waits, so there is progress whatever the limit."""
    total = sum(waiting.values())
    if limit is None or total <= limit:
        return dict(waiting)
    given = {who: limit * n // total for who, n in waiting.items()}
    spare = limit - sum(given.values())
    # fewer than one offset per partition is left: those with the largest fraction lost
    for who in sorted(waiting, key=lambda w: (-(limit * waiting[w] % total), w))[:spare]:
        given[who] += 1
    return given


class OffsetStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        given = [name for name in ("topics", "pattern", "assignment") if options.get(name)]
        if len(given) != 1:
            raise ValueError(f"give exactly one of topics, pattern, assignment (got {given or 'none'})")
        self.path = options["path"].rstrip("/")
        self.topics = set(options["topics"].split(",")) if options.get("topics") else None
        self.pattern = options.get("pattern")
        self.assignment = json.loads(options["assignment"]) if options.get("assignment") else None
        self.starting = options.get("startingoffsets", "earliest")
        self.limit, self.limit_each = (self._bound(options.get(name)) for name in ("maxrecords", "maxrecordsperpartition"))
        self.slice = self._bound(options.get("slicerecords")) or SLICE_RECORDS
        self.note = options.get("position")
        if (self.limit or self.limit_each or self.starting != "earliest") and not self.note:
            raise ValueError("bounds and starting offsets need the option position")
        self.known: dict[tuple[str, int], dict[str, Described]] = {}
        self.ends: dict[tuple[str, int], int] = {}
        self.manifests: set[str] = set()
        self.position: Position | None = None
        self.first: Position | None = None

    @staticmethod
    def _bound(text: str | None) -> int | None:
        if text is None:
            return None
        if int(text) < 1:
            raise ValueError(f"bounds are positive numbers, not {text}")
        return int(text)

    def _selected(self, topic: str, partition: int) -> bool:
        if self.topics is not None:
            return topic in self.topics
        if self.pattern is not None:
            return re.fullmatch(self.pattern, topic) is not None
        return partition in self.assignment.get(topic, ())

    def _learn(self) -> None:
        """Take in the manifest files that came since the last look."""
        system, folder = located(f"{self.path}/_bounds")
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.path in self.manifests or not info.base_name.endswith(".parquet"):
                continue
            rows = pq.read_table(info.path, filesystem=system, columns=["file", "topic", "partition", "first_offset", "last_offset"])
            for row in rows.to_pylist():
                described = Described(*row.values())
                key = (described.topic, described.partition)
                if self._selected(*key):
                    # two writers may describe one file
                    self.known.setdefault(key, {})[described.file] = described
                    self.ends[key] = max(self.ends.get(key, 0), described.last + 1)
            self.manifests.add(info.path)

    @staticmethod
    def _at(position: Position, key: tuple[str, int]) -> int | None:
        return position.get(key[0], {}).get(str(key[1]))

    def _begin(self, position: Position, key: tuple[str, int]) -> int:
        at = self._at(position, key)
        return min((d.first for d in self.known.get(key, {}).values()), default=0) if at is None else at

    @staticmethod
    def _with(position: Position, moved: dict[tuple[str, int], int]) -> Position:
        result = {topic: dict(parts) for topic, parts in position.items()}
        for (topic, partition), offset in moved.items():
            result.setdefault(topic, {})[str(partition)] = offset
        return result

    def initialOffset(self) -> Position:
        """The same at every call, also after a restart: Spark asks for it after the first end."""
        if self.first is None:
            self.first = self._notes("initial")
        if self.first is None:
            self._learn()
            if self.starting == "earliest":
                self.first = {}
            elif self.starting == "latest":
                self.first = self._with({}, self.ends)
            else:
                named = json.loads(self.starting)
                self.first = {t: {str(p): int(o) for p, o in parts.items()} for t, parts in named.items()}
            self._store(self.first, "initial")
        return self.first

    def _notes(self, kind: str) -> Position | None:
        """The newest note of that kind."""
        if not self.note:
            return None
        system, folder = located(self.note)
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(i.path for i in found if i.base_name.startswith(f"{kind}-"))
        if not names:
            return None
        with system.open_input_stream(names[-1]) as file:
            return json.loads(file.read())["position"]

    def _store(self, position: Position, kind: str) -> None:
        """Note ``position``: written apart, then named, so a reader never sees half a note. One older note stays."""
        if not self.note or position == self._notes(kind):
            return
        system, folder = located(self.note)
        system.create_dir(folder, recursive=True)
        names = sorted(i.path for i in system.get_file_info(fs.FileSelector(folder)) if i.base_name.startswith(f"{kind}-"))
        number = int(names[-1].rsplit("-", 1)[1]) + 1 if names else 0
        with system.open_output_stream(f"{folder}/new") as file:
            file.write(json.dumps({"position": position}).encode())
        system.move(f"{folder}/new", f"{folder}/{kind}-{number:012d}")
        for name in names[:-1]:
            system.delete_file(name)

    def latestOffset(self) -> Position:
        self._learn()
        if self.position is None:
            noted = self._notes("end")
            self.position = self.initialOffset() if noted is None else noted
        begin = {key: self._begin(self.position, key) for key in self.ends}
        waiting = {key: end - begin[key] for key, end in self.ends.items() if end > begin[key]}
        if self.limit_each:
            waiting = {key: min(n, self.limit_each) for key, n in waiting.items()}
        given = share(waiting, self.limit)
        self.position = self._with(self.position, {key: begin[key] + n for key, n in given.items() if n})
        return self.position

    def partitions(self, start: Position, end: Position) -> list[Slice]:
        self._learn()
        slices = []
        for topic, parts in end.items():
            for partition, high in parts.items():
                key = (topic, int(partition))
                low = self._begin(start, key)
                if high < low and self._at(start, key) is not None:
                    raise ValueError(f"{topic}-{partition} would go back from {low} to {high}: the folder `position` is not of this query")
                for first in range(low, high, self.slice):
                    stop = min(first + self.slice, high)
                    files = [self._full(d) for d in self.known.get(key, {}).values() if d.first < stop and d.last >= first]
                    if files:
                        slices.append(Slice(files, *key, first, stop))
        # Spark has logged the batch by now, so a restart goes on from its end
        self._store(end, "end")
        self.position = end
        return slices

    def _full(self, described: Described) -> str:
        # file names come from URLs
        return f"{self.path}/{unquote(described.file)}"

    def commit(self, end: Position) -> None:
        """Files that lie behind the position are forgotten."""
        self._store(end, "end")
        for key, files in self.known.items():
            at = self._at(end, key)
            if at is not None:
                self.known[key] = {name: d for name, d in files.items() if d.last >= at}

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        system = located(partition.files[0])[0]
        files = [located(f)[1] for f in partition.files]
        within = (ds.field("offset") >= partition.low) & (ds.field("offset") < partition.high)
        stored = ds.dataset(files, schema=_as_written(system, files[0]), format="parquet", filesystem=system)
        for batch in stored.to_batches(filter=within, columns=STORED.names):
            if batch.num_rows:
                yield _complete(batch, partition)


def _as_written(system: fs.FileSystem, file: str) -> pa.Schema:
    """The stored columns, with timestamps in the unit of the file (Spark writes INT96 unless told otherwise)."""
    written = pq.read_schema(file, filesystem=system)
    return pa.schema([written.field(n) if n == "timestamp" else STORED.field(n) for n in STORED.names])


def _complete(batch: pa.RecordBatch, partition: Slice) -> pa.RecordBatch:
    columns = {}
    for field, column in zip(STORED, batch.columns, strict=True):
        if pa.types.is_timestamp(column.type) and column.type.tz is None:
            column = column.cast(pa.timestamp("us")).cast(field.type)
        columns[field.name] = column.cast(field.type)
    columns["topic"] = pa.array([partition.topic] * batch.num_rows, pa.string())
    columns["partition"] = pa.array([partition.partition] * batch.num_rows, pa.int32())
    return pa.RecordBatch.from_pydict(columns)


class OffsetStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> StructType:
        return LOG

    def streamReader(self, schema: StructType) -> OffsetStreamReader:
        return OffsetStreamReader({name.lower(): value for name, value in self.options.items()})


def read_by_offsets(
    spark: SparkSession,
    path: str,
    topics=None,
    pattern=None,
    assignment=None,
    starting: str | dict = "earliest",
    max_records: int | None = None,
    max_per_partition: int | None = None,
    position: str | None = None,
    slice_records: int | None = None,
) -> DataFrame:
    """The stream of the log at ``path``; see the module for the options. ``assignment`` lists (topic, partition)."""
    ship_package(spark)
    spark.dataSource.register(OffsetStream)
    wanted: dict[str, list[int]] = {}
    for topic, partition in assignment or ():
        wanted.setdefault(topic, []).append(partition)
    options = {
        "path": path,
        "topics": ",".join(topics) if topics is not None else None,
        "pattern": pattern,
        "assignment": json.dumps(wanted) if assignment is not None else None,
        "startingOffsets": starting if isinstance(starting, str) else json.dumps(starting),
        "maxRecords": max_records,
        "maxRecordsPerPartition": max_per_partition,
        "position": position,
        "sliceRecords": slice_records,
    }
    reader = spark.readStream.format("topic_log")
    return reader.options(**{name: str(value) for name, value in options.items() if value is not None}).load()
