"""A transactional sink: records and consumer offsets become visible together.

One micro-batch is one transaction. Its steps, in order: records (with a control entry per
touched partition), end offsets, consumer offsets, marker. Readers go by the marker, so a crash
between any two steps leaves nothing visible, and the repeated batch overwrites the leftovers. A batch
whose marker says committed is not run again.

    <path>/data/txn_id=<name>-<batch>/topic=/partition=    log entries
    <path>/ends/batch_id=<batch>                           end offset per partition, cumulative
    <path>/offsets/batch_id=<batch>                        consumer offsets up to the batch, cumulative
    <path>/txns/batch_id=<batch>                           the marker
    <path>/parts, <path>/manifests                         closed batches in few files (``compaction``)

The cumulative tables are versions named after the batch that wrote them. A marker points to the
version of each that is in force after its batch: its own, or that of the marker before where the batch
was aborted (consumer offsets) or wrote none. So a chain of versions may skip any number of batches.
Entries of an aborted batch keep their places in the log, hence its end offsets stay in force. Of each
table the version in force and the one before it stay: a batch is repeated with the latter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators.send import assign_offsets, to_entries
from logweave.plans.ordered import div
from logweave.plans.small import settle
from logweave.schema import TP
from logweave.session import slice_width
from logweave.sources import isolation
from logweave.streaming.compaction import Snapshot, closed_batches, compact
from logweave.streaming.runs import BatchFunction, batch_dir, batches_in, exists, overwrite, remove


class TransactionAborted(RuntimeError):
    """A send inside the transaction failed; nothing of the batch is visible."""


class TxnSink:
    """``ends`` describes entries the destination already has (``topic, partition, end_offset``).
    ``on_complete(batch_id, committed)`` is called after each commit or abort. With ``compact_every``
    closed batches are compacted after a commit as soon as there are that many of them."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        name: str = "txn",
        ends: DataFrame | None = None,
        on_complete: Callable[[int, bool], None] | None = None,
        compact_every: int | None = None,
    ):
        self.spark, self.path, self.name, self.on_complete = spark, path, name, on_complete
        self.compact_every = compact_every
        self._first_ends = ends

    def txn_id(self, batch_id: int) -> str:
        return f"{self.name}-{batch_id}"

    def run(
        self, requests: DataFrame, batch_id: int, offsets: DataFrame | None = None, order: Sequence[str] = ("seq",)
    ) -> None:
        """Send ``requests`` and store ``offsets(topic, partition, commit_offset)`` as one
        transaction. The first failed request aborts it and raises."""
        if self.state(batch_id) == "committed":
            return
        for table in ("ends", "offsets"):  # of an attempt that did not end
            remove(self.spark, batch_dir(f"{self.path}/{table}", batch_id))
        if not requests.where(F.col("error").isNotNull()).isEmpty():
            self.abort(batch_id)
            failed = requests.where(F.col("error").isNotNull()).agg(F.min_by("error", F.struct(*order))).first()[0]
            raise TransactionAborted(f"{self.txn_id(batch_id)}: {failed}")
        self.write_data(requests, batch_id, order)
        self.send_offsets(offsets, batch_id)
        self.commit(batch_id)
        if self.compact_every and len(batches_in(self.spark, f"{self.path}/txns")) >= self.compact_every:
            upto = Snapshot(self.spark, self.path).upto
            if len(closed_batches(self.spark, self.path, upto)) >= self.compact_every:
                self.compact()

    def compact(self) -> bool:
        """Move closed batches into few files; see ``compaction``."""
        return compact(self.spark, self.path)

    # -- versions -----------------------------------------------------------------------------

    def _marker_of(self, batch_id: int) -> dict | None:
        path = batch_dir(f"{self.path}/txns", batch_id)
        if exists(self.spark, path):
            return self.spark.read.parquet(path).first().asDict()
        snapshot = Snapshot(self.spark, self.path)
        if batch_id > snapshot.upto:
            return None
        row = snapshot.markers(snapshot.upto).where(F.col("batch_id") == batch_id).first()
        return row and row.asDict()

    def _marker_before(self, batch_id: int) -> dict:
        """The marker of the latest batch before ``batch_id``; without one nothing is in force."""
        found = self._marker_of(batch_id - 1) if batch_id else None
        if found is None:
            earlier = [b for b in batches_in(self.spark, f"{self.path}/txns") if b < batch_id]
            found = self._marker_of(max(earlier)) if earlier else {}
        return found

    def _version(self, table: str, batch_id: int | None) -> DataFrame | None:
        return None if batch_id is None else self.spark.read.parquet(batch_dir(f"{self.path}/{table}", batch_id))

    def state(self, batch_id: int) -> str | None:
        """``committed``, ``aborted``, or None while the batch is open or unknown."""
        return (self._marker_of(batch_id) or {}).get("state")

    def write_data(self, requests: DataFrame, batch_id: int, order: Sequence[str]) -> None:
        # the control entry sorts behind everything with the greatest leading order value
        touched = settle(
            requests.groupBy(*TP).agg(
                *[F.max(c).alias(c) for c in dict.fromkeys([*order, "timestamp"])], F.count(F.lit(1)).alias("records")
            )
        )
        control = touched.drop("records").withColumns({"is_control": F.lit(True), "error": F.lit(None).cast("string")})
        both = requests.withColumn("is_control", F.lit(False)).unionByName(control, allowMissingColumns=True)
        slices = [div(F.col(order[0]).cast("long"), slice_width(self.spark))]
        before = self._version("ends", self._marker_before(batch_id).get("ends"))
        before = self._first_ends if before is None else before
        entries = to_entries(assign_offsets(both, before, (*order, "is_control"), slices))
        data = f"{self.path}/data/txn_id={self.txn_id(batch_id)}"
        entries.drop("txn_id").sortWithinPartitions(*TP, "offset").write.mode("overwrite").partitionBy(*TP).parquet(data)
        grown = touched.select(*TP, (F.col("records") + 1).alias("end_offset"))
        if before is not None:
            grown = before.select(*TP, "end_offset").unionByName(grown)
        ends = grown.groupBy(*TP).agg(F.sum("end_offset").alias("end_offset"))
        overwrite(ends, f"{self.path}/ends", batch_id)

    def send_offsets(self, offsets: DataFrame | None, batch_id: int) -> None:
        if offsets is None:
            return
        now = offsets.select(*TP, "commit_offset")
        earlier = self._version("offsets", self._marker_before(batch_id).get("offsets"))
        if earlier is not None:
            now = now.unionByName(earlier.select(*TP, "commit_offset").join(now, TP, "left_anti"))
        overwrite(now, f"{self.path}/offsets", batch_id)

    def _marker(self, batch_id: int, state: str) -> None:
        before, now = self._marker_before(batch_id), {}
        for table in ("ends", "offsets"):
            counts = state == "committed" or table == "ends"
            written = exists(self.spark, batch_dir(f"{self.path}/{table}", batch_id))
            now[table] = batch_id if counts and written else before.get(table)
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(self.txn_id(batch_id)).alias("txn_id"),
            F.lit(state).alias("state"),
            *[F.lit(version).cast("long").alias(table) for table, version in now.items()],
        )
        overwrite(row, f"{self.path}/txns", batch_id)
        for table, version in now.items():
            for old in batches_in(self.spark, f"{self.path}/{table}"):
                if old <= batch_id and old not in (version, before.get(table)):
                    remove(self.spark, batch_dir(f"{self.path}/{table}", old))
        if self.on_complete is not None:
            self.on_complete(batch_id, state == "committed")

    def commit(self, batch_id: int) -> None:
        self._marker(batch_id, "committed")

    def abort(self, batch_id: int) -> None:
        """Entries written without end offsets are leftovers of a crash and go, so that no two
        entries get one place."""
        if not exists(self.spark, batch_dir(f"{self.path}/ends", batch_id)):
            remove(self.spark, f"{self.path}/data/txn_id={self.txn_id(batch_id)}")
        self._marker(batch_id, "aborted")

    # -- reading ------------------------------------------------------------------------------

    def txns(self) -> DataFrame:
        return Snapshot(self.spark, self.path).markers().select("txn_id", "state")

    def entries(self) -> DataFrame:
        return Snapshot(self.spark, self.path).entries()

    def read(self, isolation_level: str = "read_committed") -> DataFrame:
        snapshot = Snapshot(self.spark, self.path)
        return isolation.read(snapshot.entries(), snapshot.markers().select("txn_id", "state"), isolation_level)

    def committed(self) -> DataFrame:
        """Consumer offsets of committed transactions, the newest per partition."""
        batches = batches_in(self.spark, f"{self.path}/txns")
        stored = self._version("offsets", self._marker_of(max(batches))["offsets"]) if batches else None
        if stored is None:
            return self.spark.createDataFrame([], "topic string, partition int, commit_offset long")
        return stored.select(*TP, "commit_offset")


def exactly_once(
    transform: Callable[[DataFrame], DataFrame], sink: TxnSink, order: Sequence[str] = ("seq",)
) -> BatchFunction:
    """Receive, transform, send and commit: the consumed offsets travel in the transaction."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            offsets = batch.groupBy(*TP).agg((F.max("offset") + 1).alias("commit_offset"))
            sink.run(transform(batch), batch_id, offsets, order)
        finally:
            batch.unpersist()

    return each
