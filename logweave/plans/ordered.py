"""Ranks and running values over ordered groups that are too big for one task.

A window partitioned by ``(topic, partition)`` sorts a whole partition in one task. A hot
partition can hold a third of the data, so the operators of this package never do that.
Instead each group is cut into *slices* of its order column, which is a counter (an offset or
a sequence number, unique within the group). A slice ``counter div width`` therefore holds at
most ``width`` rows whatever the distribution of the data.

    1. per slice, a total (partial + final hash aggregate, one row per slice);
    2. over those totals, the carry entering each slice (a window over slice rows only);
    3. inside each slice, an ordinary window;
    4. carry and local value are merged after a join on (group, slice), which is the
       partitioning the local window already has, so the data is shuffled once.

Slices are a pure function of the row: both branches agree after any task is recomputed.
A counter much sparser than one row per slice should be given explicit, wider slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.schema import TP
from logweave.session import slice_width


def div(value: Column, n: int) -> Column:
    """Exact integer division (``div`` in SQL)."""
    return F.call_function("div", value, F.lit(n).cast("long"))


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, min, max, last (last non-null value), previous (the
    value of the row just before, which may be null) or total (the sum of the whole group).

    ``inclusive`` says whether the current row takes part; previous and total ignore it.
    """

    name: str
    kind: str
    value: Column
    inclusive: bool = True

    def total(self, position: Column) -> Column:
        """The value of a whole slice. Over plain numbers all of these are hash aggregates."""
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), position))
        if self.kind == "previous":
            return F.max_by(self.value, position)
        return F.sum(self.value) if self.kind == "total" else getattr(F, self.kind)(self.value)

    def carry(self, total: Column, before, every) -> Column:
        """The value of all earlier slices; for total that of all slices."""
        if self.kind == "total":
            return F.sum(total).over(every)
        if self.kind in ("last", "previous"):
            return F.last(total, ignorenulls=self.kind == "last").over(before)
        return getattr(F, self.kind)(total).over(before)

    def local(self, within) -> Column:
        """The value inside the slice; for previous also whether there is a row before."""
        if self.kind == "previous":
            return F.struct((F.row_number().over(within) > 1).alias("found"), F.lag(self.value).over(within).alias("v"))
        if self.kind == "total":
            return F.lit(None)
        end = Window.currentRow if self.inclusive else -1
        frame = within.rowsBetween(Window.unboundedPreceding, end)
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(frame)
        return getattr(F, self.kind)(self.value).over(frame)

    def merge(self, carry: Column, local: Column) -> Column:
        if self.kind == "total":
            return carry
        if self.kind == "sum":
            return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
        if self.kind == "last":
            return F.coalesce(local, carry)
        if self.kind == "previous":
            return F.when(local["found"], local["v"]).otherwise(carry)
        return (F.least if self.kind == "min" else F.greatest)(carry, local)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measures: Sequence[Running],
    slice_by: Sequence[Column] | None = None,
) -> DataFrame:
    """``df`` plus one column per measure, scanned in ``order`` inside each ``by`` group.

    ``slice_by`` gives the slice as columns that never decrease along ``order`` (default: the
    first order column, an integer counter, divided by the configured slice width).
    Rows whose group columns are null form a group like any other.
    """
    if slice_by is None:
        slice_by = [div(F.col(order[0]).cast("long"), slice_width(df.sparkSession))]
    keys = [f"__slice{i}" for i in range(len(slice_by))]
    sliced = df.withColumns(dict(zip(keys, slice_by)))
    group = list(by)
    if set(by) - set(TP):
        # structs that hold nulls are equal to each other, plain nulls are not; the entries of a
        # log always have a topic and a partition
        sliced = sliced.withColumn("__group", F.struct(*by))
        group = ["__group"]
    whole = [*group, *keys]
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    totals = sliced.groupBy(*whole).agg(*[m.total(position).alias(f"__c_{m.name}") for m in measures])
    every = Window.partitionBy(*group)
    before = every.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        *whole, *[m.carry(F.col(f"__c_{m.name}"), before, every).alias(f"__c_{m.name}") for m in measures]
    )

    within = Window.partitionBy(*whole).orderBy(*order)
    scanned = sliced.withColumns({f"__l_{m.name}": m.local(within) for m in measures})
    merged = scanned.join(carries, whole, "left").withColumns(
        {m.name: m.merge(F.col(f"__c_{m.name}"), F.col(f"__l_{m.name}")) for m in measures}
    )
    return merged.select(*df.columns, *[m.name for m in measures])


def positions(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    slice_by: Sequence[Column] | None = None,
) -> DataFrame:
    """``df`` plus the 0-based rank of each row in its group."""
    return running(df, by, order, [Running(name, "sum", F.lit(1).cast("long"), inclusive=False)], slice_by)


def previous(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    """``df`` plus, per entry of ``values``, that value on the row just before (null at the start)."""
    return running(df, by, order, [Running(n, "previous", v) for n, v in values.items()])
