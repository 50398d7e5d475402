"""Record flows: projection, expansion, merging, ordered processing, sampling, comparison."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.plans.ordered import div, positions, previous
from logweave.plans.small import attach
from logweave.schema import TP
from logweave.session import ship_package, slice_width

#: Spark pushes a per-group row limit below the shuffle up to its own threshold; never more than this.
LIMIT_PUSHED = 1000
PUSH_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"


def record_metadata(log: DataFrame) -> DataFrame:
    """The envelope without payload: sizes, header count, timestamp type; -1 for no checksum."""
    return log.select(
        *TP,
        "offset",
        "timestamp",
        "timestampType",
        F.lit(-1).cast("long").alias("checksum"),
        F.coalesce(F.octet_length("key"), F.lit(-1)).alias("key_size"),
        F.coalesce(F.octet_length("value"), F.lit(-1)).alias("value_size"),
        F.coalesce(F.size("headers"), F.lit(0)).alias("header_count"),
    )


def derive_email(name: Column, domain: str) -> Column:
    return F.concat(F.lower(name), F.lit("@" + domain))


def upper_person(people: DataFrame) -> DataFrame:
    """Upper-case names; the copy has no email."""
    return people.withColumns(
        {
            "first_name": F.upper("first_name"),
            "last_name": F.upper("last_name"),
            "email": F.lit(None).cast("string"),
        }
    )


def expand(df: DataFrame, *copies: dict[str, Column]) -> DataFrame:
    """One row per entry of ``copies`` for each input row; a copy overrides some columns."""
    targets = dict.fromkeys(n for c in copies for n in c)
    same = [c for c in df.columns if c not in targets]
    rows = [
        F.struct(*[c.get(n, F.col(n) if n in df.columns else F.lit(None)).alias(n) for n in targets])
        for c in copies
    ]
    return df.select(*same, F.inline(F.array(*rows)))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept, in no particular order."""
    for other in others:
        first = first.unionByName(other)
    return first


def flatten(batched: DataFrame) -> DataFrame:
    """Batches back to records; ``delivery_seq`` keeps their order."""
    return batched.drop("batch_id")


def process_by_partition(
    log: DataFrame,
    step: Callable[[pd.DataFrame, object], pd.DataFrame],
    schema: T.StructType | str,
    summary: Callable[[pd.DataFrame], object] | None = None,
    combine: Callable[[object, object], object] | None = None,
    initial: object = None,
    stateless: bool = False,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Run ``step`` over every partition of a bounded log in offset order.

    A call sees one slice of consecutive records, sorted by offset, and the state that enters
    it. State is described by ``summary`` (slice -> its own contribution) and an associative
    ``combine`` - so slices of a hot partition run in parallel and no task holds a partition.
    Both return plain JSON values. The states of all slices of one partition meet in a task: one
    JSON value per slice, never records. ``opening(topic, partition, state)`` replaces ``initial``
    where it names a partition; ``state`` is JSON.

    A step whose result does not depend on other records has no state; it must say so by
    ``stateless``, as where slices begin would otherwise decide the result. For streams see
    ``streaming.stateful.by_partition``.
    """
    if log.isStreaming:
        raise ValueError("a stream has no bounded partitions: use streaming.stateful.by_partition")
    if stateless != (summary is None) or (summary is None) != (combine is None):
        raise ValueError("give summary and combine, or stateless=True")
    ship_package(log.sparkSession)
    keys = [*TP, "__slice"]
    sliced = _sliced(log)
    if stateless:
        return sliced.groupBy(*keys).applyInPandas(
            lambda pdf: step(pdf.sort_values("offset").drop(columns="__slice"), initial), schema
        )

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__slice")
        state, entering = initial, []
        for number, own in zip(pdf["__slice"], pdf["__state"]):
            entering.append(json.dumps(state))
            state = json.loads(own) if number < 0 else combine(state, json.loads(own))
        return pdf.assign(__state=entering)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        state = json.loads(pdf["__state"].iloc[0])
        return step(pdf.sort_values("offset").drop(columns=["__slice", "__state"]), state)

    carried = _slice_states(sliced, summary, opening).groupBy(*TP).applyInPandas(carry, SLICE_STATES)
    return sliced.join(carried, keys).groupBy(*keys).applyInPandas(run, schema)


SLICE_STATES = "topic string, partition int, __slice long, __state string"


def _sliced(log: DataFrame) -> DataFrame:
    return log.withColumn("__slice", div(F.col("offset"), slice_width(log.sparkSession)))


def _slice_states(sliced: DataFrame, summary: Callable[[pd.DataFrame], object], opening: DataFrame | None) -> DataFrame:
    """Contribution of every slice; an opening state is slice -1."""

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {k: [pdf[k].iloc[0]] for k in [*TP, "__slice"]}
        own = pdf.sort_values("offset").drop(columns="__slice")
        return pd.DataFrame(head | {"__state": [json.dumps(summary(own))]})

    states = sliced.groupBy(*TP, "__slice").applyInPandas(summarise, SLICE_STATES)
    if opening is None:
        return states
    return states.unionByName(opening.select(*TP, F.lit(-1).cast("long").alias("__slice"), F.col("state").alias("__state")))


def partition_states(
    log: DataFrame,
    summary: Callable[[pd.DataFrame], object],
    combine: Callable[[object, object], object],
    initial: object = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """``(topic, partition, state)`` after all records of ``log``; partitions that only ``opening``
    names keep their state."""
    ship_package(log.sparkSession)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        state = initial
        for number, own in pdf.sort_values("__slice")[["__slice", "__state"]].itertuples(index=False):
            state = json.loads(own) if number < 0 else combine(state, json.loads(own))
        return pdf[TP].head(1).assign(state=json.dumps(state))

    return _slice_states(_sliced(log), summary, opening).groupBy(*TP).applyInPandas(total, "topic string, partition int, state string")


def sample_latest(log: DataFrame, period: str) -> DataFrame:
    """The record with the highest offset per partition and period; idle periods give nothing.
    Periods count from the epoch.

    A stream keeps the whole record as aggregation state. A bounded log finds the offsets first,
    in a hash aggregate over numbers, and then picks those records out.
    """
    start = F.window("timestamp", period)["start"].alias("period_start")
    columns = [c for c in log.columns if c not in TP]
    if log.isStreaming:
        latest = F.max_by(F.struct(*columns), "offset").alias("__r")
        window = F.window("timestamp", period).alias("__w")
        return log.groupBy(*TP, window).agg(latest).select(*TP, F.col("__w")["start"].alias("period_start"), "__r.*")
    found = log.groupBy(*TP, start).agg(F.max("offset").alias("offset"))
    return attach(log, found, [*TP, "offset"], "inner").select(*TP, "period_start", *columns)


def take(df: DataFrame, n: int, member: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of every member stream."""
    if n <= min(LIMIT_PUSHED, int(df.sparkSession.conf.get(PUSH_THRESHOLD))):
        ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*member).orderBy(*order)))
        return ranked.where(F.col("__rn") <= n).drop("__rn")
    return positions(df, member, order, "__rn").where(F.col("__rn") < n).drop("__rn")


def take_while(df: DataFrame, condition: Column, member: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of every member stream before the first one where ``condition`` does not hold."""
    here = F.struct(*order)
    holds = F.coalesce(condition, F.lit(False))
    stop = df.where(~holds).groupBy(*member).agg(F.min(here).alias("__stop"))
    return (
        attach(df, stop, list(member), spread=list(order))
        .where(F.col("__stop").isNull() | (here < F.col("__stop")))
        .drop("__stop")
    )


def check_partition_order(log: DataFrame, column: str) -> DataFrame:
    """Per partition how often ``column`` fails to increase from one offset to the next."""
    stepped = previous(log.select(*TP, "offset", column), TP, ["offset"], {"__prev": F.col(column)})
    return stepped.groupBy(*TP).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(column) <= F.col("__prev")).alias("violations"),
    )


def reconcile(expected: DataFrame, received: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Multiset difference in both directions: per distinct record how many are missing from
    ``received`` and how many are extra. Copies are counted before the shuffle."""
    sides = expected.select(*columns, F.lit(1).alias("__d")).unionByName(
        received.select(*columns, F.lit(-1).alias("__d"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("__d").alias("__d"))
        .where(F.col("__d") != 0)
        .select(
            *columns,
            F.greatest("__d", F.lit(0)).alias("missing"),
            F.greatest(-F.col("__d"), F.lit(0)).alias("extra"),
        )
    )
