"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Every source wants its share ``weight / sum of weights`` of the whole; no source may give more
than ``max_epochs`` times its size. A source above its cap is clamped there and its excess goes
to the others in proportion to their weights, until none is above. A source then repeats all its
documents ``floor(target / size)`` times, and a seeded order of its documents is read once more
until the rest of the target is reached, to the nearest document.

Edge cases: a null text has size 0; a null source is a source, last in order; a source of size 0
gets target 0 and takes nothing; an empty table gives an empty table; rows equal in id, size and
text are interchangeable; texts of any length are counted whole;
extra columns are ignored by :func:`mix_report` and kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import size_in_words, stage

#: Hex digits of a document's place that choose its bucket: 16**BUCKET_DIGITS buckets a source.
BUCKET_DIGITS = 4


def source_sizes(sized: DataFrame, weights: list[float]) -> DataFrame:
    """One row per source with its size, weight by rank in code point order, and cap-free share.
    The table has a row per source, so ranking it is not a pass over the data."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    return sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)


def fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources`` plus ``target``. Each turn is one aggregate over the sources: what is left beside
    the clamped ones, by the weight of the others. Shares only grow, so clamped sources stay
    clamped, and it ends when no further one is."""
    cap = F.col("source_size") * max_epochs
    left, weight = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    total, clamped = left, 0
    while True:
        # A literal is as wide as its value: below 2^31 words the product with a weight would be an int too.
        share = F.col("weight") * F.lit(left).cast("long") / F.lit(weight)
        full = share > cap
        count, caps, rest = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if count == clamped or rest is None:
            return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(share))
        clamped, left, weight = count, total - caps, rest


def place(seed: int, key: str) -> Column:
    """A document's place in the seeded order of its source, as 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("-"))))


def repetitions(sized: DataFrame, weights: list[float], max_epochs: int, seed: int) -> DataFrame:
    """``sized`` (doc_id, size, source and other columns) plus source_size, target and ``copies``.

    The seeded order of a source is cut into buckets. A bucket's words are one hash aggregate, the
    bucket where the rest of the target ends follows from a running sum over bucket totals, and only
    the documents of that one bucket are sorted.
    """
    placed = sized.withColumn("__place", place(seed, "doc_id")).withColumn("__bucket", F.substring("__place", 1, BUCKET_DIGITS))
    plan = (
        fill(stage(source_sizes(sized, weights), "source-sizes"), max_epochs)
        .withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("__need", F.col("target") - F.col("__whole") * F.col("source_size"))
    )
    running = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        placed.groupBy("source", "__bucket")
        .agg(F.sum("size").alias("__words"))
        .withColumn("__before", F.coalesce(F.sum("__words").over(running), F.lit(0)))
    )
    ends = (
        buckets.alias("b")
        .join(plan.select("source", "__need").alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        .where(F.col("__before") + F.col("__words") > F.col("__need"))
        .groupBy(F.col("b.source").alias("source"))
        .agg(F.min("__bucket").alias("__last"), F.min("__before").alias("__before"))
    )
    whole_plan = stage(
        plan.alias("p")
        .join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .select("p.*", "__last", "__before"),
        "mix-plan",
    )
    joined = (
        placed.alias("d")
        .join(whole_plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.*", "p.source_size", "p.target", "__whole", "__need", "__last", "__before")
    )
    sure = joined.where(~F.col("__bucket").eqNullSafe(F.col("__last"))).withColumn(
        "__extra", (F.col("__last").isNull() | (F.col("__bucket") < F.col("__last"))).cast("long")
    )
    inside = Window.partitionBy("source").orderBy("__place", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("__before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    edge = joined.where(F.col("__bucket").eqNullSafe(F.col("__last"))).withColumn(
        "__extra", (2 * ahead + F.col("size") <= 2 * F.col("__need")).cast("long")
    )
    capped = F.when(F.col("source_size") > 0, F.least(F.col("__whole") + F.col("__extra"), F.lit(max_epochs))).otherwise(0)
    return sure.unionByName(edge).withColumn("copies", capped.cast("long")).select(*sized.columns, "source_size", "target", "copies")


def mix(docs: DataFrame, weights: list[float], max_epochs: int, seed: int = 0, text: str = "text") -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as its source's target asks for. Sizes are
    counted in each pass, so that no copy of the texts is stored."""
    rest = {c: f"__in_{c}" for c in docs.columns if c in ("size", "source_size", "target", "copies")}
    sized = docs.withColumnsRenamed(rest).withColumn("size", size_in_words(F.col(text)))
    repeated = repetitions(sized, weights, max_epochs, seed).where(F.col("copies") > 0)
    again = repeated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("size", "source_size", "target", "copies")
    return again.withColumnsRenamed({v: k for k, v in rest.items()}).select(*docs.columns)


def mix_report(docs: DataFrame, weights: list[float], max_epochs: int, seed: int = 0, text: str = "text") -> DataFrame:
    """Per document: size, source_size, target of its source and words taken; texts are not moved."""
    sized = stage(docs.select("doc_id", "source", size_in_words(F.col(text)).alias("size")), "sized")
    return repetitions(sized, weights, max_epochs, seed).withColumn("taken", F.col("size") * F.col("copies"))
