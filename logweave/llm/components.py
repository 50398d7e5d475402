"""Connected components of links that no single task or the driver ever holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import drop, drop_shuffles, stage


def spanning_labels(n: int, pairs) -> np.ndarray:
    """The smallest index linked to each of ``n`` items, directly or through others. ``pairs``
    yields blocks of index pairs, so all pairs of a dense group never exist at once."""
    labels = np.arange(n)
    for u, v in pairs:
        while True:
            a, b = labels[u], labels[v]
            apart = a != b
            if not apart.any():
                break
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
            while (labels[labels] != labels).any():
                labels = labels[labels]
    return labels


def connect(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: bigint): the smallest node reachable.

    Alternates two star steps, each one aggregate and one join, until every node hangs on its
    smallest neighbour: first larger neighbours move to the smallest neighbour of a node, then
    the smaller ones do. Every turn is staged, so the plan does not grow and a lost executor
    costs one turn at most.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, stage(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        drop(before)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == state:
            break
        state = now
    drop_shuffles(links.sparkSession)
    stars = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
