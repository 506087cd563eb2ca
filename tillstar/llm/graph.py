"""Connected components of an undirected graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import shared_table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: every node of an edge with the smallest node of its
    component.

    Alternates the large-star and small-star steps: each links neighbours to
    the smallest known node, so chains halve in length every round and the
    graph ends as stars.  The smallest neighbour is an aggregate with partial
    sums and is joined back, so a hub is never gathered in one task.  Every
    round is written to the shared folder, which cuts the lineage."""
    up = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    up = shared_table(up, "components")
    state = up.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while state[0]:
        both = up.unionByName(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        up = shared_table(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        now = up.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == tuple(state):
            break
        state = now
    stars = up.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())


def near_labels(edges: DataFrame, a: str = "a", b: str = "b", steps: int = 2) -> DataFrame:
    """node, label: every node of an edge with the smallest node at most
    ``steps`` edges away.  Nodes of one label are of one component; a component
    may keep several labels.  Two steps name a star whole."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = shared_table(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))), "labels")
    labels = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label"))
    for _ in range(steps - 1):
        seen = both.join(labels.withColumnRenamed("u", "v"), "v").select("u", "label").unionByName(labels)
        labels = seen.groupBy("u").agg(F.min("label").alias("label"))
    return labels.withColumnRenamed("u", "node")
