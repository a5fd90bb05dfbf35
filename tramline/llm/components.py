"""Connected components by contraction, for graphs whose edges fit no single machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (no loops needed, any direction, repeats allowed) -> node, root for every node of an edge.

    Each round every node moves to its smallest neighbour in a random order (or stays, if it is smaller
    itself), and edges move along; what lies inside one node goes. In a random order a fixed share of the nodes
    moves each round, so rounds grow with the logarithm of the largest component. All steps are joins
    and aggregations; only the count of open edges comes to the driver.
    """
    def keyed(x: str):
        return F.struct(F.xxhash64(x).alias("h"), F.col(x).alias("n"))

    open_ = edges.filter("a <> b").select(keyed("a").alias("a"), keyed("b").alias("b"))
    steps = []
    while True:
        both = open_.select("a", "b").union(open_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("to")))
        steps.append(step)
        for end in ("a", "b"):
            moved = step.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to"))
            open_ = open_.join(moved, end)
        open_ = cut_lineage(open_.filter("a_to <> b_to").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct())
        if not open_.take(1):
            break
    roots = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("to"), F.col("to").alias("on"))
        roots = roots.join(later, "to", "left").select("node", F.coalesce("on", "to").alias("to"))
    return roots.select(F.col("node.n").alias("node"), F.col("to.n").alias("root"))
