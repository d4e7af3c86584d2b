"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import cut

MAX_STEPS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node links neighbours to the smallest node of its neighbourhood.

    Large star: neighbours above the node; small star: neighbours below it, and itself. The minimum is
    a grouped aggregate (partial sums first) joined back, never a list of a node's neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select("a", F.least("a", "m").alias("m"))
    joined = both.join(low, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached from each node of ``edges`` (columns a, b; one type).

    Edges to itself are ignored; a node without another neighbour does not appear. The steps end when
    they change nothing, after about log(nodes) of them; each is checkpointed in the shared folder.
    """
    now = cut(edges.select("a", "b").where("a <> b").distinct())
    mark = None
    for _ in range(MAX_STEPS):
        now = cut(_star(_star(now, large=True), large=False))
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38, 0)")).alias("h")).collect()[0]
        if (row["n"], row["h"]) == mark:
            break
        mark = (row["n"], row["h"])
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
