"""Connected components of a link table by contraction, as Spark joins and aggregates.

Every round, each node points to the neighbour (or itself) of lowest hashed rank; links are
rewritten to the nodes pointed to, equal ones merge, and links inside a node vanish. The hashed
rank makes the pointers a random forest, so the number of linked nodes falls by a constant factor
each round and the loop ends when no link is left. Only link counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise, release


def _rank(node: Column, round_no: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(round_no)).alias("rank"), node.alias("node"))


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root`` for every node that has a link; nodes of a component share the root.

    Self-links and repeated links are harmless; an empty link table gives an empty result.
    """
    spark = links.sparkSession
    a, b = F.col("a"), F.col("b")
    both = links.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    edges = materialise(both.union(both.select(b.alias("a"), a.alias("b"))).distinct(), "links-0")
    hops: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(hops)
        hop = materialise(edges.groupBy("a").agg(F.min(_rank(b, k)).alias("best"))
                          .select(a.alias("node"), F.least(F.col("best"), _rank(a, k))["node"].alias("to")),
                          f"hops-{k}")
        hops.append(hop)
        moved = edges.join(hop.select(F.col("node").alias("a"), F.col("to").alias("na")), "a")
        moved = moved.join(hop.select(F.col("node").alias("b"), F.col("to").alias("nb")), "b")
        edges = materialise(moved.filter("na <> nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(),
                            f"links-{k + 1}")
        release(spark)
    if not hops:
        return edges.select(a.alias("node"), a.alias("root"))
    roots = hops[-1].select("node", F.col("to").alias("root"))
    for k in range(len(hops) - 2, -1, -1):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = materialise(hops[k].join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")),
                            f"roots-{k}")
    return roots
