"""Connected components of a link table, as repeated joins and groupings (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import cut


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over (hi, lo): links the larger (or smaller) neighbours of each node to its smallest one."""
    if larger:
        near = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    else:
        near = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    least = near.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    linked = near.join(least, "node")
    if larger:
        out = linked.filter("other > node").select(F.col("other").alias("hi"), F.col("least").alias("lo"))
    else:
        out = linked.select(F.col("other").alias("hi"), F.col("least").alias("lo")).unionByName(
            least.select(F.col("node").alias("hi"), F.col("least").alias("lo")))
    return out.filter("hi > lo").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node with a link: component is the smallest node that links reach.

    links: two integer columns in any order; rows with a null and links of a node to itself are ignored; repeats count
    once; no links give no rows. Each round is two joins on node and least neighbour, cut by a checkpoint; the number
    of rounds grows with the logarithm of the longest chain. Nothing but a row count and a hash sum reaches the driver.
    """
    edges = cut(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    mark = None
    while True:
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(new) == mark or not new[0]:
            break
        mark = tuple(new)
        edges = cut(_star(_star(edges, larger=True), larger=False))
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
