"""Connected components over a table of links, by contraction: all of it distributed, a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendersift.session import cut_lineage


def _flat(h: DataFrame) -> DataFrame:
    """Pointers (node, up) followed to their ends: each pass doubles the distance covered."""
    while True:
        nxt = h.select(F.col("node").alias("up"), F.col("up").alias("top"))
        h = cut_lineage(h.join(nxt, "up", "left").select(
            "node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
        done = h.filter("moved").isEmpty()
        h = h.drop("moved")
        if done:
            return h


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b long); the root is the smallest node reachable.

    In each round every node with a smaller neighbour points to the smallest one, pointers are
    followed to their ends, and the links are rewritten between those ends. No two ends that point
    nowhere are neighbours, so the nodes left shrink at least by half and the rounds grow with the
    logarithm of the input. Only minima per node are gathered: partial minima before the shuffle, and
    joins of written tables, which Spark splits where one node holds many links.
    """
    e = cut_lineage(links.filter("a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    hooks = []
    while not e.isEmpty():
        h = _flat(cut_lineage(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))))
        hooks.append(h)
        ha, hb = h.toDF("a", "ra"), h.toDF("b", "rb")
        e = cut_lineage(e.join(ha, "a").join(hb, "b", "left").withColumn("rb", F.coalesce("rb", "b"))
                        .filter("ra <> rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
                        .distinct())
    out = nodes.withColumn("root", F.col("node"))
    for h in hooks:
        out = out.join(h.toDF("root", "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out
