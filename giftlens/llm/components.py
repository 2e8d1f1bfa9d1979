"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giftlens.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``.

    Each pass points every node at its smallest neighbour (or itself), follows
    that pointer once more, and replaces the links by links between the targets.
    Nodes that are hashes have neighbours in random order, so the links shrink
    by a constant factor a pass, chains and stars included.  The links of one
    hub are aggregated map-side; nothing is gathered per component.

    No links: an empty table.  Null ends and self-links are ignored, repeated
    and reversed links count once.
    """
    u, v = F.col("u"), F.col("v")
    edges = links.where(u.isNotNull() & v.isNotNull() & (u != v))
    edges = cut(edges.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct())
    roots = None
    while True:
        ends = edges.union(edges.select(v.alias("u"), u.alias("v")))
        point = ends.groupBy("u").agg(F.min("v").alias("m")).select(
            u.alias("node"), F.least("u", "m").alias("to"))
        jump = point.select(F.col("node").alias("to"), F.col("to").alias("far"))
        point = cut(point.join(jump, "to").select("node", F.col("far").alias("to")))
        if roots is None:
            roots = point.select("node", F.col("to").alias("root"))
        else:
            roots = cut(
                roots.join(point.select(F.col("node").alias("root"), "to"), "root", "left")
                .select("node", F.coalesce("to", "root").alias("root")))
        a = point.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = point.select(F.col("node").alias("v"), F.col("to").alias("b"))
        edges = edges.join(a, "u").join(b, "v").where(F.col("a") != F.col("b"))
        edges = cut(edges.select(F.least("a", "b").alias("u"),
                                 F.greatest("a", "b").alias("v")).distinct())
        if edges.isEmpty():
            return roots
