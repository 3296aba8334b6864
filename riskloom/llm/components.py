"""Connected components by alternating large-star and small-star steps.

Every node points to the smallest node it knows; both steps are a grouped
minimum (combined before its exchange) and a join back, so no node's neighbours
ever meet in one task. Each round is written to the shared folder, which cuts
the lineage and survives a lost executor. The rounds end when every node but
the smallest of its component points to one node that points to none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether each ``a`` (larger than its ``b``) has one ``b`` only, and no ``b`` is an ``a``; then ``b`` is the smallest."""
    roles = F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("to")),
        F.struct(F.col("b").alias("node"), F.lit(None).cast(edges.schema["b"].dataType).alias("to")),
    ))
    nodes = edges.select(roles.alias("r")).groupBy("r.node").agg(
        F.min("r.to").alias("lo"), F.max("r.to").alias("hi"), F.count("r.to").alias("as_a"), F.count("*").alias("n")
    )
    # one count to the driver
    return not nodes.where("lo != hi or (as_a > 0 and as_a < n)").count()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; ``component`` is its smallest reachable node.

    ``links`` has two columns of one orderable type; direction, repeats and
    self-links don't matter, nulls are not links. No links give no rows.
    """
    left, right = links.columns[:2]
    edges = written(
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .where("a is not null and b is not null").distinct(),
        "links",
    )
    while not _are_stars(edges):
        # large star: larger neighbours of a node move to the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a != b").distinct(), "large-star")
        # small star: smaller neighbours and the node itself move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        edges = written(moved.unionByName(own).distinct(), "small-star")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
