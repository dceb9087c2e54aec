"""Connected components by alternating large-star and small-star steps.

Each step keeps the components and pulls every node towards its smallest neighbour;
a handful of rounds ends with stars around the smallest node of each component. The
edges stay in Spark: the driver sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.plans.shared import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them. Here u > v in all rows."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest node.

    ``edges``: pairs of integers in columns ``a`` and ``b``, in any direction and number.
    Rows with a null and edges of a node to itself link nothing. An empty table gives none.
    """
    links = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
    )
    links = materialize(links, "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        links = materialize(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
