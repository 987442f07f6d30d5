"""Connected components of a link table, as Spark joins.

Alternates the two "star" steps known from MapReduce graph processing: every node
hangs its larger neighbours below its smallest neighbour, then its smaller ones.
Each step is a partial-aggregated minimum and one join, whose hot side (a node with
very many links) adaptive execution can split. The link table only shrinks towards
one (node, root) row per node; rounds grow with the logarithm of a chain's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import save


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) → (node, root): the smallest node reachable from each linked node.

    Self links and repeated links change nothing; nodes without a link to another
    node are not returned. Nulls are not nodes. An empty table gives an empty table.
    """
    edges = save(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components")
    before = _signature(edges)
    while before[0]:
        edges = save(_small_star(_large_star(edges).distinct()).where("u != v").distinct(), "components")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
