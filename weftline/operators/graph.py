"""The page graph: nearest neighbours, containment, their union, degrees and normalised weights.

Pairs are formed inside a page, whose size the layout bounds; nothing is compared across pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SIDES = ("node_idx", "x", "y", "w", "h")


def _pairs(nodes: DataFrame) -> DataFrame:
    """Ordered pairs of different nodes of one page, as columns a_* and b_*."""
    a = nodes.select("page_id", *(F.col(c).alias(f"a_{c}") for c in _SIDES))
    b = nodes.select(F.col("page_id").alias("b_page"), *(F.col(c).alias(f"b_{c}") for c in _SIDES))
    return a.join(b, (F.col("page_id") == F.col("b_page")) & (F.col("a_node_idx") != F.col("b_node_idx"))).drop("b_page")


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Distinct (page_id, src, dst) in both directions; rows stay where their page is."""
    ends = F.explode(F.array(F.struct(F.col("a_node_idx").alias("src"), F.col("b_node_idx").alias("dst")), F.struct(F.col("b_node_idx").alias("src"), F.col("a_node_idx").alias("dst"))))
    return pairs.select("page_id", ends.alias("e")).select("page_id", "e.src", "e.dst").distinct()


def _ranked(pairs: DataFrame) -> DataFrame:
    d2 = (F.col("a_x") - F.col("b_x")) ** 2 + (F.col("a_y") - F.col("b_y")) ** 2
    order = Window.partitionBy("page_id", "a_node_idx").orderBy("d2", "b_node_idx")
    return pairs.withColumn("d2", d2).withColumn("rank", F.row_number().over(order))


def _holds() -> Column:
    return (F.col("a_x") <= F.col("b_x")) & (F.col("a_y") <= F.col("b_y")) & (F.col("a_x") + F.col("a_w") >= F.col("b_x") + F.col("b_w")) & (F.col("a_y") + F.col("a_h") >= F.col("b_y") + F.col("b_h"))


def knn_edges(nodes: DataFrame, k: int = 3) -> DataFrame:
    """(page_id, src, dst): each node and its k nearest by top-left corner, in both directions.

    Ties go to the smaller node.
    """
    return _both_ways(_ranked(_pairs(nodes)).where(F.col("rank") <= k))


def containment_edges(nodes: DataFrame) -> DataFrame:
    """(page_id, src, dst): boxes that contain another, edges included, in both directions."""
    return _both_ways(_pairs(nodes).where(_holds()))


def page_graph(nodes: DataFrame, k: int = 3) -> DataFrame:
    """Union of both kinds of edges; a page of one node, which has none, has the loop (0, 0)."""
    edges = _both_ways(_ranked(_pairs(nodes)).where((F.col("rank") <= k) | _holds()))
    alone = nodes.groupBy("page_id").agg(F.count("*").alias("n")).where("n = 1")
    return edges.unionByName(alone.select("page_id", F.lit(0).alias("src"), F.lit(0).alias("dst")))


def normalized(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(page_id, src, dst, weight) of the symmetric normalisation, each node with one loop.

    `edges` go both ways, so a node's degree can be counted at either end.
    """
    loops = nodes.select("page_id", F.col("node_idx").alias("src"), F.col("node_idx").alias("dst"))
    full = edges.select("page_id", "src", "dst").unionByName(loops).distinct()
    degree = lambda c: F.count("*").over(Window.partitionBy("page_id", c))
    rows = full.withColumn("d", degree("dst")).withColumn("s", degree("src"))
    return rows.select("page_id", "src", "dst", (1 / F.sqrt(F.col("d").cast("double") * F.col("s"))).alias("weight"))


def propagate(values: DataFrame, weights: DataFrame) -> DataFrame:
    """One step of message passing for (page_id, node_idx, dim, value): weighted sums over neighbours."""
    at = weights.join(values.withColumnRenamed("node_idx", "src"), ["page_id", "src"])
    return at.groupBy("page_id", F.col("dst").alias("node_idx"), "dim").agg(F.sum(F.col("weight") * F.col("value")).alias("value"))
