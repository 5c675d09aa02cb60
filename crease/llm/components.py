"""Connected components of a link table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import materialise, salted_join

#: Salts of joins whose small side has one row per linked node.
NODE_SALTS = 16


def _least_neighbour(sym: DataFrame, nodes: int) -> DataFrame:
    """Each neighbour pair (u, v) with the least node among u and its neighbours as m."""
    least = sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return salted_join(sym, least, ["u"], F.col("v"), how="inner", salts=NODE_SALTS,
                       rows=nodes)


def star_edges(links: DataFrame) -> DataFrame:
    """Links (u, v) -> rows (v, root): every linked node but the roots, with the least node
    of its component. Large and small stars alternate until nothing changes; every round is
    written to the shared scratch folder, and only two numbers reach the driver."""
    edges = (links.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                           F.least("u", "v").alias("v")).distinct())
    edges = materialise(edges, "links")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)),
                         F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both, 2 * mark[0]).filter("v > u").select(F.col("v").alias("u"),
                                                              F.col("m").alias("v"))
        large = materialise(large.filter("u != v").distinct(), "large-star")
        small = _least_neighbour(large, 2 * mark[0])
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .filter("u != v").distinct())
        edges = materialise(small, "small-star")
