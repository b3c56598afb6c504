"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.spark_tools import staged


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``comp``) for every node of the links (``a``, ``b``) that isn't its component's smallest node, ``comp``.

    Each round links every neighbour of a node to the smallest around it: first the larger neighbours, then the smaller
    ones. Rounds are written tables, so lineage stays short; they end when the links no longer change. Minima combine before
    their shuffle and are joined back from a table, so that a node with very many links can be split.
    """
    edges = staged(_apart(links.select("a", "b")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = staged(least.select("a", F.least("a", "low").alias("low")), "links")
        up = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(_apart(up).distinct(), "links")
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = staged(down.groupBy("a").agg(F.min("b").alias("low")), "links")
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(_apart(moved.unionByName(least.select("a", F.col("low").alias("b")))).distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        mark = now


def _apart(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b"))
