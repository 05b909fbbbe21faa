"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b): the smallest
    node that can be reached.

    Alternates two steps on the links until they are stars around the smallest
    nodes: every node sends its larger neighbours, then its smaller ones, to
    its smallest.  The number of links never grows; each round is written to
    the shared folder, so lineage stays short.  Links that are such stars
    already, as an earlier result (node, component) is, take no round.
    """
    edges = cut_lineage(_down(links.select("a", "b")))
    while not _are_stars(edges):
        least = _both_ends(edges).groupBy("n").agg(F.least(F.min("other"), F.col("n")).alias("m"))
        # a is the larger end of every link.
        larger = edges.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b"))
        larger = _down(larger)
        lowest = larger.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, F.col("a") == F.col("n")).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = cut_lineage(_down(smaller.select("e.a", "e.b")))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _down(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _both_ends(edges: DataFrame) -> DataFrame:
    """``(n, other)``: each link from both its ends.  One pass over the links, as
    every task is also kept on the driver."""
    ends = F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("other")), F.struct(F.col("b").alias("n"), F.col("a").alias("other")))
    return edges.select(F.explode(ends).alias("e")).select("e.n", "e.other")


def _are_stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one."""
    smaller = F.col("other") < F.col("n")
    counts = _both_ends(edges).groupBy("n").agg(F.count_if(smaller).alias("up"), F.max((~smaller).cast("int")).alias("down"))
    return not counts.where("up > 1 OR up + down > 1").count()
