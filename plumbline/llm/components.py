"""Connected components of a link table, without a driver-side or single-task step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node that it is connected with.

    Alternating large-star and small-star rounds: each hangs neighbours on the smallest node seen, until no link changes.  The minimum of
    a node is combined before the shuffle; a node with very many links is spread by the adaptive skew join.  Each round is written
    to the work folder, so a lost executor repeats one round.  Nodes of any orderable type; null nodes are left out.
    """
    spark = links.sparkSession
    work = Scratch(spark, name)

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        """edges have a > b (b the smaller)."""
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    start = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, n = work.write(start, "round0"), 0
    before = mark(edges)
    while before[0]:
        n += 1
        edges = work.write(stars(stars(edges, True), False), f"round{n}")
        work.drop(f"round{n - 1}")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
