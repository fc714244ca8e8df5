"""Connected components of an undirected graph, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.session import stable


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node of its component.

    Alternating large-star and small-star rounds: every round replaces each edge by one to the smallest known
    neighbour, so long chains shrink in a logarithmic number of rounds. Minima combine before the shuffle and
    the joins back are plain equi-joins, so a node with very many neighbours is split by AQE and never gathered
    into one value. Loops and NULL ends take no part.
    """
    stars = stable(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b")
        )
        stars = stable(small.filter(F.col("a") != F.col("b")).distinct())
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
