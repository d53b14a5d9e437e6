"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from myosig.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), v < u, linked to the least neighbour.

    Large: every neighbour above u goes to the least of u and its neighbours; small: u and
    its lower neighbours go to the least of those.  The minima are pre-aggregated where the
    edges lie and written, so the join back has two plain sides and a hot node can be split.
    """
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = written(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "star")
    pairs = both.join(least, "x")
    if large:
        out = pairs.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        out = pairs.where("y != m").select(F.col("y").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return written(out.where("u != v").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); label: the least node of its component."""
    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # a fixed point is a forest of stars; the digest of the edges tells when nothing moved
        n, digest = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n == 0 or seen == (n, digest):
            break
        seen = (n, digest)
        e = _star(_star(e, True), False)
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
