"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.shared import stored


def _largest(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the smallest of them. Edges are (higher, lower)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label (the component's smallest node) of every node that has an edge.

    Nodes are integers. Repeated edges and loops do no harm; null ends are
    dropped. Every round is written to the shared folder; the number of rounds
    grows with the logarithm of the longest path, and no node's edges are
    collected anywhere.
    """
    plain = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}").distinct()
    plain = stored(plain, "edges")
    seen = None
    while True:
        plain = stored(_smallest(_largest(plain)), "edges")
        now = tuple(plain.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = plain.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return plain.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(roots)
