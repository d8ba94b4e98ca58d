"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.sources.shared import staged


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; a component is its least node.

    Each round hangs the larger neighbours of a node on the least node near it, then its
    smaller ones, which takes a number of rounds that grows with the logarithm of the
    longest path. Every round is staged, so a lost executor repeats one round only.
    Null ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    links = edges.where("a is not null and b is not null and a <> b")
    pairs = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        hung = (
            both.join(least, "a")
            .where("b > a and b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        least = hung.groupBy("a").agg(F.min("b").alias("least"))
        inner = hung.join(least, "a").where("b <> least").select(F.col("b").alias("a"), "least")
        pairs = staged(inner.union(least).distinct().toDF("a", "b"), "edges")
        mark = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.hash("a", "b"))
        ).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
