"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import written


def _stars(edges: DataFrame, centre: str, keep_larger: bool) -> DataFrame:
    """Links each neighbour of a node to the smallest node of its neighbourhood.

    The smallest neighbour is a map-side aggregate and comes back by a join, so a hub with very many neighbours is split
    by adaptive execution instead of meeting in one window.
    """
    least = edges.groupBy(centre).agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("m", centre))
    joined = edges.join(least, centre)
    if keep_larger:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one orderable type); root is the smallest in reach.

    Each round is written to the shared folder. The rounds needed grow with the logarithm of the longest path.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = written(pairs, "edges"), None
    for _ in range(max_rounds):
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before or mark[0] == 0:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(mark)
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _stars(both, "u", keep_larger=True).where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        pairs = written(_stars(down, "u", keep_larger=False).where("a <> b").distinct(), "edges")
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
