"""Connected components of a distributed graph (large-star / small-star).

Each round reads the edges from a written table, so its plan stays short and a lost
executor re-reads files.  Large star: every node's larger neighbours are linked to its
smallest neighbour; small star: its smaller neighbours (and itself) are linked to the
smallest.  Both are an aggregation that combines before the shuffle and a join back
that Spark can split when one node is the centre of a big star.  The number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """Per ``a`` the smallest ``b``, dealt out anew so that the join back on ``a`` has a
    shuffle of its own on either side (and a hot ``a`` can be split there)."""
    found = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("at"), "least")
    return found.hint("rebalance")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected ``edges(a, b)``; ``root`` is the
    smallest node of its component.  Self-links and repeated links are ignored, a
    null end drops the link."""
    at = materialize(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    for _ in range(max_rounds):
        new = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or new[0] == 0:
            break
        state = new
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest(both), F.col("a") == F.col("at")).filter(F.col("b") > F.col("a"))
        # the smallest of a node and its neighbours; larger neighbours move to it
        large = large.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        middle = materialize(large, "large_star")
        small = middle.join(_smallest(middle), F.col("a") == F.col("at"))
        small = small.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
        following = materialize(small.select("e.a", "e.b").filter(F.col("a") != F.col("b")).distinct(), "links")
        discard(at, middle)
        at = following
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = at.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
