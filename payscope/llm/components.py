"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.session import materialize


def _sorted(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    return edges.filter("a <> b").select(high, low).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root), root being the smallest node reachable;
    only nodes with an edge, each once. No edges, no rows.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    the smallest one, then its smaller neighbours and itself. Paths shrink by halves, so
    the rounds grow with the logarithm of the longest path. Minima reduce before the
    shuffle; each round is written to the shared folder.
    """
    now = materialize(_sorted(edges), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state.n == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(_sorted(small.unionByName(down.select("a", F.col("m").alias("b")))), "edges")
