"""Connected components by alternating large-star and small-star rounds.

Each round is two minimum aggregates with map-side combine and two equi-joins; the
edges are written to the shared folder between rounds.  The number of rounds grows
with the logarithm of the graph, and only two sums a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noema.llm.store import table


def _stars(edges: DataFrame) -> DataFrame:
    """One round: (a, b) with a > b."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    large = both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a > b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    small = large.join(low, F.col("a") == F.col("n")).select(
        F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                          F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.a", "e.b").where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint): the smallest node
    reachable.  Self loops and repeated edges don't matter; no edges, no rows."""
    state = None
    edges = table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = table(_stars(edges), "stars")
    roots = edges.select(F.col("b").alias("a")).distinct().select("a", F.col("a").alias("b"))
    return edges.unionAll(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
