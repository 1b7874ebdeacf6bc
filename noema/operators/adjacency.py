"""G11 on a co-partitioned layout: one-hop scans without an exchange.

``write_adjacency`` stores nodes bucketed by their key, and every edge twice: by its source, with the
target's name, and by its target, with the source's name.  A hop then joins tables that
are bucketed alike, bucket with bucket; what would have crossed the network at every scan
crossed once, at the write.  Names are those at the time of the write: a renamed node
needs its edges written again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Adjacency:
    """The three tables ``<name>_nodes``, ``<name>_out`` and ``<name>_in`` of the session's catalog."""
    name: str
    props: tuple[str, ...]

    def _hop(self, spark: SparkSession, side: str, own: str) -> DataFrame:
        nodes = spark.table(f"{self.name}_nodes").select(F.col("key").alias("_key"), F.col("name").alias(own))
        edges = spark.table(f"{self.name}_{side}")
        # merge hints: a small side would be sent to all tasks, an exchange too
        out = edges.hint("merge").join(nodes.hint("merge"), F.col("own") == F.col("_key"))
        return out.select("source", "target", *self.props)

    def hop_out(self, spark: SparkSession) -> DataFrame:
        """(source, target, props): from every node along its outgoing edges."""
        return self._hop(spark, "out", "source")

    def hop_in(self, spark: SparkSession) -> DataFrame:
        """(source, target, props): from every node against its incoming edges."""
        return self._hop(spark, "in", "target")


def write_adjacency(name: str, path: str, nodes: DataFrame, key: str, label: str, edges: DataFrame, src: str, dst: str,
                    props: Sequence[str] = (), buckets: int = 64) -> Adjacency:
    """Store ``nodes`` (unique ``key``, shown as ``label``) and ``edges`` under ``path`` as tables ``<name>_...``.
    Edges of which an end is missing are left out, in both directions."""
    named = nodes.select(F.col(key).alias("key"), F.col(label).alias("name"))

    def store(df: DataFrame, by: str, table: str) -> None:
        df.repartition(buckets, by).write.mode("overwrite").option("path", f"{path.rstrip('/')}/{table}") \
            .bucketBy(buckets, by).sortBy(by).saveAsTable(f"{name}_{table}")

    def side(own: str, other: str, shown: str) -> DataFrame:
        far = named.select(F.col("key").alias("_far"), F.col("name").alias(shown))
        out = edges.join(far, F.col(other) == F.col("_far")).select(F.col(own).alias("own"), shown, *props)
        return out.join(named.select("key"), F.col("own") == F.col("key"), "left_semi")

    store(named, "key", "nodes")
    store(side(src, dst, "target"), "own", "out")
    store(side(dst, src, "source"), "own", "in")
    return Adjacency(name, tuple(props))
