"""Property-graph operators on node / edge DataFrames.

A graph is one DataFrame per node label and per edge type (written as parquet
snapshots).  A Cypher ``MERGE ... SET`` upsert becomes "union current and
incoming, keep the last row per key"; ``MATCH (a) MATCH (b) MERGE (a)-[r]->(b)``
becomes two semi joins (edges to missing endpoints are dropped and counted).

G1 node upsert, G2/G7/G8/G9 edge upserts, G3 multi-source overlay, G5 alias
map, J9 concept mapping, G10 uniqueness check, G11 one-hop scan, A13 counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from noema.functions.text import lower_strip
from noema.operators.joins import resolve_endpoints
from noema.operators.rows import last_per_key

# Fixed value: the failure reason written for concepts without a keyword.
NO_MATCH_REASON = "No matching Keyword node found in alias map"


def upsert_nodes(current: DataFrame | None, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Incoming rows replace every property of the node with the
    same key (nulls included); among incoming rows the last in ``order`` wins.

    ``current`` rows rank before every incoming row.  The result is a new
    snapshot; callers write it out.
    """
    inc = incoming.withColumn("_gen", F.lit(1))
    if current is not None:
        cur = current.withColumn("_gen", F.lit(0))
        for c in order:
            if c not in cur.columns:
                cur = cur.withColumn(c, F.lit(None).cast(dict(inc.dtypes)[c]))
        inc = cur.unionByName(inc, allowMissingColumns=True)
    out = last_per_key(inc, [key], ["_gen", *order])
    return out.drop("_gen", *order)


def upsert_edges(edges: DataFrame, src_col: str, dst_col: str, order: Sequence[str],
                 src_nodes: DataFrame, src_key: str, dst_nodes: DataFrame, dst_key: str
                 ) -> tuple[DataFrame, DataFrame]:
    """One edge per (src, dst), properties from the last row;
    edges whose endpoints are not both present are not written.

    Returns (written edges, dangling input rows)."""
    ok, dangling = resolve_endpoints(edges, src_nodes, src_col, src_key, dst_nodes, dst_col, dst_key)
    return last_per_key(ok, [src_col, dst_col], list(order)).drop(*order), dangling


def alias_map(nodes: DataFrame, name: str = "name", alias: str = "alias",
              order: Sequence[Column] | None = None) -> DataFrame:
    """Every ``lower(strip(name))`` and ``lower(strip(alias))`` → node name.
    On a collision the node scanned last wins (``order`` = scan order; inside a
    node, later aliases win over earlier ones and over the name)."""
    scan = F.struct(*(order or [F.col(name)]))
    named = nodes.where(F.col(name).isNotNull() & (F.col(name) != ""))
    by_name = named.select(lower_strip(F.col(name)).alias("term"), F.col(name).alias("keyword_name"),
                           F.struct(scan.alias("s"), F.lit(0).alias("i")).alias("_o"))
    by_alias = named.select(F.col(name).alias("keyword_name"), scan.alias("s"),
                            F.posexplode(F.coalesce(F.col(alias), F.array().cast("array<string>")))
                            .alias("i", "a")) \
                    .where(F.col("a").isNotNull() & (F.col("a") != "")) \
                    .select(lower_strip(F.col("a")).alias("term"), "keyword_name",
                            F.struct("s", (F.col("i") + 1).alias("i")).alias("_o"))
    terms = by_name.unionByName(by_alias)
    return terms.groupBy("term").agg(F.max_by("keyword_name", "_o").alias("keyword_name"))


def map_concepts(edges: DataFrame, amap: DataFrame, concept: str = "concept"
                 ) -> tuple[DataFrame, DataFrame]:
    """Look each concept up by ``lower(strip(concept))``.  Returns
    (matched edges with ``keyword_name``, failed edges with the fixed reason)."""
    keyed = edges.withColumn("_term", lower_strip(F.col(concept)))
    joined = keyed.join(amap, keyed["_term"] == amap["term"], "left").drop("term", "_term")
    matched = joined.where(F.col("keyword_name").isNotNull())
    failed = joined.where(F.col("keyword_name").isNull()).drop("keyword_name") \
                   .withColumn("reason", F.lit(NO_MATCH_REASON))
    return matched, failed


def uniqueness_violations(nodes: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (must be empty for a valid graph)."""
    return nodes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def one_hop(edges: DataFrame, src_col: str, dst_col: str, src_nodes: DataFrame, src_key: str,
            src_name: str, dst_nodes: DataFrame, dst_key: str, dst_name: str,
            props: Sequence[str] = ()) -> DataFrame:
    """``MATCH (a)-[r]->(b) RETURN a.name, b.name, r.props``."""
    s = src_nodes.select(F.col(src_key).alias("_sk"), F.col(src_name).alias("source"))
    d = dst_nodes.select(F.col(dst_key).alias("_dk"), F.col(dst_name).alias("target"))
    return (edges.join(s, edges[src_col] == s["_sk"]).join(d, F.col(dst_col) == d["_dk"])
            .select("source", "target", *props))


def graph_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per node / edge table, one ``(table, n)`` row each."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        out = part if out is None else out.unionByName(part)
    return out
