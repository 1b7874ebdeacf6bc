"""Join operators.

J1 double-role dimension lookup, J2 unmatched audit, J3 anti join on ids,
J4 referential check, J5 orphan promotion, J6/J7 context and result back-joins,
J8 detail enrichment, J11 endpoint resolution with dangling count.

No join is hinted: Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

def lookup_twice(edges: DataFrame, dim: DataFrame, dim_key: str, dim_value: str,
                 roles: Sequence[tuple[str, str]], dim_order: str | None = None) -> DataFrame:
    """Left-join one dimension under several roles (e.g. source id, target
    id).  Duplicate dimension keys: the last row (by ``dim_order``) wins."""
    from noema.operators.rows import last_per_key
    d = dim.select(dim_key, dim_value, *([dim_order] if dim_order else []))
    if dim_order:
        d = last_per_key(d, [dim_key], [dim_order]).drop(dim_order)
    out = edges
    for id_col, out_col in roles:
        dd = d.withColumnRenamed(dim_key, f"_k_{out_col}").withColumnRenamed(dim_value, out_col)
        out = out.join(dd, out[id_col] == dd[f"_k_{out_col}"], "left").drop(f"_k_{out_col}")
    return out


def unmatched(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any looked-up column is null."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def anti_on_ids(df: DataFrame, bad_ids: DataFrame, id_cols: Sequence[str], bad_key: str) -> DataFrame:
    """Drop rows whose any ``id_cols`` value is in ``bad_ids[bad_key]``."""
    bad = bad_ids.select(F.col(bad_key).alias("_bad")).distinct()
    out = df
    for c in id_cols:
        out = out.join(bad, out[c] == bad["_bad"], "left_anti")
    return out


def missing_endpoints(edges: DataFrame, nodes: DataFrame, endpoint: str, node_key: str) -> DataFrame:
    """Distinct edge endpoint values absent from the node table."""
    ends = edges.select(F.col(endpoint).alias("value")).where(F.col("value").isNotNull()).distinct()
    keys = nodes.select(F.col(node_key).alias("value"))
    return ends.join(keys, "value", "left_anti")


def promote_orphans(edges: DataFrame, name: str, prereq: str) -> DataFrame:
    """Distinct prerequisites that never appear as a name."""
    names = edges.select(F.col(name).alias("value")).where(F.col("value").isNotNull())
    pre = edges.select(F.col(prereq).alias("value")).where(F.col("value").isNotNull()).distinct()
    return pre.join(names, "value", "left_anti")


def resolve_endpoints(edges: DataFrame, src_nodes: DataFrame, src_edge_key: str, src_node_key: str,
                      dst_nodes: DataFrame, dst_edge_key: str, dst_node_key: str
                      ) -> tuple[DataFrame, DataFrame]:
    """(written, dangling): edges with both endpoints, and the others."""
    s = src_nodes.select(F.col(src_node_key).alias("_s")).distinct()
    d = dst_nodes.select(F.col(dst_node_key).alias("_d")).distinct()
    met = edges.join(s, edges[src_edge_key] == s["_s"], "left").join(d, edges[dst_edge_key] == d["_d"], "left")
    both = F.col("_s").isNotNull() & F.col("_d").isNotNull()
    return met.where(both).drop("_s", "_d"), met.where(~both).drop("_s", "_d")
