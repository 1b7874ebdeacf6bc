"""Build the concept / paper graph as node and edge tables.

Keyword nodes from several prerequisite datasets are overlaid (a later source
replaces a node of the same name completely), PREREQ edges are upserted
between existing keywords, paper concepts are resolved against the keyword
graph (G4), papers are upserted by title, concept mentions are mapped to
keywords through the alias map (G5 / J9) and ABOUT / IN / REF_BY edges are
upserted between existing endpoints.  Everything is returned as DataFrames;
``write_graph_snapshot`` persists them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from noema.functions import lists as L, text as X
from noema.operators.metrics import write_counted
from noema.operators import graph as G
from noema.operators.resolve import resolve
from noema.operators.rows import last_per_key, with_global_index


@dataclass
class Graph:
    keywords: DataFrame
    papers: DataFrame
    prereq: DataFrame
    about: DataFrame
    in_edges: DataFrame
    ref_by: DataFrame
    failed_mappings: DataFrame
    dangling: dict[str, DataFrame] = field(default_factory=dict)
    actions: DataFrame | None = None
    quarantined_papers: DataFrame | None = None
    collapsed_papers: DataFrame | None = None


def keyword_rows(nodes_csv: DataFrame, source_ord: int) -> DataFrame:
    """Keyword CSV rows (pos, name, link, alias text, categories text) → typed rows."""
    return nodes_csv.select("name", "link", L.parse_to_list("alias").alias("alias"),
                            L.parse_to_list("categories").alias("categories"),
                            F.lit(source_ord).alias("source_ord"), "pos")


def overlay_keywords(sources: list[DataFrame]) -> DataFrame:
    """G1 + G3 over typed keyword rows of each source (in overlay order)."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s, allowMissingColumns=True)
    rows = rows.where(F.col("name").isNotNull())
    return G.upsert_nodes(None, rows, "name", ["source_ord", "pos"])


def prereq_edges(edge_sources: list[DataFrame], keywords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prereq_name → name) between existing keywords, last row wins."""
    rows = None
    for i, e in enumerate(edge_sources):
        r = e.select(F.col("prereq_name").alias("source"), F.col("name").alias("target"),
                     F.col("strength").cast("double").alias("strength"),
                     F.when(F.col("reason").isNotNull(), F.col("reason")).alias("reason"),
                     F.lit(i).alias("_src"), "pos")
        rows = r if rows is None else rows.unionByName(r)
    return G.upsert_edges(rows, "source", "target", ["_src", "pos"], keywords, "name", keywords, "name")


def upsert_papers(paper_csv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paper nodes keyed by title (stored as ``name``), last row wins;
    rows with a blank title are quarantined [Q9].  Categories are written [Q2].
    ``collapsed_paper_ids`` reports the ids lost to a same-title node."""
    rows = paper_csv.withColumn("name", F.col("title"))
    blank = rows.where(F.col("name").isNull() | (X.strip("name") == ""))
    ok = rows.where(F.col("name").isNotNull() & (X.strip("name") != "")) \
             .withColumn("categories", L.parse_to_list("categories"))
    props = ["paperId", "url", "publication", "year", "referenceCount", "citationCount", "authors",
             "abstract", "categories", "description"]
    nodes = last_per_key(ok.select("name", *[c for c in props if c in ok.columns], "pos"), ["name"], ["pos"])
    return nodes.drop("pos"), blank


def build_graph(keyword_sources: list[DataFrame], prereq_sources: list[DataFrame], kc_nodes_csv: DataFrame,
                paper_csv: DataFrame, paper_kc_csv: DataFrame, ref_csv: DataFrame) -> Graph:
    """E3 over CSV-shaped inputs (each with ``pos``)."""
    base = overlay_keywords([keyword_rows(s, i + 1) for i, s in enumerate(keyword_sources)])
    prereq, dangling_prereq = prereq_edges(prereq_sources, base)
    # Paper concepts resolved against the keyword graph, in input order
    existing = with_global_index(base.select("name", "alias", "link", "categories"), ["name"], "ord")
    incoming = keyword_rows(kc_nodes_csv, 0).select("pos", "name", "alias", "link", "categories")
    actions, keywords = resolve(existing, incoming)
    keywords = keywords.select("node_ord", F.col("node_name").alias("name"), "link", "alias", "categories") \
                       .checkpoint(eager=True)
    papers, quarantined = upsert_papers(paper_csv)
    papers = papers.checkpoint(eager=True)  # read by six of the outputs
    amap = G.alias_map(keywords, "name", "alias", [F.col("node_ord")])
    keywords = keywords.drop("node_ord")
    about_rows = paper_kc_csv.where(F.col("name") == "ABOUT")
    in_rows = paper_kc_csv.where(F.col("name") == "IN")
    about_ok, about_failed = G.map_concepts(about_rows.drop("name"), amap, "concept")
    in_ok, in_failed = G.map_concepts(in_rows.drop("name"), amap, "concept")
    about, dangling_about = G.upsert_edges(
        about_ok.select("paperId", "keyword_name", F.col("strength").cast("double").alias("strength"),
                        "reason", "pos"),
        "paperId", "keyword_name", ["pos"], papers, "paperId", keywords, "name")
    inn, dangling_in = G.upsert_edges(
        in_ok.select("keyword_name", "paperId", F.col("strength").cast("double").alias("strength"),
                     "reason", "pos"),
        "keyword_name", "paperId", ["pos"], keywords, "name", papers, "paperId")
    ref = ref_csv.select(F.col("ref_paper_id").cast("string").alias("ref_paper_id"),
                         F.col("seed_paper_id").cast("string").alias("seed_paper_id"),
                         L.parse_to_list("intents").alias("intents"),
                         F.col("isInfluential").cast("boolean").alias("isInfluential"),
                         F.col("strength").cast("double").alias("strength"),
                         L.parse_to_list("contexts").alias("contexts"), "pos")
    ref_by, dangling_ref = G.upsert_edges(ref, "ref_paper_id", "seed_paper_id", ["pos"],
                                          papers, "paperId", papers, "paperId")
    failed = about_failed.withColumn("edge_type", F.lit("ABOUT")).unionByName(
        in_failed.withColumn("edge_type", F.lit("IN")))
    return Graph(keywords, papers, prereq, about, inn, ref_by, failed,
                 {"prereq": dangling_prereq, "about": dangling_about, "in": dangling_in, "ref_by": dangling_ref},
                 actions, quarantined, collapsed_paper_ids(paper_csv, papers))


def collapsed_paper_ids(paper_csv: DataFrame, papers: DataFrame) -> DataFrame:
    """Q9: paper ids whose node kept another paper's id (same title); edges to
    them are dropped as dangling."""
    ids = paper_csv.where(F.col("paperId").isNotNull()).select("paperId", F.col("title").alias("name")).distinct()
    kept = papers.select("name", F.col("paperId").alias("kept_paperId"))
    return ids.join(kept, "name").where(F.col("paperId") != F.col("kept_paperId"))


def graph_stats(g: Graph) -> DataFrame:
    """Node, edge, failed-mapping and created / merged counts
    as ``(table, n)`` rows."""
    out = G.graph_counts({"keywords": g.keywords, "papers": g.papers, "prereq_edges": g.prereq,
                          "about_edges": g.about, "in_edges": g.in_edges, "ref_by_edges": g.ref_by,
                          "failed_mappings": g.failed_mappings})
    if g.actions is not None:
        out = out.unionByName(g.actions.groupBy(F.col("action").alias("table"))
                              .agg(F.count(F.lit(1)).alias("n")))               # A12
    return out


def write_graph(g: Graph, root: str) -> DataFrame:
    """Write the graph's tables under ``root``; the counts of ``graph_stats``, taken while writing."""
    tables = {"keywords": g.keywords, "papers": g.papers, "prereq_edges": g.prereq, "about_edges": g.about,
              "in_edges": g.in_edges, "ref_by_edges": g.ref_by, "failed_mappings": g.failed_mappings}
    outcomes = {k: F.col("action") == k for k in ("created", "merged")}
    if g.actions is not None:
        tables["actions"] = g.actions
    return write_counted(tables, root, {"actions": outcomes}).where(F.col("table") != "actions")
