"""Prerequisite-dataset cleaning flows.

D6 Metacademy: quality scans → repair → group → link → explode → self-loop
removal → orphan promotion → node / edge tables → referential checks.
D7 TutorialBank: relation filter → drop topics without link (and their edges)
→ title from URL → id → name under two roles → unmatched count.
D8 cross-dataset duplicate report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from noema.functions import text as X
from noema.functions.predicates import not_self_loop
from noema.operators import enrich as E, aggregates as A, joins as J, sets as U
from noema.operators.rows import first_per_key

# The repair map for titles whose encoding was damaged (U+FFFD).
REPAIR_MAP = {
    "Alpha\ufffdbeta pruning": "Alpha–beta pruning",
    "G\ufffddel's completeness theorem": "Gödel's completeness theorem",
}

CONCEPT = "concept_wiki_canonical_title"
PREREQ = "prereq_wiki_canonical_title"


def bad_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct sorted values containing U+FFFD."""
    return df.where(X.has_replacement_char(col)).select(col).distinct().orderBy(col)


def non_ascii_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct sorted values containing a non-ASCII character."""
    return df.where(X.has_non_ascii(col)).select(col).distinct().orderBy(col)


@dataclass
class CleanResult:
    nodes: DataFrame
    edges: DataFrame
    missing_edge_names: DataFrame | None = None
    missing_edge_prereqs: DataFrame | None = None
    unmatched: DataFrame | None = None


def clean_metacademy(raw: DataFrame, repair: dict[str, str] = REPAIR_MAP) -> CleanResult:
    """D6 on ``(pos, concept_wiki_canonical_title, prereq_wiki_canonical_title)``."""
    fixed = raw.replace(repair, subset=[CONCEPT, PREREQ])                          # P8
    grouped = A.grouped_sorted_distinct(fixed, CONCEPT, PREREQ, "prereqs") \
               .withColumnRenamed(CONCEPT, "name")                                  # A1
    grouped = grouped.withColumn("link", X.name_link("name"))                       # F9(a)
    rows = grouped.select("name", "link", F.explode_outer("prereqs").alias("prereq_name"))  # F5
    rows = rows.where(not_self_loop("name", "prereq_name"))                         # P4
    orphans = J.promote_orphans(rows, "name", "prereq_name").select(                # J5
        F.col("value").alias("name"), X.name_link("value").alias("link"),
        F.lit(None).cast("string").alias("prereq_name"))
    data = rows.unionByName(orphans)                                                # U2
    nodes = data.where(F.col("name").isNotNull()).select("name", "link").distinct() \
                .withColumn("alias", F.lit(None).cast("array<string>"))             # W2 (same link per name)
    edges = data.where(F.col("name").isNotNull() & F.col("prereq_name").isNotNull()) \
                .select("name", "prereq_name").distinct() \
                .withColumn("strength", F.lit(None).cast("double")) \
                .withColumn("reason", F.lit(None).cast("string"))                   # U6
    return CleanResult(
        nodes=nodes.orderBy("name"), edges=edges.orderBy("name", "prereq_name"),    # O1
        missing_edge_names=J.missing_endpoints(edges, nodes, "name", "name"),       # J4
        missing_edge_prereqs=J.missing_endpoints(edges, nodes, "prereq_name", "name"))


def clean_tutorialbank(topics: DataFrame, annotations: DataFrame) -> CleanResult:
    """D7 on topics ``(pos, topic_id, topic_name, wikipedia_link)`` and
    annotations ``(pos, source_topic_id, target_topic_id, prereq_relation)``."""
    ann = annotations.where(F.col("prereq_relation") == 1)                          # P3
    bad = topics.where(F.col("wikipedia_link").isNull()).select("topic_id")         # P5
    ann = J.anti_on_ids(ann, bad, ["source_topic_id", "target_topic_id"], "topic_id")  # J3
    kept = topics.join(bad, "topic_id", "left_anti")
    nodes = kept.select(F.col("topic_id").alias("id"), X.title_from_url("wikipedia_link").alias("name"),
                        F.col("topic_name").alias("tb_name"), F.col("wikipedia_link").alias("link"),
                        F.lit(None).cast("array<string>").alias("alias"), "pos")
    edges = J.lookup_twice(ann, nodes, "id", "name",
                           [("source_topic_id", "prereq_name"), ("target_topic_id", "name")],
                           dim_order="pos")                                          # J1 (last id wins)
    unmatched = J.unmatched(edges, ["prereq_name", "name"])                         # J2
    edges = edges.select("name", "prereq_name", F.lit(None).cast("double").alias("strength"),
                         F.lit(None).cast("string").alias("reason"), "pos")
    return CleanResult(nodes=nodes, edges=edges, unmatched=unmatched)


def duplicate_report(nodes_a: DataFrame, nodes_b: DataFrame, edges_a: DataFrame, edges_b: DataFrame
                     ) -> tuple[DataFrame, DataFrame]:
    """Names in both datasets (U3) and (name, prereq_name) pairs in both (U4)."""
    return (U.intersect_names(nodes_a, nodes_b, "name").orderBy("name"),
            U.intersect_pairs(edges_a, edges_b, "name", "prereq_name").orderBy("name", "prereq_name"))



@dataclass
class EnrichedDataset:
    nodes: DataFrame
    edges: DataFrame
    rejected_nodes: DataFrame
    rejected_edges: DataFrame


def enrich_dataset(nodes: DataFrame, edges: DataFrame, generator=None, responses: DataFrame | None = None) -> EnrichedDataset:
    """E2 after cleaning: aliases of the nodes (L3) and scores of the edges (L4), and the
    rows that the model gave no usable answer for, whole and unlimited (P11)."""
    named = E.add_alias(nodes, generator, responses)
    scored = E.score_prereq_edges(edges, generator, responses)
    return EnrichedDataset(named, scored, named.where(~F.col("alias_ok")), scored.where(~F.col("edge_ok")))


def write_dataset(data: EnrichedDataset, root: str) -> None:
    """The dataset's node and edge files."""
    from noema.sources.files import write_csv
    base = root.rstrip("/")
    write_csv(data.nodes, f"{base}/nodes")
    write_csv(data.edges.select("name", "prereq_name", "strength", "reason"), f"{base}/edges")
