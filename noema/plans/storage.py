"""Catalog queries for what is stored and read again: resumable runs, the answer store,
bucketed snapshots, uniqueness at the write, the adjacency layout, counters of a write,
input order, and saved JSON with rejects.
Files go to new folders under the shared checkpoint folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from noema.functions import lists as L, text as X
from noema.operators import adjacency, categories as C, enrich as E, graph as G
from noema.operators.answers import AnswerStore
from noema.plans import _sql as S, catalog, graph_build
from noema.plans.catalog import query
from noema.session import fresh_path
from noema.sources import files, snapshots
from noema.sources.tables import Tables
from noema.streaming.resume import run_resumable


# --------------------------------------------------------------------------
# A run over all orders' customers, cut in its third micro-batch and resumed
# --------------------------------------------------------------------------
@query("resumed_run", """
SELECT o_custkey AS custkey, 'Customer#' || o_custkey AS result, CAST(1 AS BIGINT) AS n
FROM (SELECT DISTINCT o_custkey FROM orders)
""")
def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is an item; it stands in the input once for each order, in many files."""
    base = fresh_path(spark, "resumed-run")
    Tables(spark, sf_dir).orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey").repartition(8) \
        .write.parquet(f"{base}/in")
    batches = []

    def process(rows: DataFrame) -> DataFrame:
        batches.append(1)
        if len(batches) == 3:
            raise RuntimeError("cut in the third micro-batch")
        return rows.select("custkey", F.concat(F.lit("Customer#"), F.col("custkey").cast("string")).alias("result"))

    def run() -> DataFrame:
        return run_resumable(spark, f"{base}/in", "custkey bigint, o_orderkey bigint", "custkey", process, f"{base}/done",
                             f"{base}/progress", max_files_per_trigger=2, order=["o_orderkey"])
    try:
        run()
    except Exception as e:
        if "cut in the third micro-batch" not in str(e):
            raise
    return run().groupBy("custkey", "result").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# L2 / L3: aliases of all customers from a generator behind an answer store
# --------------------------------------------------------------------------
def initials_model(systems: list[str], users: list[str]) -> list[str]:
    """A deterministic stand-in for the model: a concept's other names are its upper-case form and its number."""
    out = []
    for s in systems:
        name = s.split("concept ", 1)[1].split(" as JSON", 1)[0]
        out.append("Sure. " + json.dumps({"alias": [name.upper(), name, name.rpartition("#")[2], 7]}))
    return out


@query("answer_store", """
SELECT c_custkey AS pos, c_name AS name, upper(c_name) || '|' || string_split(c_name, '#')[-1] AS alias_text, true AS alias_ok FROM customer
""")
def answer_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked twice: first for half of the names, then for all; the second call asks what is missing."""
    store = AnswerStore(fresh_path(spark, "answers"), initials_model)
    names = Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"))
    E.add_alias(names.where("pos % 2 = 0"), store)
    return E.add_alias(names, store).select("pos", "name", F.array_join("alias", "|").alias("alias_text"), "alias_ok")


# --------------------------------------------------------------------------
# Two upserts of a bucketed snapshot in a row
# --------------------------------------------------------------------------
@query("graph_snapshot", """
SELECT c_custkey AS id, coalesce(o.label, c_name) AS label, coalesce(o.value, c_acctbal) AS value, CASE WHEN o.id IS NULL THEN c_mktsegment END AS segment
FROM customer FULL JOIN (SELECT o_custkey AS id, 'order ' || max(o_orderkey) AS label, arg_max(o_totalprice, o_orderkey) AS value
                         FROM orders GROUP BY o_custkey) o ON o.id = c_custkey
""")
def graph_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then their orders: the last order replaces all properties, the segment with them."""
    t, root = Tables(spark, sf_dir), fresh_path(spark, "snapshot")
    first = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.col("c_acctbal").alias("value"),
                              F.col("c_mktsegment").alias("segment"), F.lit(0).alias("pos"))
    snapshots.upsert_snapshot(root, first, ["id"], ["pos"], buckets=16)
    orders = t.orders.select(F.col("o_custkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"),
                             F.col("o_totalprice").alias("value"), F.lit(None).cast("string").alias("segment"),
                             F.col("o_orderkey").alias("pos"))
    snapshots.upsert_snapshot(root, orders, ["id"], ["pos"])
    return snapshots.read_snapshot(spark, root)


# --------------------------------------------------------------------------
# Uniqueness enforced at the write, violators in a table of rejects
# --------------------------------------------------------------------------
@query("unique_nodes", """
WITH p AS (SELECT p_name AS name, p_partkey AS pos FROM part),
c AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 < 5 THEN (SELECT min(p_name) FROM part) ELSE c_name END AS name, c_custkey AS pos FROM customer)
SELECT 'stored' AS kind, name, CAST(1 AS BIGINT) AS n FROM (SELECT name FROM p UNION SELECT name FROM c WHERE name IS NOT NULL)
UNION ALL SELECT 'repeated', name, count(*) - 1 FROM p GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'again', name, count(*) FROM c WHERE name IN (SELECT name FROM p) GROUP BY name
UNION ALL SELECT 'null', NULL, count(*) FROM c WHERE name IS NULL
UNION ALL SELECT 'counted', 'accepted', count(DISTINCT name) FROM c WHERE name NOT IN (SELECT name FROM p)
UNION ALL SELECT 'counted', 'stored', count(*) FROM c WHERE name IN (SELECT name FROM p)
UNION ALL SELECT 'counted', 'repeated', CAST(0 AS BIGINT)
UNION ALL SELECT 'counted', 'null', count(*) FROM c WHERE name IS NULL
""")
def unique_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names (many repeat), then customers: half of them take a stored part's name, a tenth has none."""
    t, root = Tables(spark, sf_dir), fresh_path(spark, "unique")
    parts = t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    one = snapshots.insert_unique(root, parts, ["name"], ["pos"], buckets=16)
    least, k = parts.agg(F.min("name")).first()[0], F.col("c_custkey") % 10
    rows = t.customer.select(F.when(k == 0, None).when(k < 5, F.lit(least)).otherwise(F.col("c_name")).alias("name"),
                             F.col("c_custkey").alias("pos"))
    two = snapshots.insert_unique(root, rows, ["name"], ["pos"])
    counts = spark.createDataFrame([("counted", r, two[r]) for r in ("accepted", "stored", "repeated", "null")],
                                   "kind string, name string, n bigint")
    out = snapshots.read_snapshot(spark, root).select(F.lit("stored").alias("kind"), "name", F.lit(1).cast("bigint").alias("n"))
    for number, names in ((one["version"], {"repeated": "repeated"}), (two["version"], {"stored": "again", "null": "null"})):
        bad = snapshots.read_rejects(spark, root, number).groupBy("reason", "name").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(bad.replace(names, subset=["reason"]).withColumnRenamed("reason", "kind"))
    return out.unionByName(counts)


# --------------------------------------------------------------------------
# One-hop scans over the co-partitioned layout, both directions
# --------------------------------------------------------------------------
@query("adjacency_scan", """
WITH e AS (SELECT l_suppkey, l_partkey, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL)
SELECT d.direction, s_name AS source, p_name || ' ' || p_partkey AS target, price
FROM e JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey, (VALUES ('out'), ('in')) d(direction)
""")
def adjacency_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and parts as nodes, supplier -> part as edges, with one missing end for each supplier."""
    t = Tables(spark, sf_dir)
    nodes = t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title")) \
        .unionByName(t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
                                   F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("title")))
    edges = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.max("l_extendedprice").alias("price")).select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"), "price")
    missing = t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("src"), F.lit("nowhere").alias("dst"),
                                F.lit(0).cast(edges.schema["price"].dataType).alias("price"))
    adj = adjacency.write_adjacency(f"adjacency_{uuid.uuid4().hex}", fresh_path(spark, "adjacency"), nodes, "id", "title",
                                    edges.unionByName(missing), "src", "dst", ["price"], buckets=16)
    out = adj.hop_out(spark).withColumn("direction", F.lit("out")).unionByName(adj.hop_in(spark).withColumn("direction", F.lit("in")))
    return out.select("direction", "source", "target", "price")


# --------------------------------------------------------------------------
# Counters of a graph, taken while its tables are written
# --------------------------------------------------------------------------
@query("graph_stats", f"""
WITH RECURSIVE {catalog._RESOLVE_CTE},
e AS (SELECT o_custkey, o_orderkey, c_nationkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey)
SELECT 'keywords' AS "table", count(*) AS n FROM nation
UNION ALL SELECT 'papers', count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'prereq_edges', count(*) FROM nation WHERE n_nationkey <> n_regionkey AND n_regionkey IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'about_edges', count(*) FROM (SELECT DISTINCT o_custkey, n_name FROM e WHERE o_orderkey % 2 = 0)
UNION ALL SELECT 'in_edges', count(*) FROM (SELECT DISTINCT n_name, o_custkey FROM e WHERE o_orderkey % 2 = 0 AND o_orderkey % 4 = 0)
UNION ALL SELECT 'ref_by_edges', count(*) FROM (SELECT DISTINCT l_orderkey % 1000, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_orderkey % 1000 IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'failed_mappings', count(*) FROM e WHERE o_orderkey % 2 = 1
UNION ALL SELECT action, count(*) FROM res GROUP BY action
""")
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as keywords, customers as papers, orders as mentions (every other one of an unknown concept),
    line items as references; entity resolution of the part names for created and merged."""
    t, root = Tables(spark, sf_dir), fresh_path(spark, "graph")
    kw = t.nation.select(F.col("n_name").alias("name"), F.array(F.lower("n_name")).alias("alias"), "n_nationkey", "n_regionkey")
    papers = G.upsert_nodes(None, t.customer.select(F.col("c_custkey").alias("paperId"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos")),
                            "name", ["pos"]).checkpoint(eager=True)  # read by four of the outputs
    target = kw.select(F.col("n_nationkey").alias("k"), F.col("name").alias("target"))
    pre = kw.join(target, kw["n_regionkey"] == target["k"]).where("n_nationkey <> n_regionkey").select(
        F.col("name").alias("source"), "target", F.col("n_nationkey").alias("pos"))
    prereq, _ = G.upsert_edges(pre, "source", "target", ["pos"], kw, "name", kw, "name")
    mentions = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_custkey").alias("paperId"), F.col("o_orderkey").alias("pos"), F.col("o_totalprice").alias("strength"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), F.lower("n_name"))).otherwise("unknown").alias("concept"))
    matched, failed = G.map_concepts(mentions, G.alias_map(kw, order=[F.col("n_nationkey")]))
    about, _ = G.upsert_edges(matched, "paperId", "keyword_name", ["pos"], papers, "paperId", kw, "name")
    # From the keyword to the paper, with its own properties
    inn, _ = G.upsert_edges(matched.where("pos % 4 = 0").select("keyword_name", "paperId", "strength", "pos"),
                            "keyword_name", "paperId", ["pos"], kw, "name", papers, "paperId")
    refs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") % 1000).alias("ref"), F.col("o_custkey").alias("seed"), F.array("l_returnflag").alias("intents"),
        (F.col("l_returnflag") == "R").alias("isInfluential"),
        L.empty_str_array().alias("contexts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    ref_by, _ = G.upsert_edges(refs, "ref", "seed", ["pos"], papers, "paperId", papers, "paperId")
    actions = catalog.entity_resolve(spark, sf_dir)
    graph = graph_build.Graph(kw, papers, prereq, about, inn, ref_by, failed, actions=actions)
    return graph_build.write_graph(graph, root)


# --------------------------------------------------------------------------
# Positions of a table read back from many files
# --------------------------------------------------------------------------
@query("input_order", """
SELECT 'csv' AS kind, o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderpriority || chr(10) || '"x", y' AS text FROM orders
UNION ALL SELECT 'json', o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1, o_orderpriority FROM orders
""")
def input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_path(spark, "input-order")
    rows = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderpriority").alias("text")) \
        .repartitionByRange(8, "o_orderkey").sortWithinPartitions("o_orderkey")
    files.write_csv(rows.withColumn("text", F.concat("text", F.lit('\n"x", y'))), f"{base}/csv")
    files.write_json_lines(rows, f"{base}/json")
    csv = files.read_csv(spark, f"{base}/csv", "o_orderkey bigint, text string")
    lines = files.with_input_order(spark.read.schema("o_orderkey bigint, text string").json(f"{base}/json"))
    return csv.withColumn("kind", F.lit("csv")).unionByName(lines.withColumn("kind", F.lit("json"))).select(
        "kind", "o_orderkey", "pos", "text")


# --------------------------------------------------------------------------
# Saved papers with broken records, which come back as rejects
# --------------------------------------------------------------------------
@query("saved_papers", """
WITH p AS (SELECT p_partkey AS k, p_name AS title, p_size AS size FROM part)
SELECT 'detail' AS kind, 'p' || k AS paper, title, CAST(size AS BIGINT) AS cited FROM p WHERE k % 10 NOT IN (3, 7)
UNION ALL SELECT 'detail rejected', CASE k % 10 WHEN 3 THEN 'broken' ELSE 'no paperId' END, CASE k % 10 WHEN 3 THEN '{"paperId": "p' || k || '", "title' ELSE title END, NULL
          FROM p WHERE k % 10 IN (3, 7)
UNION ALL SELECT 'seed', 'p' || k, title, row_number() OVER (PARTITION BY size ORDER BY k) - 1 FROM p WHERE size % 9 <> 4 AND size % 9 <> 5
UNION ALL SELECT 'seed rejected', CASE size % 9 WHEN 4 THEN 'broken' ELSE 'no data' END, NULL, count(*) FROM (SELECT DISTINCT size FROM p WHERE size % 9 IN (4, 5)) GROUP BY ALL
""")
def saved_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as papers: one JSON line each, and one document of several lines for each size.  Every tenth line
    is cut, another tenth has no id; some documents are cut, some have no papers."""
    base, k = fresh_path(spark, "saved-papers"), F.col("p_partkey")
    paper = F.struct(F.concat(F.lit("p"), k.cast("string")).alias("paperId"), F.col("p_name").alias("title"),
                     F.col("p_size").cast("bigint").alias("citationCount"))
    parts = Tables(spark, sf_dir).part.select(k, "p_name", "p_size", paper.alias("p"))
    line = F.when(k % 10 == 3, F.concat(F.lit('{"paperId": "p'), k.cast("string"), F.lit('", "title'))) \
        .when(k % 10 == 7, F.to_json(F.struct("p.title"))).otherwise(F.to_json("p"))
    parts.select(line.alias("value")).write.text(f"{base}/details")
    docs = parts.groupBy("p_size").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p")))["p"].alias("data"))
    text = F.to_json(F.struct(F.size("data").alias("total"), "data"), {"pretty": "true"})
    kind = F.col("p_size") % 9
    text = F.when(kind == 4, F.left(text, F.length(text) - 5)).when(kind == 5, '{"total": 0}').otherwise(text)
    docs.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{base}/seeds")

    details, bad_details = files.paper_details(spark, f"{base}/details")
    seeds, bad_seeds = files.seed_papers(spark, f"{base}/seeds")
    # a document's papers stand together, so the first of a document is its lowest position
    first = seeds.groupBy("citationCount").agg(F.min("pos").alias("first"))
    seeds = seeds.join(first, "citationCount").withColumn("cited", F.col("pos") - F.col("first"))
    title = F.when(F.col("reason") == "broken", F.col("record")).otherwise(F.get_json_object("record", "$.title"))
    return details.select(F.lit("detail").alias("kind"), F.col("paperId").alias("paper"), "title", F.col("citationCount").alias("cited")) \
        .unionByName(bad_details.select(F.lit("detail rejected").alias("kind"), F.col("reason").alias("paper"), title.alias("title"),
                                        F.lit(None).cast("bigint").alias("cited"))) \
        .unionByName(seeds.select(F.lit("seed").alias("kind"), F.col("paperId").alias("paper"), "title", "cited")) \
        .unionByName(bad_seeds.groupBy(F.col("reason").alias("paper")).agg(F.count(F.lit(1)).alias("cited"))
                     .select(F.lit("seed rejected").alias("kind"), "paper", F.lit(None).cast("string").alias("title"), "cited"))


# --------------------------------------------------------------------------
# S6 -> J14 -> J13 (D9): saved category responses, resolved titles, filled nodes
# --------------------------------------------------------------------------
@query("saved_categories", f"""
WITH n AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg, CASE WHEN c_custkey % 7 = 0 THEN 'kept' END AS link, c_custkey // 5 AS b FROM customer),
ok AS (SELECT *, CASE k % 5 WHEN 0 THEN name WHEN 1 THEN 'Page ' || k WHEN 2 THEN 'Norm of ' || k WHEN 3 THEN upper(name) END AS page FROM n)
SELECT 'node' AS kind, k, name, CASE WHEN link IS NULL AND page IS NOT NULL THEN '{X.WIKI_PREFIX}' || {S.quote("replace(page, ' ', '_')", '')} ELSE link END AS link,
       CASE WHEN page IS NULL THEN '' ELSE array_to_string(list_sort(list_distinct([seg, 'All'])), '|') END AS cats FROM ok
UNION ALL SELECT DISTINCT 'rejected', b, 'broken', NULL, '{{"batch_id": ' || b || ', "part": 9, "query"' FROM n
UNION ALL SELECT DISTINCT 'rejected', b, 'no query', NULL, '{{"batch_id":' || b || '}}' FROM n WHERE b % 3 = 0
""")
def saved_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five names a response, in two parts: an exact title, a redirect, a normalised spelling that is redirected
    too, a title in other case and a missing page.  A cut line for each response, and lines without a result."""
    base, k = fresh_path(spark, "saved-categories"), F.col("c_custkey")
    c = Tables(spark, sf_dir).customer.select(k, "c_name", "c_mktsegment", F.floor(k / 5).cast("bigint").alias("batch_id"))
    kind, number = k % 5, k.cast("string")
    page = F.when(kind == 1, F.concat(F.lit("Page "), number)).when(kind == 2, F.concat(F.lit("Norm of "), number)) \
        .when(kind == 3, F.upper("c_name")).otherwise(F.col("c_name"))
    between = F.concat(F.lit("Between "), number)
    pair = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    rows = c.select("batch_id", F.when(kind != 4, number).otherwise("-1").alias("id"), page.alias("title"), "c_mktsegment",
                    F.when(kind == 1, pair(F.lower("c_name"), page)).when(kind == 2, pair(F.replace(between, F.lit(" "), F.lit("_")), page)).alias("redirect"),
                    F.when(kind == 2, pair(F.upper("c_name"), between)).alias("normal"))
    parts = None
    for i, cat in ((0, F.col("c_mktsegment")), (1, F.lit("All"))):
        entry = F.struct("title", F.array(F.struct(F.concat(F.lit("Category:"), cat).alias("title"))).alias("categories"))
        grouped = rows.groupBy("batch_id").agg(F.map_from_entries(F.collect_list(F.struct("id", entry))).alias("pages"),
                                               F.collect_list("redirect").alias("redirects"), F.collect_list("normal").alias("normalized"))
        part = grouped.select(F.to_json(F.struct("batch_id", F.lit(i).alias("part"), F.struct("redirects", "normalized", "pages").alias("query"))).alias("value"))
        parts = part if parts is None else parts.unionByName(part)
    batches = c.select("batch_id").distinct()
    number = F.col("batch_id").cast("string")
    broken = batches.select(F.concat(F.lit('{"batch_id": '), number, F.lit(', "part": 9, "query"')).alias("value"))
    empty = batches.where("batch_id % 3 = 0").select(F.concat(F.lit('{"batch_id": '), number, F.lit("}")).alias("value"))
    parts.unionByName(broken).unionByName(empty).write.text(base)

    responses, rejects = files.category_responses(spark, base)
    nodes = c.select(k, F.col("c_name").alias("name"), F.when(k % 7 == 0, "kept").alias("link"), L.empty_str_array().alias("categories"))
    filled = C.fill_from_lookup(nodes, C.page_hits(responses, nodes), "name", "link", "categories")
    out = filled.select(F.lit("node").alias("kind"), F.col("c_custkey").alias("k"), "name", "link", F.array_join("categories", "|").alias("cats"))
    batch = F.regexp_extract("record", r"^\{\"batch_id\": *(\d+)", 1).cast("bigint")
    return out.unionByName(rejects.select(F.lit("rejected").alias("kind"), batch.alias("k"), F.col("reason").alias("name"),
                                          F.lit(None).cast("string").alias("link"), F.col("record").alias("cats")))
