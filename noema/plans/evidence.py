"""More catalog queries: library steps over the driver tables, with inputs derived
by key arithmetic so that the branches that clean data never reaches (blanks, nulls,
failures, missing endpoints, bad model texts) hold rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noema.functions import lists as L, text as X
from noema.functions.predicates import non_blank, not_self_loop, truthy_items
from noema.operators import aggregates as A, categories as C, columns as O, enrich as E, graph as G, joins as J, rows as R
from noema.plans import _sql as S, kc_datasets as K, papers as P
from noema.plans.catalog import query
from noema.sources import files
from noema.sources.tables import Tables

_WS = X.PY_WHITESPACE_CLASS


def _squash(x: str) -> str:
    return S.strip(f"regexp_replace({x}, '[{_WS}]+', ' ', 'g')")


# --------------------------------------------------------------------------
# Text rules over whole documents
# --------------------------------------------------------------------------
@query("text_rules", f"""
WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN ' ' || chr(9) || chr(160) WHEN doc_id % 11 = 0 THEN NULL ELSE chr(10) || text || '  ' END AS t,
         [lang, ' ', source || ' ', ''] AS cats, 'Category:' || upper(source) || '_x' AS page FROM documents),
l AS (SELECT *, {_squash("coalesce(t, '')")} AS one FROM d)
SELECT doc_id, md5(CASE WHEN {S.strip('t')} = '' THEN NULL ELSE {S.strip('t')} END) AS reason_md5,
       md5(CASE WHEN one <> '' AND NOT regexp_matches(one, '[.?!]$') THEN one || '.' ELSE one END) AS one_line_md5,
       md5({_squash('lower(t)')}) AS norm_md5, substr(t, 1, 300) AS cut,
       array_to_string(list_filter(list_transform(cats, lambda x: {S.strip('x')}), lambda x: x <> ''), '; ') AS cats_text,
       lower(replace(replace(page, 'Category:', ''), '_', ' ')) AS page_key,
       coalesce({S.strip('t')} <> '', false) AS non_blank
FROM l
""")
def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    t = F.when(k % 7 == 0, F.lit(" \t\xa0")).when(k % 11 != 0, F.concat(F.lit("\n"), "text", F.lit("  ")))
    d = Tables(spark, sf_dir).documents.select(
        "doc_id", t.alias("t"), F.array("lang", F.lit(" "), F.concat("source", F.lit(" ")), F.lit("")).alias("cats"),
        F.concat(F.lit("Category:"), F.upper("source"), F.lit("_x")).alias("page"))
    return d.select("doc_id", F.md5(X.reason_clean("t")).alias("reason_md5"), F.md5(X.one_line("t")).alias("one_line_md5"),
                    F.md5(X.norm("t")).alias("norm_md5"), X.truncate("t", 300).alias("cut"),
                    X.categories_text("cats").alias("cats_text"),
                    X.page_key(X.strip_category_prefix("page")).alias("page_key"),
                    F.coalesce(non_blank("t"), F.lit(False)).alias("non_blank"))


# --------------------------------------------------------------------------
# List rules over part names
# --------------------------------------------------------------------------
@query("list_rules", """
WITH p AS (
  SELECT p_partkey, p_name, string_split(p_name, ' ') AS w, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS brand, p_type FROM part),
q AS (SELECT *, [' ' || w[1], w[2] || chr(9), '', NULL, w[1], p_name] AS raw FROM p),
r AS (SELECT *, list_filter(list_transform(raw, lambda x: trim(x)), lambda x: x IS NOT NULL AND x <> '') AS s0,
             list_filter(list_transform(raw, lambda x: trim(trim(x), chr(9))), lambda x: x IS NOT NULL AND x <> '') AS s FROM q),
u AS (SELECT *, list_filter(s, lambda x, i: list_position(s, x) = i) AS s1 FROM r)
SELECT p_partkey, CASE WHEN brand IS NULL THEN '' ELSE brand || '|' || p_type END AS split_text,
       array_to_string(CASE WHEN p_partkey % 3 = 0 THEN w WHEN p_partkey % 3 = 1 THEN [p_name] ELSE [] END, '|') AS listlike_text,
       array_to_string(s1, '|') AS concepts_text, array_to_string(list_filter(s1, lambda x: x <> p_name), '|') AS aliases_text,
       array_to_string(list_filter(s1, lambda x: length(x) > 5), '|') AS long_text,
       array_to_string([p_name] || list_filter(s1, lambda x: x <> p_name), '|') AS candidates_text,
       array_to_string(w || CASE WHEN list_contains(w, brand) OR brand IS NULL THEN [] ELSE [brand] END, '|') AS appended_text,
       coalesce(brand, p_type) AS filled, array_to_string(list_transform(w, lambda x: '"' || x || '"'), ', ') AS quoted,
       array_to_string(list_sort(list_distinct(w || [p_type])), '|') AS merged_text
FROM u
""")
def list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, w = F.col("p_partkey"), F.split("p_name", " ")
    brand = F.when(k % 5 != 0, F.col("p_brand"))
    raw = F.array(F.concat(F.lit(" "), w[0]), F.concat(w[1], F.lit("\t")), F.lit(""), F.lit(None).cast("string"), w[0], F.col("p_name"))
    quoted = F.concat(F.lit("['"), F.array_join(w, "', '"), F.lit("']"))
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", "p_name", "p_type", brand.alias("brand"), w.alias("w"), raw.alias("raw"), quoted.alias("literal"),
        F.when(k % 3 == 0, quoted).when(k % 3 == 1, F.col("p_name")).alias("like"))
    text = lambda c: F.array_join(c, "|")
    return p.select(
        "p_partkey", text(L.split_alias(F.concat("brand", F.lit(", "), "p_type"))).alias("split_text"),
        text(L.listlike("like")).alias("listlike_text"), text(L.clean_concepts("raw")).alias("concepts_text"),
        text(L.clean_aliases("raw", "p_name")).alias("aliases_text"), text(L.long_concepts("raw", 5)).alias("long_text"),
        text(L.candidates("p_name", "raw")).alias("candidates_text"),
        text(L.append_new("w", F.when(F.col("brand").isNotNull(), F.array("brand")))).alias("appended_text"),
        L.fill_if_empty("brand", "p_type").alias("filled"), L.quoted_list("w").alias("quoted"),
        text(L.merge_categories("literal", F.array("p_type"))).alias("merged_text"))


# --------------------------------------------------------------------------
# Row index and batches under a total order
# --------------------------------------------------------------------------
@query("batches", """
SELECT c_custkey, (row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) // 100 AS batch
FROM customer
""")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    return R.batch_number(c, ["c_acctbal", "c_custkey"], 100).select("c_custkey", "batch")


@query("stage_counts", """
SELECT 'documents' AS stage, count(*) AS rows, count(*) FILTER (text = '') AS empty, count(*) FILTER (lang = 'en') AS english FROM documents
UNION ALL
SELECT 'labels', count(*), count(*) FILTER (quality IS NULL), count(*) FILTER (toxic = 1) FROM labels
""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return O.stage_counts("documents", t.documents, empty=F.col("text") == "", english=F.col("lang") == "en").unionByName(
        O.stage_counts("labels", t.labels, empty=F.col("quality").isNull(), english=F.col("toxic") == 1))


@query("top_cited", """
SELECT p_partkey, p_name, p_retailprice FROM part
WHERE regexp_matches(p_name, 'green|blue') OR regexp_matches(p_type, 'BRASS')
ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 25
""")
def top_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part.select(F.col("p_partkey").alias("paperId"), F.col("p_name").alias("title"),
                                          F.col("p_type").alias("abstract"), F.col("p_retailprice").alias("citationCount"))
    top = O.top_cited(p, "green|blue|BRASS", 25)
    return top.select(F.col("paperId").alias("p_partkey"), F.col("title").alias("p_name"), F.col("citationCount").alias("p_retailprice"))


# --------------------------------------------------------------------------
# P4 / F5 / J2 / J4 / J11 / A6 / A11 on rows with loops, empty lists, nulls and missing ends
# --------------------------------------------------------------------------
@query("edge_branches", """
WITH e AS (
  SELECT l_orderkey AS k, CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 4 = 0 THEN l_suppkey + 100000 ELSE l_suppkey END AS src,
         CASE WHEN l_partkey % 5 = 0 THEN l_suppkey WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 10 + 1 END AS dst FROM lineitem),
kept AS (SELECT * FROM e WHERE src IS NULL OR dst IS NULL OR src <> dst),
s AS (SELECT s_suppkey FROM supplier)
SELECT 'loops' AS kind, count(*) AS n FROM e WHERE src = dst
UNION ALL SELECT 'kept', count(*) FROM kept
UNION ALL SELECT 'written', count(*) FROM kept WHERE src IN (FROM s) AND dst IN (FROM s)
UNION ALL SELECT 'dangling', count(*) FROM kept WHERE NOT (coalesce(src IN (FROM s), false) AND coalesce(dst IN (FROM s), false))
UNION ALL SELECT 'missing_ends', count(DISTINCT src) FROM kept WHERE src NOT IN (FROM s)
UNION ALL SELECT 'unmatched', count(*) FROM kept WHERE src IS NULL OR dst IS NULL
UNION ALL SELECT 'null_group', count(*) FROM kept WHERE src IS NULL
UNION ALL SELECT 'failed', count(*) FROM kept WHERE dst IS NULL
""")
def edge_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, p, sup = Tables(spark, sf_dir), F.col("l_partkey"), F.col("l_suppkey")
    e = t.lineitem.select(
        F.when(p % 9 == 0, None).when(p % 4 == 0, sup + 100000).otherwise(sup).alias("src"),
        F.when(p % 5 == 0, sup).when(p % 7 == 0, None).otherwise(p % 10 + 1).alias("dst"))
    kept = e.where(not_self_loop("src", "dst"))
    ok, dangling = J.resolve_endpoints(kept, t.supplier, "src", "s_suppkey", t.supplier, "dst", "s_suppkey")
    stats = A.run_stats(kept, F.col("dst").isNotNull(), F.lit(1)).select(F.lit("failed").alias("kind"), F.col("n_failed").alias("n"))
    nulls = A.frequency(kept, "src").where("src is null").select(F.lit("null_group").alias("kind"), F.col("count").alias("n"))
    counts = G.graph_counts({"loops": e.where("src = dst"), "kept": kept, "written": ok, "dangling": dangling,
                             "missing_ends": J.missing_endpoints(kept, t.supplier, "src", "s_suppkey"),
                             "unmatched": J.unmatched(kept, ["src", "dst"])}).withColumnRenamed("table", "kind")
    return counts.unionByName(stats).unionByName(nulls)


# --------------------------------------------------------------------------
# Paper nodes from seed papers and references
# --------------------------------------------------------------------------
@query("paper_nodes", """
WITH u AS (
  SELECT 'p' || p_partkey AS paperId, p_name AS title, p_brand AS publication, p_type || '|' || p_brand AS cats, 0 AS src, p_partkey AS o FROM part
  UNION ALL
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'p' ELSE 'q' END || l_partkey, 'ref ' || l_partkey, NULL, '', 1, l_orderkey * 10 + l_linenumber FROM lineitem)
SELECT paperId, title, publication, cats FROM u QUALIFY row_number() OVER (PARTITION BY paperId ORDER BY src, o, title) = 1
""")
def paper_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    papers = t.part.select(
        F.concat(F.lit("p"), "p_partkey").alias("paperId"), F.col("p_name").alias("title"), F.col("p_brand").alias("venue"),
        F.array("p_type", "p_brand", "p_type").alias("fieldsOfStudy"), F.col("p_partkey").alias("pos"))
    side = F.when(F.col("l_suppkey") % 2 == 0, "p").otherwise("q")
    refs = t.lineitem.select(F.concat(side, "l_partkey").alias("ref_paper_id"), F.col("l_orderkey").alias("seed_paper_id"),
                             F.concat(F.lit("ref "), "l_partkey").alias("title"),
                             (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return P.build_paper_nodes(papers, refs).select("paperId", "title", "publication", F.array_join("categories", "|").alias("cats"))


# --------------------------------------------------------------------------
# Mentions of concepts, their edges and scores
# --------------------------------------------------------------------------
def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    w = F.split("p_name", " ")
    papers = p.select(F.concat(F.lit("p"), "p_partkey").alias("paperId"), F.col("p_name").alias("title"),
                      F.col("p_type").alias("abstract"), F.col("p_partkey").alias("pos"),
                      F.array(w[0], F.concat(F.lit(" "), w[1]), F.lit(" "), w[0]).alias("proposed_concepts"),
                      F.when(F.col("p_partkey") % 3 != 0, F.array(w[1], F.col("p_brand"))).alias("prerequisite_concepts"))
    return P.concept_mentions(papers)


@query("mention_edges", """
WITH w AS (SELECT 'p' || p_partkey AS paperId, p_name AS title, string_split(p_name, ' ') AS w, p_partkey, p_brand FROM part)
SELECT DISTINCT paperId, concept, edge_type, title, ok, strength, reason FROM (
  SELECT paperId, title, w[1] AS concept, 'ABOUT' AS edge_type, w FROM w
  UNION ALL SELECT paperId, title, w[2], 'ABOUT', w FROM w
  UNION ALL SELECT paperId, title, w[2], 'IN', w FROM w WHERE p_partkey % 3 <> 0
  UNION ALL SELECT paperId, title, p_brand, 'IN', w FROM w WHERE p_partkey % 3 <> 0),
  LATERAL (SELECT length(concept) % 4 AS m),
  LATERAL (SELECT m <> 3 AS ok, CASE m WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 END AS strength, CASE m WHEN 1 THEN 'because' END AS reason)
""")
def mention_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's answers are a table derived from the concepts: too strong, fine, without a number, or no JSON."""
    mentions = _mentions(spark, sf_dir)
    m = F.length("concept") % 4
    raw = F.when(m == 0, F.lit('say {"strength": 7, "reason": " "} so')) \
        .when(m == 1, F.lit('```json\n{"strength": 0.25, "reason": " because  "}\n```')) \
        .when(m == 2, F.lit('{"strength": "high"')).otherwise(F.lit("no idea"))
    keys = P.make_edges_from_mentions(mentions)
    answers = None
    for edges, template in zip(keys, (E.ABOUT_EDGE_TEMPLATE, E.IN_EDGE_TEMPLATE)):
        system = E.render(template, {"PAPER_TITLE": F.col("title"), "PAPER_ABSTRACT": F.col("abstract"), "CONCEPT": F.col("concept")})
        a = edges.select(E.prompt_key(system, F.lit(E.USER_RAW_JSON)).alias("prompt_key"), raw.alias("raw"))
        answers = a if answers is None else answers.unionByName(a)
    out = E.build_scored_edges(mentions, responses=answers.distinct())
    return out.select("paperId", "concept", "edge_type", "title", F.col("edge_ok").alias("ok"), "strength", "reason")


# --------------------------------------------------------------------------
# A dataset's nodes get aliases, its edges scores; rejected rows
# --------------------------------------------------------------------------
@query("dataset_enrichment", """
WITH n AS (SELECT DISTINCT p_brand AS name, length(p_brand) + ascii(right(p_brand, 1)) AS m FROM part),
e AS (SELECT DISTINCT p_brand AS name, p_type AS prereq_name, length(p_type) % 3 AS m FROM part)
SELECT 'node' AS kind, name, NULL AS prereq_name, CASE WHEN m % 2 = 0 THEN lower(name) ELSE '' END AS alias_text,
       NULL::DOUBLE AS strength, m % 2 = 0 AS ok FROM n
UNION ALL
SELECT 'edge', name, prereq_name, NULL, CASE WHEN m = 0 THEN 0.5 END, m <> 2 FROM e
UNION ALL
SELECT 'rejected', name, prereq_name, NULL, NULL, false FROM e WHERE m = 2
""")
def dataset_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    nodes = part.select(F.col("p_brand").alias("name")).distinct()
    edges = part.select(F.col("p_brand").alias("name"), F.col("p_type").alias("prereq_name")).distinct()
    m = (F.length("name") + F.ascii(F.right("name", F.lit(1)))) % 2
    system = E.render(E.ALIAS_TEMPLATE, {"INPUT_TITLE": F.col("name")})
    alias = nodes.select(E.prompt_key(system, F.lit(E.USER_ALIAS)).alias("prompt_key"), F.when(m == 0, F.concat(
        F.lit('<think>x</think>{"alias": [" '), F.lower("name"), F.lit('", "", "'), "name", F.lit('"]}'))).otherwise("[]").alias("raw"))
    j = F.length("prereq_name") % 3
    system = E.render(E.PREREQ_EDGE_TEMPLATE, {"TARGET": F.col("name"), "PREREQ": F.col("prereq_name")})
    score = edges.select(E.prompt_key(system, F.lit(E.USER_RAW_JSON)).alias("prompt_key"),
                         F.when(j == 0, '{"strength": 0.5}').when(j == 1, '{"reason": "r"}').otherwise("?").alias("raw"))
    out = K.enrich_dataset(nodes, edges, responses=alias.unionByName(score))
    null = lambda t: F.lit(None).cast(t)
    return (out.nodes.select(F.lit("node").alias("kind"), "name", null("string").alias("prereq_name"),
                             F.array_join("alias", "|").alias("alias_text"), null("double").alias("strength"), F.col("alias_ok").alias("ok"))
            .unionByName(out.edges.select(F.lit("edge").alias("kind"), "name", "prereq_name", null("string").alias("alias_text"),
                                          "strength", F.col("edge_ok").alias("ok")))
            .unionByName(out.rejected_edges.select(F.lit("rejected").alias("kind"), "name", "prereq_name",
                                                   null("string").alias("alias_text"), null("double").alias("strength"),
                                                   F.lit(False).alias("ok"))))


# --------------------------------------------------------------------------
# ABOUT edges through the alias map, then a one-hop scan
# --------------------------------------------------------------------------
@query("about_graph", f"""
WITH kw AS (SELECT n_nationkey AS o, n_name AS name, [lower(substr(n_name, 1, 3)), ' ' || n_name || 'X '] AS alias FROM nation),
terms AS (SELECT lower(trim(name)) AS term, name, o * 10 AS r FROM kw
          UNION ALL SELECT lower(trim(alias[1])), name, o * 10 + 1 FROM kw UNION ALL SELECT lower(trim(alias[2])), name, o * 10 + 2 FROM kw),
amap AS (SELECT term, arg_max(name, r) AS name FROM terms GROUP BY term),
e AS (SELECT o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1000000000 ELSE 0 END AS paper, o_orderkey AS pos, o_totalprice AS strength,
             CASE o_orderkey % 4 WHEN 0 THEN upper(substr(n_name, 1, 3)) WHEN 1 THEN ' ' || n_name WHEN 2 THEN n_name || 'x' ELSE 'unknown' END AS concept
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT e.*, amap.name FROM e LEFT JOIN amap ON lower(trim(concept)) = term),
w AS (SELECT c_name AS source, m.name AS target, arg_max(strength, pos) AS strength FROM m JOIN customer ON paper = c_custkey WHERE m.name IS NOT NULL GROUP BY ALL)
SELECT source, target, strength FROM w
UNION ALL SELECT 'failed', '{G.NO_MATCH_REASON}', count(*)::DOUBLE FROM m WHERE name IS NULL
UNION ALL SELECT 'dangling', '', count(*)::DOUBLE FROM m WHERE name IS NOT NULL AND pos % 5 = 0
""")
def about_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    kw = t.nation.select(F.col("n_nationkey").alias("o"), F.col("n_name").alias("name"),
                         F.array(F.lower(F.substring("n_name", 1, 3)), F.concat(F.lit(" "), "n_name", F.lit("X "))).alias("alias"))
    amap = G.alias_map(kw, order=[F.col("o")])
    k = F.col("o_orderkey") % 4
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("o_custkey") + F.when(F.col("o_orderkey") % 5 == 0, 1000000000).otherwise(0)).alias("paper"), F.col("o_orderkey").alias("pos"), F.col("o_totalprice").alias("strength"),
        F.when(k == 0, F.upper(F.substring("n_name", 1, 3))).when(k == 1, F.concat(F.lit(" "), "n_name"))
        .when(k == 2, F.concat("n_name", F.lit("x"))).otherwise("unknown").alias("concept"))
    matched, failed = G.map_concepts(rows, amap)
    papers = t.customer
    edges, dangling = G.upsert_edges(matched.select("paper", "keyword_name", "strength", "pos"), "paper", "keyword_name", ["pos"],
                                     papers, "c_custkey", kw, "name")
    hop = G.one_hop(edges, "paper", "keyword_name", papers, "c_custkey", "c_name", kw, "name", "name", ["strength"])
    bad = failed.groupBy("reason").agg(F.count(F.lit(1)).cast("double").alias("strength")).select(
        F.lit("failed").alias("source"), F.col("reason").alias("target"), "strength")
    gone = dangling.agg(F.count(F.lit(1)).cast("double").alias("strength")).select(
        F.lit("dangling").alias("source"), F.lit("").alias("target"), "strength")
    return hop.unionByName(bad).unionByName(gone)


# --------------------------------------------------------------------------
# Category lookup from responses, then the fill
# --------------------------------------------------------------------------
@query("category_lookup", f"""
WITH n AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN 'kept' END AS link FROM customer),
hit AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'Page ' || c_custkey END AS page FROM n)
SELECT c_custkey, CASE WHEN link IS NULL AND page IS NOT NULL THEN '{X.WIKI_PREFIX}' || {S.quote("replace(page, ' ', '_')", '')} ELSE link END AS link,
       CASE WHEN page IS NULL THEN '' ELSE array_to_string(list_sort(list_distinct(['Seg ' || c_mktsegment, 'All'])), '|') END AS cats
FROM n JOIN hit USING (c_custkey) JOIN customer USING (c_custkey)
""")
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the names is a page title, a third is redirected, a third missing; each page in two parts."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    page = F.when(k % 3 == 1, F.concat(F.lit("Page "), k.cast("string"))).otherwise(F.col("c_name"))
    void = F.lit(None).cast("string")
    cat = lambda *xs: F.array(*[F.struct(F.concat(F.lit("Category:"), x).alias("title")) for x in xs])

    def part(i: int, cats: Column) -> DataFrame:
        key = F.when(k % 3 == 2, F.lit("-1")).otherwise(k.cast("string"))
        entry = F.struct(page.alias("title"), void.alias("missing"), cats.alias("categories"))
        redirect = F.when(k % 3 == 1, F.array(F.struct(F.lower("c_name").alias("from"), page.alias("to"))))
        query = F.struct(redirect.alias("redirects"), F.lit(None).cast(C.FROM_TO).alias("normalized"),
                         F.create_map(key, entry).alias("pages"))
        return c.select(k.alias("batch_id"), F.lit(i).cast("bigint").alias("part"), query.alias("query"))
    responses = part(0, cat(F.concat(F.lit("Seg "), "c_mktsegment"))).unionByName(part(1, cat(F.lit("All"), F.lit(""))))
    nodes = c.select("c_custkey", F.col("c_name").alias("name"), F.when(k % 4 == 0, "kept").alias("link"),
                     L.empty_str_array().alias("categories"))
    out = C.fill_from_lookup(nodes, C.page_hits(responses, nodes), "name", "link", "categories")
    return out.select("c_custkey", "link", F.array_join("categories", "|").alias("cats"))


# --------------------------------------------------------------------------
# Tables written to the shared folder and read back
# --------------------------------------------------------------------------
@query("csv_round_trip", """
SELECT doc_id, md5(CASE WHEN doc_id % 6 = 0 THEN 'line "one"' || chr(10) || text WHEN doc_id % 6 = 1 THEN NULL ELSE text END) AS text_md5,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS lang,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'a"b|' || source || ', x' END AS items FROM documents
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.session import scratch_path
    k = F.col("doc_id")
    d = Tables(spark, sf_dir).documents.select(
        "doc_id", F.when(k % 6 == 0, F.concat(F.lit('line "one"\n'), "text")).when(k % 6 == 1, F.lit("#N/A")).otherwise(F.col("text")).alias("text"),
        F.when(k % 5 == 0, F.lit("NA")).otherwise(F.col("lang")).alias("lang"),
        F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit('a"b'), F.concat("source", F.lit(", x")))).alias("items"))
    path = scratch_path(spark, "csv-round-trip") + "-" + sf_dir.rstrip("/").rsplit("/", 1)[-1]
    files.write_csv(d, path)
    back = files.read_csv(spark, path, "doc_id bigint, text string, lang string, items string", order=False)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", F.array_join(L.parse_to_list("items"), "|").alias("items"))


@query("saved_references", """
SELECT c_custkey AS seed_paper_id, CAST(i AS BIGINT) AS ref_pos, 'r' || ((c_custkey * 7 + i) % 1000) AS ref_paper_id, i % 3 = 0 AS isInfluential
FROM customer, range(0, 150) t(i)
""")
def saved_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response of 150 references for each customer, as JSON lines; every reference is read.
    A file holds about 2,000 responses."""
    from noema.session import scratch_path
    key = F.col("c_custkey")
    refs = F.transform(F.sequence(F.lit(0), F.lit(149)), lambda i: F.struct(
        F.array().cast("array<string>").alias("contexts"), (i % 3 == 0).alias("isInfluential"),
        F.struct(F.concat(F.lit("r"), ((key * 7 + i) % 1000).cast("string")).alias("paperId")).alias("citedPaper")))
    customers = R.spread(Tables(spark, sf_dir).customer.select(key), 2_000)
    o = customers.select(key.cast("string").alias("seed_paper_id"), refs.alias("data"))
    path = scratch_path(spark, "saved-references") + "-" + sf_dir.rstrip("/").rsplit("/", 1)[-1]
    files.write_json_lines(o, path)
    out = files.read_reference_responses(spark, path)
    return out.select(F.col("seed_paper_id").cast("bigint").alias("seed_paper_id"), F.col("ref_pos").cast("bigint").alias("ref_pos"),
                      "ref_paper_id", "isInfluential")


# --------------------------------------------------------------------------
# Damaged titles repaired, scanned and counted with the null group
# --------------------------------------------------------------------------
@query("quality_branches", """
WITH d AS (SELECT CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN 'Alpha' || chr(65533) || 'beta pruning'
                       WHEN doc_id % 10 = 2 THEN 'G' || chr(65533) || 'del''s completeness theorem'
                       WHEN doc_id % 10 = 3 THEN lang || chr(65533) WHEN doc_id % 10 = 4 THEN lang || 'é' ELSE lang END AS t FROM documents),
r AS (SELECT CASE t WHEN 'Alpha' || chr(65533) || 'beta pruning' THEN 'Alpha–beta pruning'
                    WHEN 'G' || chr(65533) || 'del''s completeness theorem' THEN 'Gödel''s completeness theorem' ELSE t END AS title FROM d)
SELECT title, count(*) AS n, coalesce(contains(title, chr(65533)), false) AS damaged,
       coalesce(regexp_matches(title, '[^\\x00-\\x7F]'), false) AS non_ascii FROM r GROUP BY title
""")
def quality_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    t = F.when(k % 9 == 0, None).when(k % 10 == 1, "Alpha�beta pruning").when(k % 10 == 2, "G�del's completeness theorem") \
        .when(k % 10 == 3, F.concat("lang", F.lit("�"))).when(k % 10 == 4, F.concat("lang", F.lit("é"))).otherwise(F.col("lang"))
    d = O.repair_values(Tables(spark, sf_dir).documents.select(t.alias("title")), K.REPAIR_MAP, ["title"])
    return A.frequency(d, "title").select("title", F.col("count").alias("n"),
                                          F.coalesce(X.has_replacement_char("title"), F.lit(False)).alias("damaged"),
                                          F.coalesce(X.has_non_ascii("title"), F.lit(False)).alias("non_ascii"))


# --------------------------------------------------------------------------
# Concepts and descriptions of papers
# --------------------------------------------------------------------------
@query("paper_enrichment", """
WITH p AS (SELECT p_partkey, p_brand, length(p_name) % 4 AS m FROM part)
SELECT p_partkey, CASE WHEN m = 0 THEN 'A|b' ELSE '' END AS proposed, CASE WHEN m = 0 THEN 'x' ELSE '' END AS prerequisite,
       m IN (0, 2) AS kc_ok, CASE m WHEN 0 THEN 'two words.' WHEN 1 THEN 'done!' ELSE '' END AS description, m <> 3 AS desc_ok FROM p
""")
def paper_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = Tables(spark, sf_dir).part.select(F.col("p_partkey").alias("pos"), F.concat(F.lit(" "), "p_name").alias("title"),
                                               F.col("p_type").alias("abstract"), F.array("p_brand", F.lit(" ")).alias("categories"))
    clean = papers.select(X.strip("title").alias("t"), F.col("abstract").alias("a"), X.categories_text("categories").alias("c")).distinct()
    m = F.length("t") % 4
    concepts = E.render(E.CONCEPTS_TEMPLATE, {"INPUT_TITLE": F.col("t"), "INPUT_ABSTRACT": F.col("a")})
    describe = E.render(E.DESCRIPTION_TEMPLATE, {"INPUT_TITLE": F.col("t"), "INPUT_ABSTRACT": F.col("a"), "INPUT_CATEGORIES": F.col("c")})
    answers = clean.select(E.prompt_key(concepts, F.lit(E.USER_CONCEPTS)).alias("prompt_key"), F.when(
        m == 0, '{"proposed_concepts": [" A ", "", "A", "b", 3], "prerequisite_concepts": ["x"]} ok').when(
        m == 1, '{"proposed_concepts": ["A"]}').when(
        m == 2, '```json\n{"proposed_concepts": [], "prerequisite_concepts": []\n```').otherwise("none").alias("raw")).unionByName(
        clean.select(E.prompt_key(describe, F.lit(E.USER_DESCRIPTION)).alias("prompt_key"), F.when(
            m == 0, '{"description": "  two\\n words"}').when(m == 1, '<think>{"description": 1}</think>{"description": "done!"}').when(
            m == 2, '{"description": ""}').otherwise('{"description": null}').alias("raw"))).dropDuplicates(["prompt_key"])
    out = E.add_concepts(E.add_description(papers, responses=answers), responses=answers)
    return out.select(F.col("pos").alias("p_partkey"), F.array_join("proposed_concepts", "|").alias("proposed"),
                      F.array_join("prerequisite_concepts", "|").alias("prerequisite"), "kc_ok", "description", "desc_ok")


# --------------------------------------------------------------------------
# Ranked prerequisites of articles among their links
# --------------------------------------------------------------------------
@query("article_prerequisites", f"""
WITH a AS (SELECT page_id AS pos, {S.title_from_url('url')} AS title, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n FROM pages),
ok AS (SELECT pos, title FROM a WHERE n > 0 AND pos % 5 <> 0 AND length(title) % 3 = 0)
SELECT pos, title, 1 AS rank, 'T' AS prerequisite_topic, '' AS rationale FROM ok
UNION ALL SELECT pos, title, 2, 'U', 'why' FROM ok UNION ALL SELECT pos, title, 0, '', 'no topic' FROM ok
""")
def article_prerequisites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth article has no list of links; the model's answers depend on the title."""
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    articles = Tables(spark, sf_dir).pages.select(
        F.col("page_id").alias("pos"), X.title_from_url("url").alias("title"),
        F.when(F.col("page_id") % 5 == 0, "none").otherwise(F.concat(
            F.lit("["), F.array_join(F.transform(hrefs, lambda h: F.concat(F.lit("'"), h, F.lit("'"))), ", "), F.lit("]"))).alias("links"))
    user = E.render(E.ARTICLE_USER, {"INPUT_TITLE": F.col("title"), "INPUT_LINKS": L.quoted_list(L.literal_or_empty("links"))})
    m = F.length("title") % 3
    answers = articles.select(E.prompt_key(F.lit(E.ARTICLE_SYSTEM), user).alias("prompt_key"), F.when(
        m == 0, 'Here:\n```json\n{"prerequisites": [{"rank": 1, "topic": "T"}, {"topic": "U", "rationale": "why", "rank": 2.0}, '
                '"odd", {"rationale": "no topic"}]}\n```').when(m == 1, "nothing").otherwise('{"prerequisites": []}').alias("raw"))
    _, flat = E.article_prerequisites(articles, responses=answers.dropDuplicates(["prompt_key"]))
    return flat.select("pos", "title", "rank", "prerequisite_topic", "rationale")


# --------------------------------------------------------------------------
# Reference edges scored with seed and reference context
# --------------------------------------------------------------------------
@query("reference_scores", """
WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS seed, 'n' || (o_orderkey % 7) AS ref, o_orderkey AS pos, o_orderkey % 2 = 0 AS inf FROM orders),
f AS (SELECT seed, ref, arg_min(inf, pos) AS inf FROM r GROUP BY ALL)
SELECT 'REF_BY' AS name, ref AS ref_paper_id, seed AS seed_paper_id, inf AS "isInfluential",
       CASE length(seed) % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.25 END AS strength, length(seed) % 3 <> 2 AS edge_ok FROM f
""")
def reference_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds come twice, and the last row is the one in the prompt; all five contexts are."""
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("paperId"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("abstract"),
                          F.col("c_custkey").cast("bigint").alias("pos"))
    seeds = c.unionByName(c.withColumn("title", F.concat("title", F.lit(" v2"))).withColumn("pos", F.col("pos") + 10 ** 12))
    contexts = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.concat(F.lit("context "), i.cast("string")))
    ref = F.concat(F.lit("n"), (F.col("o_orderkey") % 7).cast("string"))
    refs = t.orders.select(F.col("o_custkey").alias("seed_paper_id"), ref.alias("ref_paper_id"), F.concat(F.lit("title "), ref).alias("title"),
                           F.concat(F.lit("about "), ref).alias("abstract"), F.array(F.lit("method")).alias("intents"),
                           (F.col("o_orderkey") % 2 == 0).alias("isInfluential"), contexts.alias("contexts"), F.col("o_orderkey").alias("pos"))
    first = refs.groupBy(F.col("seed_paper_id").cast("string").alias("s"), "ref_paper_id").agg(
        F.min_by("isInfluential", "pos").alias("inf"), F.any_value("title").alias("rt"), F.any_value("abstract").alias("ra"))
    ctx = c.select(F.col("paperId").cast("string").alias("p"), F.concat("title", F.lit(" v2")).alias("st"), F.col("abstract").alias("sa"))
    system = E.render(E.REF_EDGE_TEMPLATE, {
        "TARGET_TITLE": F.col("st"), "TARGET_ABSTRACT": F.col("sa"), "REF_TITLE": F.col("rt"), "REF_ABSTRACT": F.col("ra"),
        "INTENTS": F.lit('["method"]'), "IS_INF": F.when(F.col("inf"), "True").otherwise("False"),
        "CONTEXTS": F.lit('["context 1","context 2","context 3","context 4","context 5"]')})
    m = F.length("s") % 3
    answers = first.join(ctx, F.col("s") == F.col("p")).select(
        E.prompt_key(system, F.lit(E.USER_RAW_JSON)).alias("prompt_key"),
        F.when(m == 0, '{"strength": 7}').when(m == 1, '{"strength": 0.25}').otherwise('{"strength": "0.5"}').alias("raw"))
    scored = E.score_ref_edges(refs, seeds, responses=answers.dropDuplicates(["prompt_key"]))
    return P.finalize_ref_by_edges(scored).select("name", "ref_paper_id", "seed_paper_id", "isInfluential", "strength", "edge_ok")


# --------------------------------------------------------------------------
# Papers upserted by title, blanks set aside, ids lost to a title
# --------------------------------------------------------------------------
@query("paper_upsert", """
WITH r AS (SELECT 'p' || p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN ' ' WHEN p_partkey % 51 = 0 THEN NULL ELSE p_name END AS title,
                  p_partkey AS pos, p_brand AS publication FROM part),
k AS (SELECT title, arg_max(id, pos) AS id, arg_max(publication, pos) AS publication FROM r WHERE trim(title) <> '' GROUP BY title)
SELECT 'node' AS kind, title AS name, id, publication FROM k
UNION ALL SELECT 'blank', title, id, publication FROM r WHERE title IS NULL OR trim(title) = ''
UNION ALL SELECT 'collapsed', r.title, r.id, NULL FROM r JOIN k ON r.title = k.title WHERE r.id <> k.id
""")
def paper_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.plans.graph_build import collapsed_paper_ids, upsert_papers
    k = F.col("p_partkey")
    rows = Tables(spark, sf_dir).part.select(
        F.concat(F.lit("p"), "p_partkey").alias("paperId"), F.when(k % 50 == 0, " ").when(k % 51 == 0, None).otherwise(F.col("p_name")).alias("title"),
        k.alias("pos"), F.col("p_brand").alias("publication"), F.lit("[]").alias("categories"))
    nodes, blank = upsert_papers(rows)
    out = lambda df, kind, pub=True: df.select(F.lit(kind).alias("kind"), "name", F.col("paperId").alias("id"),
                                               (F.col("publication") if pub else F.lit(None).cast("string")).alias("publication"))
    return out(nodes, "node").unionByName(out(blank, "blank")).unionByName(out(collapsed_paper_ids(rows, nodes), "collapsed", False))


# --------------------------------------------------------------------------
# P9 listings, O2, O3, P12: sorted damaged and non-ASCII values, first rows
# --------------------------------------------------------------------------
@query("listings", """
WITH d AS (SELECT doc_id, source || CASE doc_id % 3 WHEN 0 THEN chr(65533) WHEN 1 THEN 'é' ELSE '' END AS v FROM documents)
SELECT DISTINCT 'damaged' AS kind, v, NULL::BIGINT AS doc_id FROM d WHERE contains(v, chr(65533))
UNION ALL SELECT DISTINCT 'non_ascii', v, NULL FROM d WHERE regexp_matches(v, '[^\x00-\x7F]')
UNION ALL SELECT DISTINCT 'value', v, NULL FROM d
UNION ALL SELECT * FROM (SELECT 'head', v, doc_id FROM d ORDER BY v, doc_id LIMIT 5)
""")
def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    tail = F.array_join(truthy_items(F.array(F.when(k % 3 == 0, "�").when(k % 3 == 1, "é"), F.lit(""))), "")
    d = Tables(spark, sf_dir).documents.select("doc_id", F.concat("source", tail).alias("v"))
    out = lambda df, kind, doc: df.select(F.lit(kind).alias("kind"), "v", doc.cast("bigint").alias("doc_id"))
    none = F.lit(None)
    return (out(K.bad_values(d, "v"), "damaged", none).unionByName(out(K.non_ascii_values(d, "v"), "non_ascii", none))
            .unionByName(out(O.sorted_distinct(d, "v"), "value", none))
            .unionByName(out(O.sample_rows(d, ["v", "doc_id"], 5), "head", F.col("doc_id"))))
