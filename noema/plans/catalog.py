"""Query catalog over the driver tables.

Each entry re-expresses one reference operator (ids from the survey) on the
TPC-H-style driver tables: a Spark function ``(spark, sf_dir) -> DataFrame``
built from the library operators, and a DuckDB SQL string computing the same
result for the correctness check.  Column names match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from noema.functions import lists as L, text as X
from noema.functions.predicates import not_self_loop
from noema.operators import aggregates as A, joins as J, rows as R
from noema.plans import _sql as S
from noema.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Anchor patterns over the page HTML, and the failure text of the
# alias-map join.
HREF_RE = '<a href="([^"]*)"'
ANCHOR_TEXT_RE = '<a href="[^"]*">([^<]*)</a>'
NO_MATCH_REASON = "No matching Keyword node found in alias map"

# A total order over lineitem rows (the table has no unique row key).
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE_ORDER_SQL = ", ".join(LINE_ORDER)


# --------------------------------------------------------------------------
# Top-k references per seed
# --------------------------------------------------------------------------
@query("topk_refs", f"""
WITH refs AS (
  SELECT l_orderkey AS seed, l_partkey AS ref, l_returnflag = 'R' AS inf, {_LINE_ORDER_SQL}
  FROM lineitem WHERE l_partkey IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {_LINE_ORDER_SQL}) = 1
), scored AS (
  SELECT r.*, p.p_name AS title, p.p_retailprice AS citation_count,
         coalesce(p.p_retailprice, 0) AS cit
  FROM refs r LEFT JOIN part p ON p.p_partkey = r.ref
)
SELECT seed AS seed_paper_id, ref AS ref_paper_id, title, inf AS is_influential, citation_count,
       row_number() OVER (PARTITION BY seed ORDER BY inf DESC, cit DESC, {_LINE_ORDER_SQL}) AS rank
FROM scored QUALIFY rank <= 5
""")
def topk_refs(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem.where(F.col("l_partkey").isNotNull()).select(
        F.col("l_orderkey").alias("seed"), F.col("l_partkey").alias("ref"),
        (F.col("l_returnflag") == "R").alias("inf"), F.struct(*LINE_ORDER).alias("pos"))
    first = R.first_per_key(li, ["seed", "ref"], ["pos"])                       # W3
    details = t.part.select(F.col("p_partkey").alias("ref"), F.col("p_name").alias("title"),
                            F.col("p_retailprice").alias("citation_count"))
    scored = first.join(details, "ref", "left") \
                  .withColumn("cit", F.coalesce("citation_count", F.lit(0.0)))   # J8
    top = R.top_k_per_key(scored, ["seed"], [F.desc("inf"), F.desc("cit"), F.asc("pos")], k)  # W1
    return top.select(F.col("seed").alias("seed_paper_id"), F.col("ref").alias("ref_paper_id"),
                      "title", F.col("inf").alias("is_influential"), "citation_count",
                      F.col("rank").cast("long").alias("rank"))


# --------------------------------------------------------------------------
# First row per key under a total order
# --------------------------------------------------------------------------
_DEDUP_ORDER = ["l_shipdate"] + [c for c in LINE_ORDER if c != "l_shipdate"]


@query("dedup_first", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {", ".join(_DEDUP_ORDER)}) = 1
""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    first = R.first_per_key(li.select("l_orderkey", "l_partkey", *[c for c in _DEDUP_ORDER if c != "l_partkey"]),
                            ["l_orderkey", "l_partkey"], _DEDUP_ORDER)
    return first.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                        "l_extendedprice", "l_returnflag")


# --------------------------------------------------------------------------
# Concept → sorted prerequisite list → edges without self loops
# --------------------------------------------------------------------------
def _page_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    return pages.select(X.title_from_url("url").alias("name"),
                        F.regexp_extract_all("html", F.lit(HREF_RE), 1).alias("hrefs"))


def _prereq_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _page_concepts(spark, sf_dir)
    rows = c.select("name", F.explode_outer("hrefs").alias("h")) \
            .select("name", F.regexp_replace("h", "^/", "").alias("prereq"))
    lists = A.grouped_sorted_distinct(rows, "name", "prereq", "prereqs")          # A1
    edges = lists.select("name", F.posexplode_outer("prereqs").alias("i", "prereq_name"))  # F5
    return edges.where(not_self_loop("name", "prereq_name")).select(             # P4
        "name", "prereq_name", (F.col("i") + 1).cast("long").alias("prereq_rank"))


_PREREQ_CTE = f"""
c AS (
  SELECT {S.title_from_url('url')} AS name,
         regexp_extract_all(html, '{HREF_RE}', 1) AS hrefs
  FROM pages
), r AS (
  SELECT DISTINCT name, {S.strip("regexp_replace(h, '^/', '')")} AS prereq
  FROM (SELECT name, unnest(hrefs) AS h FROM c)
), ranked AS (
  SELECT name, prereq, row_number() OVER (PARTITION BY name ORDER BY prereq) AS prereq_rank FROM r
), edges AS (
  SELECT name, prereq AS prereq_name, prereq_rank FROM ranked WHERE name <> prereq
  UNION ALL
  SELECT DISTINCT name, NULL, NULL FROM c WHERE name NOT IN (SELECT name FROM r)
)"""


@query("concept_prereqs", f"WITH {_PREREQ_CTE}\nSELECT name, prereq_name, prereq_rank FROM edges")
def concept_prereqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prereq_edges(spark, sf_dir)


# --------------------------------------------------------------------------
# Orphan prerequisites promoted to nodes
# --------------------------------------------------------------------------
@query("orphan_promote", f"""
WITH {_PREREQ_CTE},
names AS (SELECT DISTINCT name FROM edges WHERE name IS NOT NULL),
orphans AS (SELECT DISTINCT prereq_name AS name FROM edges WHERE prereq_name IS NOT NULL
            EXCEPT SELECT name FROM names)
SELECT name, {S.name_link('name')} AS link, false AS is_orphan FROM names
UNION ALL
SELECT name, {S.name_link('name')} AS link, true AS is_orphan FROM orphans
""")
def orphan_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _prereq_edges(spark, sf_dir)
    names = edges.where(F.col("name").isNotNull()).select("name").distinct()
    orphans = J.promote_orphans(edges, "name", "prereq_name").select(F.col("value").alias("name"))
    return (names.select("name", X.name_link("name").alias("link"), F.lit(False).alias("is_orphan"))
            .unionByName(orphans.select("name", X.name_link("name").alias("link"),
                                        F.lit(True).alias("is_orphan"))))


# --------------------------------------------------------------------------
# Topic ids → names under two roles
# --------------------------------------------------------------------------
@query("id_to_name_twice", f"""
WITH topics AS (
  SELECT n_nationkey AS topic_id,
         CASE WHEN r_name = 'AFRICA' THEN NULL
              ELSE '{X.WIKI_PREFIX}' || n_name || CASE WHEN n_nationkey % 3 = 0 THEN '/?x=1#top' ELSE '' END
         END AS link
  FROM nation JOIN region ON n_regionkey = r_regionkey
), bad AS (SELECT topic_id FROM topics WHERE link IS NULL),
ann AS (
  SELECT s_nationkey AS src, c_nationkey AS tgt
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE l_returnflag = 'R'
), kept AS (
  SELECT * FROM ann WHERE src NOT IN (SELECT topic_id FROM bad) AND tgt NOT IN (SELECT topic_id FROM bad)
), nodes AS (
  SELECT topic_id AS id, {S.title_from_url('link')} AS name FROM topics
  WHERE topic_id NOT IN (SELECT topic_id FROM bad)
)
SELECT t.name AS name, s.name AS prereq_name, count(*) AS n_edges,
       (t.name IS NULL OR s.name IS NULL) AS unmatched
FROM kept LEFT JOIN nodes s ON kept.src = s.id LEFT JOIN nodes t ON kept.tgt = t.id
GROUP BY ALL
""")
def id_to_name_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    topics = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("topic_id"),
        F.when(F.col("r_name") == "AFRICA", F.lit(None).cast("string")).otherwise(
            F.concat(F.lit(X.WIKI_PREFIX), F.col("n_name"),
                     F.when(F.col("n_nationkey") % 3 == 0, F.lit("/?x=1#top")).otherwise(F.lit(""))))
        .alias("wikipedia_link"))
    # orders ⋈ customer first (order-sized), so lineitem is shuffled once, by order key
    order_nation = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "c_nationkey")
    ann = (t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag")
           .join(t.supplier.select("s_suppkey", "s_nationkey"),
                 F.col("l_suppkey") == F.col("s_suppkey"))
           .join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
           .select(F.col("s_nationkey").alias("source_topic_id"), F.col("c_nationkey").alias("target_topic_id"),
                   F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("prereq_relation")))
    from noema.plans.kc_datasets import clean_tutorialbank
    res = clean_tutorialbank(                                     # D7: P3 → P5 → J3 → F10 → J1 → J2
        topics.select(F.col("topic_id").cast("long").alias("pos"), "topic_id",
                      F.lit(None).cast("string").alias("topic_name"), "wikipedia_link"),
        ann.withColumn("pos", F.lit(0).cast("long")))
    return res.edges.groupBy("name", "prereq_name").agg(F.count(F.lit(1)).alias("n_edges")) \
                    .withColumn("unmatched", F.col("name").isNull() | F.col("prereq_name").isNull())


# --------------------------------------------------------------------------
# Papers ∪ references with different columns, first per id
# --------------------------------------------------------------------------
@query("paper_union", """
SELECT paperId, title, publication, referenceCount, citationCount,
       CASE WHEN _src = 0 THEN 'paper' ELSE 'ref' END AS source
FROM (
  SELECT CAST(c_nationkey AS VARCHAR) AS paperId, c_name AS title, c_mktsegment AS publication,
         c_acctbal AS citationCount, 0 AS _src, c_custkey AS _ord FROM customer
  UNION ALL BY NAME
  SELECT CAST(s_nationkey AS VARCHAR) AS paperId, s_name AS title, s_suppkey AS referenceCount,
         s_acctbal AS citationCount, 1 AS _src, s_suppkey AS _ord FROM supplier
)
QUALIFY row_number() OVER (PARTITION BY paperId ORDER BY _src, _ord) = 1
""")
def paper_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    papers = t.customer.select(F.col("c_nationkey").cast("string").alias("paperId"),
                               F.col("c_name").alias("title"), F.col("c_mktsegment").alias("publication"),
                               F.col("c_acctbal").alias("citationCount"),
                               F.lit(0).alias("_src"), F.col("c_custkey").alias("_ord"))
    refs = t.supplier.select(F.col("s_nationkey").cast("string").alias("paperId"),
                             F.col("s_name").alias("title"), F.col("s_suppkey").alias("referenceCount"),
                             F.col("s_acctbal").alias("citationCount"),
                             F.lit(1).alias("_src"), F.col("s_suppkey").alias("_ord"))
    u = papers.unionByName(refs, allowMissingColumns=True)                             # U1
    first = R.first_per_key(u, ["paperId"], ["_src", "_ord"])                          # W2
    return first.select("paperId", "title", "publication", "referenceCount", "citationCount",
                        F.when(F.col("_src") == 0, "paper").otherwise("ref").alias("source"))


# --------------------------------------------------------------------------
# A2-A5: KC finalisation (best link, first category, ordered alias union)
# --------------------------------------------------------------------------
_KC_LINK_SQL = (f"CASE WHEN p_size <= 5 THEN NULL WHEN p_size <= 10 THEN '  ' "
                f"WHEN p_size > 40 THEN '{X.WIKI_PREFIX}' || replace(p_type, ' ', '_') || '#sec' || p_size "
                f"ELSE '{X.WIKI_PREFIX}' || replace(p_type, ' ', '_') END")


def kc_mentions(part: DataFrame) -> DataFrame:
    """Parts as concept mentions: (pos, name, link, category, alias)."""
    base = F.concat(F.lit(X.WIKI_PREFIX), F.replace("p_type", F.lit(" "), F.lit("_")))
    return part.select(
        F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") <= 5, F.lit(None).cast("string"))
         .when(F.col("p_size") <= 10, F.lit("  "))
         .when(F.col("p_size") > 40, F.concat(base, F.lit("#sec"), F.col("p_size").cast("string")))
         .otherwise(base).alias("link"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("category"),
        F.array("p_brand", F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")), "p_name", F.lit(""))
         .alias("alias"))


@query("kc_finalize", f"""
WITH r AS (
  SELECT p_partkey AS pos, p_name AS name, {_KC_LINK_SQL} AS link,
         CASE WHEN p_size % 2 = 0 THEN p_type END AS category,
         [p_brand, ' ' || lower(p_type) || ' ', p_name, ''] AS alias
  FROM part
), names AS (SELECT DISTINCT name FROM r),
bl AS (
  SELECT name, link FROM r WHERE link IS NOT NULL AND {S.strip('link')} <> ''
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY contains(link, '#') DESC, length(link) DESC, pos) = 1
), fc AS (
  SELECT name, category FROM r WHERE category IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY pos) = 1
), ex AS (
  SELECT name, pos, i, {S.strip('a')} AS a
  FROM (SELECT name, pos, unnest(alias) AS a, generate_subscripts(alias, 1) AS i FROM r)
), fa AS (
  SELECT name, pos, i, a FROM ex WHERE a IS NOT NULL AND a <> ''
  QUALIFY row_number() OVER (PARTITION BY name, a ORDER BY pos, i) = 1
), al AS (
  SELECT name, coalesce(string_agg(a, '|' ORDER BY pos, i) FILTER (WHERE a <> name), '') AS alias_text,
         count(*) FILTER (WHERE a <> name) AS n_alias
  FROM fa GROUP BY name
)
SELECT n.name, bl.link, fc.category, coalesce(al.alias_text, '') AS alias_text,
       coalesce(al.n_alias, 0) AS n_alias
FROM names n LEFT JOIN bl USING (name) LEFT JOIN fc USING (name) LEFT JOIN al USING (name)
""")
def kc_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    kc = A.finalize_kc_nodes(kc_mentions(Tables(spark, sf_dir).part))
    return kc.select("name", "link", "category", F.array_join("alias", "|").alias("alias_text"),
                     F.size("alias").cast("long").alias("n_alias"))


# --------------------------------------------------------------------------
# Alias map and concept → keyword mapping (matched and failed)
# --------------------------------------------------------------------------
def _keyword_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword nodes: part names (aliases = their words, scanned first, by
    smallest part key), then every anchor target spelling (scanned by text)."""
    t = Tables(spark, sf_dir)
    parts = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("k_long")).select(
        F.col("p_name").alias("name"), F.split("p_name", " ").alias("alias"),
        F.struct(F.lit(0).alias("src"), "k_long", F.lit(None).cast("string").alias("k_str")).alias("scan"))
    targets = _page_concepts(spark, sf_dir).select(F.explode("hrefs").alias("h")) \
        .select(F.regexp_replace("h", "^/", "").alias("name")).distinct()
    anchors = targets.select("name", F.array().cast("array<string>").alias("alias"),
                             F.struct(F.lit(1).alias("src"), F.lit(None).cast("long").alias("k_long"),
                                      F.col("name").alias("k_str")).alias("scan"))
    return parts.unionByName(anchors)


_KEYWORD_CTE = f"""
part_nodes AS (
  SELECT p_name AS name, string_split(p_name, ' ') AS alias, 0 AS src, min(p_partkey) AS k_long,
         NULL::VARCHAR AS k_str FROM part GROUP BY p_name
), anchor_nodes AS (
  SELECT DISTINCT regexp_replace(h, '^/', '') AS name, []::VARCHAR[] AS alias, 1 AS src,
         NULL::BIGINT AS k_long, regexp_replace(h, '^/', '') AS k_str
  FROM (SELECT unnest(regexp_extract_all(html, '{HREF_RE}', 1)) AS h FROM pages)
), nodes AS (SELECT * FROM part_nodes UNION ALL SELECT * FROM anchor_nodes),
terms AS (
  SELECT {S.lower_strip('name')} AS term, name, src, k_long, k_str, 0 AS i
  FROM nodes WHERE name IS NOT NULL AND name <> ''
  UNION ALL
  SELECT {S.lower_strip('a')} AS term, name, src, k_long, k_str, i
  FROM (SELECT name, src, k_long, k_str, unnest(alias) AS a, generate_subscripts(alias, 1) AS i
        FROM nodes WHERE name IS NOT NULL AND name <> '')
  WHERE a IS NOT NULL AND a <> ''
), amap AS (
  SELECT term, name AS keyword_name FROM terms
  QUALIFY row_number() OVER (PARTITION BY term ORDER BY src DESC, k_long DESC, k_str DESC, i DESC) = 1
)"""


@query("alias_map_edges", f"""
WITH {_KEYWORD_CTE},
mentions AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{ANCHOR_TEXT_RE}', 1)) AS concept FROM pages
)
SELECT m.page_id, m.concept, a.keyword_name, a.keyword_name IS NOT NULL AS matched,
       CASE WHEN a.keyword_name IS NULL THEN '{NO_MATCH_REASON}' END AS reason
FROM mentions m LEFT JOIN amap a ON a.term = {S.lower_strip('m.concept')}
""")
def alias_map_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.graph import alias_map, map_concepts
    nodes = _keyword_nodes(spark, sf_dir)
    amap = alias_map(nodes, "name", "alias", [F.col("scan")])                          # G5
    mentions = Tables(spark, sf_dir).pages.select(
        "page_id", F.explode(F.regexp_extract_all("html", F.lit(ANCHOR_TEXT_RE), 1)).alias("concept"))
    matched, failed = map_concepts(mentions, amap, "concept")                           # J9
    return (matched.select("page_id", "concept", "keyword_name", F.lit(True).alias("matched"),
                           F.lit(None).cast("string").alias("reason"))
            .unionByName(failed.select("page_id", "concept", F.lit(None).cast("string").alias("keyword_name"),
                                       F.lit(False).alias("matched"), "reason")))


# --------------------------------------------------------------------------
# Edge upsert, last wins, dangling edges not written
# --------------------------------------------------------------------------
@query("edge_upsert", f"""
SELECT l_orderkey AS src, l_partkey AS dst, l_discount AS strength, l_returnflag AS reason
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND l_partkey IN (SELECT p_partkey FROM part)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
                           ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) = 1
""")
def edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.graph import upsert_edges
    t = Tables(spark, sf_dir)
    edges = t.lineitem.select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"),
                              F.col("l_discount").alias("strength"), F.col("l_returnflag").alias("reason"),
                              F.struct(*LINE_ORDER).alias("pos"))
    written, _dangling = upsert_edges(edges, "src", "dst", ["pos"], t.orders, "o_orderkey",
                                      t.part, "p_partkey")
    return written


# --------------------------------------------------------------------------
# Node overlay, later source replaces the whole node (nulls too)
# --------------------------------------------------------------------------
@query("node_overlay", """
WITH src AS (
  SELECT n_name AS name, c_name AS link, c_mktsegment AS category, 1 AS source_ord, c_custkey AS pos
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT n_name, s_name, NULL, 2, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
SELECT name, link, category, source_ord FROM src
QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_ord DESC, pos DESC) = 1
""")
def node_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.graph import upsert_nodes
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", "n_name")
    cust = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.col("c_name").alias("link"), F.col("c_mktsegment").alias("category"),
        F.lit(1).alias("source_ord"), F.col("c_custkey").alias("pos"))
    supp = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.col("s_name").alias("link"),
        F.lit(None).cast("string").alias("category"),
        F.lit(2).alias("source_ord"), F.col("s_suppkey").alias("pos"))
    nodes = upsert_nodes(None, cust.unionByName(supp).withColumn("_so", F.col("source_ord")),
                         "name", ["_so", "pos"])                                       # G3 order
    return nodes.select("name", "link", "category", "source_ord")


# --------------------------------------------------------------------------
# Tolerant JSON extraction from wrapped model text
# --------------------------------------------------------------------------
def _wrapped_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", "props")
    kind = F.col("event_id") % 5
    raw = (F.when(kind == 0, F.concat(F.lit("Sure! Here it is: "), F.col("props"), F.lit(" hope that helps")))
           .when(kind == 1, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
           .when(kind == 2, F.concat(F.lit('<think>maybe {"k": 0}</think>'), F.col("props")))
           .when(kind == 3, F.rtrim(F.col("props"), F.lit("}")))
           .otherwise(F.col("props")))
    return ev.select("event_id", raw.alias("raw"))


@query("json_repair", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       greatest(0.0, least(1.0, CAST(json_extract(props, '$.k') AS DOUBLE) / 50.0)) AS strength,
       true AS ok
FROM events
""")
def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.functions.jsonx import clamp01, with_parsed
    p = with_parsed(_wrapped_props(spark, sf_dir), "raw", ("is_object", "json"))
    k = F.get_json_object(F.col("p.json"), "$.k")
    return p.select("event_id", k.cast("long").alias("k"),
                    clamp01(k.cast("double") / F.lit(50.0)).alias("strength"),
                    F.col("p.is_object").alias("ok"))


# --------------------------------------------------------------------------
# Link encoders on page titles
# --------------------------------------------------------------------------
_TITLE_RE = "<title>([^<]*)</title>"


@query("wiki_links", f"""
WITH p AS (
  SELECT page_id, {S.title_from_url('url')} AS segment, regexp_extract(html, '{_TITLE_RE}', 1) AS title,
         nullif(regexp_extract(url, '#(.*)$', 1), '') AS frag
  FROM pages
)
SELECT page_id, segment, title,
       {S.name_link('title')} AS link_name,
       '{X.WIKI_PREFIX}' || {S.path_quote('title')} ||
         CASE WHEN frag IS NULL THEN '' ELSE '#' || {S.path_quote('frag')} END AS link_article,
       '{X.WIKI_PREFIX}' || {S.quote("replace(title, ' ', '_')", '')} AS link_page
FROM p
""")
def wiki_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).pages.select(
        "page_id", X.title_from_url("url").alias("segment"),
        F.regexp_extract("html", _TITLE_RE, 1).alias("title"),
        F.nullif(F.regexp_extract("url", "#(.*)$", 1), F.lit("")).alias("frag"))
    return p.select("page_id", "segment", "title", X.name_link("title").alias("link_name"),
                    X.article_link("title", "frag").alias("link_article"),
                    X.page_link("title").alias("link_page"))


# --------------------------------------------------------------------------
# F1 / F2: list literal parsing
# --------------------------------------------------------------------------
@query("lists_parse", """
WITH r AS (SELECT p_partkey, p_type, p_brand, p_size, p_size % 5 AS kind FROM part)
SELECT p_partkey,
       CASE kind WHEN 2 THEN 0 ELSE 2 END::BIGINT AS n_items,
       CASE kind WHEN 0 THEN p_type || '|' || p_brand
                 WHEN 1 THEN p_type || '|' || p_brand
                 WHEN 2 THEN ''
                 WHEN 3 THEN p_type || '|' || CAST(p_size AS VARCHAR)
                 ELSE '[''' || p_type || '''|' || p_brand || ']' END AS items_text,
       CASE WHEN kind IN (0, 3) THEN 2 ELSE 0 END::BIGINT AS n_literal
FROM r
""")
def lists_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    kind = F.col("p_size") % 5
    lit = (F.when(kind == 0, F.concat(F.lit("['"), "p_type", F.lit("', '"), "p_brand", F.lit("']")))
           .when(kind == 1, F.concat("p_type", F.lit(", "), "p_brand"))
           .when(kind == 2, F.lit(""))
           .when(kind == 3, F.concat(F.lit('["'), "p_type", F.lit('", '), F.col("p_size").cast("string"), F.lit("]")))
           .otherwise(F.concat(F.lit("['"), "p_type", F.lit("', "), "p_brand", F.lit("]"))))
    r = part.select("p_partkey", lit.alias("text"))
    items = L.parse_to_list("text")
    return r.select("p_partkey", F.size(items).cast("long").alias("n_items"),
                    F.array_join(items, "|").alias("items_text"),
                    F.size(L.literal_or_empty("text")).cast("long").alias("n_literal"))


# --------------------------------------------------------------------------
# Data-quality scan per (lang, source), nulls kept as groups
# --------------------------------------------------------------------------
@query("quality_scan", """
SELECT lang, source, count(*) AS n_docs,
       count(*) FILTER (WHERE regexp_matches(text, '[^\\x00-\\x7F]')) AS n_non_ascii,
       count(*) FILTER (WHERE contains(text, chr(65533))) AS n_replacement
FROM documents GROUP BY lang, source
""")
def quality_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents
    return d.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(X.has_non_ascii("text")).alias("n_non_ascii"),
        F.count_if(X.has_replacement_char("text")).alias("n_replacement"))


# --------------------------------------------------------------------------
# Exact numeric summary
# --------------------------------------------------------------------------
@query("describe", """
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max
FROM lineitem
""")
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = A.describe(Tables(spark, sf_dir).lineitem, "l_extendedprice")
    return d.select("count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
                    F.round("p25", 4).alias("p25"), F.round("p50", 4).alias("p50"),
                    F.round("p75", 4).alias("p75"), "max")


# --------------------------------------------------------------------------
# Top-10 anchor targets
# --------------------------------------------------------------------------
@query("top_values", f"""
SELECT regexp_replace(h, '^/', '') AS value, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(html, '{HREF_RE}', 1)) AS h FROM pages)
GROUP BY value ORDER BY count DESC, value LIMIT 10
""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _page_concepts(spark, sf_dir).select(F.explode("hrefs").alias("h")) \
        .select(F.regexp_replace("h", "^/", "").alias("value"))
    return A.top_values(v, "value", 10)


# --------------------------------------------------------------------------
# Run statistics (pages with anchors = successes)
# --------------------------------------------------------------------------
@query("run_stats", f"""
WITH p AS (SELECT len(regexp_extract_all(html, '{HREF_RE}', 1)) AS n FROM pages)
SELECT count(*) AS n_total, count(*) FILTER (WHERE n > 0) AS n_ok, count(*) FILTER (WHERE n = 0) AS n_failed,
       round(sum(n) FILTER (WHERE n > 0) / count(*) FILTER (WHERE n > 0), 2) AS mean_per_ok
FROM p
""")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _page_concepts(spark, sf_dir).select(F.size("hrefs").alias("n"))
    return A.run_stats(p, F.col("n") > 0, F.col("n").cast("double"))


# --------------------------------------------------------------------------
# Column profile
# --------------------------------------------------------------------------
@query("column_profile", """
SELECT column_name, non_null, n_rows FROM (
  SELECT count(*) AS n_rows, count(doc_id) AS doc_id, count(text) AS text, count(lang) AS lang,
         count(source) AS source, count(n_chars) AS n_chars FROM documents
) UNPIVOT (non_null FOR column_name IN (doc_id, text, lang, source, n_chars))
""")
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.column_profile(Tables(spark, sf_dir).documents).select("column_name", "non_null", "n_rows")


# --------------------------------------------------------------------------
# Cross-source duplicate report
# --------------------------------------------------------------------------
@query("dup_report", f"""
WITH c AS (SELECT {S.strip('n_name')} AS name, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT {S.strip('n_name')} AS name, s_suppkey AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT 'name' AS kind, name, NULL::BIGINT AS key FROM (SELECT name FROM c INTERSECT SELECT name FROM s)
UNION ALL
SELECT 'pair' AS kind, name, k AS key FROM (SELECT name, k FROM c INTERSECT SELECT name, k FROM s)
""")
def dup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.sets import intersect_names, intersect_pairs
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", "n_name")
    c = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.col("c_custkey").alias("k"))
    s = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"), F.col("s_suppkey").alias("k"))
    names = intersect_names(c, s, "name").select(F.lit("name").alias("kind"), "name",
                                                  F.lit(None).cast("long").alias("key"))
    pairs = intersect_pairs(c, s, "name", "k").select(F.lit("pair").alias("kind"), "name",
                                                       F.col("k").alias("key"))
    return names.unionByName(pairs)


# --------------------------------------------------------------------------
# Referential checks
# --------------------------------------------------------------------------
@query("ref_integrity", """
SELECT 'order_without_lineitem' AS check_name, CAST(o_orderkey AS VARCHAR) AS key, 1::BIGINT AS n
FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL))
UNION ALL
SELECT 'lineitem_missing_order', CAST(l_orderkey AS VARCHAR), 1::BIGINT
FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL
SELECT 'lineitem_missing_part', CAST(l_partkey AS VARCHAR), 1::BIGINT
FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL
SELECT 'duplicate_part_name', p_name, count(*) FROM part GROUP BY p_name HAVING count(*) > 1
UNION ALL
SELECT 'dangling_edges', NULL, count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) OR l_partkey NOT IN (SELECT p_partkey FROM part)
   OR l_orderkey IS NULL OR l_partkey IS NULL
""")
def ref_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.graph import uniqueness_violations
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey")
    one = F.lit(1).cast("long").alias("n")
    o_wo = J.missing_endpoints(t.orders, li, "o_orderkey", "l_orderkey") \
        .select(F.lit("order_without_lineitem").alias("check_name"), F.col("value").cast("string").alias("key"), one)
    l_wo = J.missing_endpoints(li, t.orders, "l_orderkey", "o_orderkey") \
        .select(F.lit("lineitem_missing_order").alias("check_name"), F.col("value").cast("string").alias("key"), one)
    p_wo = J.missing_endpoints(li, t.part, "l_partkey", "p_partkey") \
        .select(F.lit("lineitem_missing_part").alias("check_name"), F.col("value").cast("string").alias("key"), one)
    dup = uniqueness_violations(t.part, "p_name").select(
        F.lit("duplicate_part_name").alias("check_name"), F.col("p_name").alias("key"), F.col("n").cast("long"))
    _ok, dangling = J.resolve_endpoints(li, t.orders, "l_orderkey", "o_orderkey", t.part, "l_partkey", "p_partkey")
    dang = dangling.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("dangling_edges").alias("check_name"), F.lit(None).cast("string").alias("key"), "n")
    return o_wo.unionByName(l_wo).unionByName(p_wo).unionByName(dup).unionByName(dang)


# --------------------------------------------------------------------------
# Prioritised section-then-title match of concept nodes
# --------------------------------------------------------------------------
def _match_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept nodes: anchor targets (aliases = lower-case spelling and a
    "<name> page" variant), page URL
    segments (no alias) and part names (alias = their words)."""
    t = Tables(spark, sf_dir)
    c = _page_concepts(spark, sf_dir)
    targets = c.select(F.explode("hrefs").alias("h")).select(
        F.regexp_replace("h", "^/", "").alias("name")).distinct()
    a = targets.select(F.concat(F.lit("a:"), "name").alias("node_id"), "name",
                       F.array(F.lower("name"), F.concat("name", F.lit(" page"))).alias("alias"))
    s = c.select("name").distinct().select(F.concat(F.lit("s:"), "name").alias("node_id"), "name",
                                           F.array().cast("array<string>").alias("alias"))
    p = t.part.select("p_name").distinct().select(F.concat(F.lit("p:"), "p_name").alias("node_id"),
                                                  F.col("p_name").alias("name"),
                                                  F.split("p_name", " ").alias("alias"))
    return a.unionByName(s).unionByName(p)


@query("wiki_match", f"""
WITH c AS MATERIALIZED (
  SELECT page_id AS pos, {S.title_from_url('url')} AS title,
         regexp_extract_all(html, '{HREF_RE}', 1) AS hrefs,
         regexp_extract_all(html, '{ANCHOR_TEXT_RE}', 1) AS subs
  FROM pages
), subs AS MATERIALIZED (
  SELECT pos, i, title, s FROM (SELECT pos, title, unnest(subs) AS s, generate_subscripts(subs, 1) AS i FROM c)
  WHERE title IS NOT NULL AND s IS NOT NULL
), hrefs AS MATERIALIZED (
  SELECT DISTINCT CASE WHEN starts_with(h, '/') THEN substr(h, 2) ELSE h END AS h FROM (SELECT unnest(hrefs) AS h FROM c)
), nodes AS MATERIALIZED (
  SELECT 'a:' || h AS node_id, h AS name, [lower(h), h || ' page'] AS alias FROM hrefs
  UNION ALL
  SELECT DISTINCT 's:' || title, title, []::VARCHAR[] FROM c
  UNION ALL
  SELECT DISTINCT 'p:' || p_name, p_name, string_split(p_name, ' ') FROM part
), items AS MATERIALIZED (
  SELECT node_id, x, j FROM (SELECT node_id, unnest([name] || alias) AS x, generate_subscripts([name] || alias, 1) AS j FROM nodes)
  WHERE x IS NOT NULL
), texts AS MATERIALIZED (
  SELECT x, v, {S.strip('low')} AS n FROM (
    SELECT x, {S.strip('x')} AS v, regexp_replace(lower(x), '[{X.PY_WHITESPACE_CLASS}]+', ' ', 'g') AS low FROM (
      SELECT s AS x FROM subs UNION SELECT x FROM items UNION SELECT title FROM c WHERE title IS NOT NULL))
), sub_map AS MATERIALIZED (
  SELECT n AS hit_n, arg_min(title, pos * 1000000 + i) AS title, arg_min(v, pos * 1000000 + i) AS sub
  FROM subs JOIN texts ON s = x WHERE n <> '' GROUP BY n
), title_map AS MATERIALIZED (
  SELECT n AS hit_n, arg_min(title, pos) AS title FROM c JOIN texts ON title = x GROUP BY n
), cand AS MATERIALIZED (
  SELECT node_id, v AS c, min(j) AS j, min(n) AS cn FROM items JOIN texts USING (x) WHERE v <> '' GROUP BY node_id, v
), best AS MATERIALIZED (
  SELECT node_id, kind, hit_n, title, sub FROM (
    SELECT node_id, 0 AS kind, j, hit_n, title, sub FROM cand JOIN sub_map ON cn = hit_n
    UNION ALL
    SELECT node_id, 1, j, hit_n, title, NULL FROM cand JOIN title_map ON cn = hit_n)
  QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY kind, j) = 1
), hit_alias AS (
  SELECT node_id, string_agg(v, '|' ORDER BY o) AS alias_text FROM (
    SELECT node_id, v, min(o) AS o FROM (
      SELECT cand.node_id, cand.c AS v, cand.j AS o FROM cand JOIN best b ON cand.node_id = b.node_id WHERE cand.cn <> b.hit_n
      UNION ALL
      SELECT n.node_id, v, 1000000 FROM nodes n JOIN best b ON n.node_id = b.node_id JOIN texts ON n.name = x)
    WHERE v <> '' GROUP BY node_id, v)
  GROUP BY node_id
), miss_alias AS (
  SELECT node_id, string_agg(v, '|' ORDER BY j) AS alias_text FROM (
    SELECT node_id, v, min(j) AS j FROM items JOIN texts USING (x) WHERE j > 1 AND v <> '' GROUP BY node_id, v)
  GROUP BY node_id
)
SELECT n.node_id,
       CASE WHEN b.node_id IS NULL THEN n.name WHEN b.kind = 0 THEN b.sub ELSE b.title END AS name,
       coalesce(CASE WHEN b.node_id IS NULL THEN m.alias_text ELSE h.alias_text END, '') AS alias_text,
       CASE WHEN b.kind = 0 THEN '{X.WIKI_PREFIX}' || {S.path_quote('b.title')} || '#' || {S.path_quote('b.sub')}
            WHEN b.kind = 1 THEN '{X.WIKI_PREFIX}' || {S.path_quote('b.title')} END AS link,
       CASE WHEN b.kind = 0 THEN 'subtitle' WHEN b.kind = 1 THEN 'title' END AS wiki_match_type
FROM nodes n LEFT JOIN best b ON n.node_id = b.node_id
     LEFT JOIN hit_alias h ON n.node_id = h.node_id LEFT JOIN miss_alias m ON n.node_id = m.node_id
""")
def wiki_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.wikimatch import wiki_map
    pages = Tables(spark, sf_dir).pages
    wiki = pages.select(F.col("page_id").alias("pos"), X.title_from_url("url").alias("title"),
                        F.regexp_extract_all("html", F.lit(ANCHOR_TEXT_RE), 1).alias("subtitles"))
    out = wiki_map(_match_nodes(spark, sf_dir), wiki)
    return out.select("node_id", "name", F.array_join("alias", "|").alias("alias_text"), "link",
                      "wiki_match_type")


# --------------------------------------------------------------------------
# Fill link and categories from a lookup only where empty
# --------------------------------------------------------------------------
_DOC_LINK = X.WIKI_PREFIX + "Doc_"


@query("fill_missing", f"""
WITH lk AS (
  SELECT doc_id, '{_DOC_LINK}' || doc_id AS new_link,
         list_sort(list_distinct(flatten(list(cats)))) AS new_cats
  FROM (SELECT doc_id, list_filter([CASE WHEN quality = 1 THEN 'quality' END,
                                    CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS cats
        FROM labels)
  GROUP BY doc_id
), d AS (
  SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN '{_DOC_LINK}' || doc_id || '_orig'
                      WHEN n_chars % 5 = 1 THEN ' ' END AS link,
         CASE WHEN n_chars % 3 = 0 THEN [lang] ELSE []::VARCHAR[] END AS cats
  FROM documents
)
SELECT d.doc_id,
       CASE WHEN (d.link IS NULL OR {S.strip('d.link')} = '') AND lk.new_link IS NOT NULL THEN lk.new_link
            ELSE d.link END AS link,
       array_to_string(CASE WHEN lk.doc_id IS NOT NULL AND len(d.cats) = 0 AND len(lk.new_cats) > 0
                            THEN lk.new_cats ELSE d.cats END, '|') AS categories_text
FROM d LEFT JOIN lk ON lk.doc_id = d.doc_id
""")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.categories import fill_from_lookup
    t = Tables(spark, sf_dir)
    lab = t.labels.select("doc_id", F.filter(F.array(F.when(F.col("quality") == 1, F.lit("quality")),
                                                     F.when(F.col("toxic") == 1, F.lit("toxic"))),
                                             lambda x: x.isNotNull()).alias("cats"))
    merged = A.merged_category_sets(lab.where(F.size("cats") > 0), "doc_id", "cats", "new_categories")  # A10
    hits = t.labels.select("doc_id").distinct().join(merged, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("name"),
        F.concat(F.lit(_DOC_LINK), F.col("doc_id").cast("string")).alias("new_link"),
        F.coalesce("new_categories", L.empty_str_array()).alias("new_categories"))
    docs = t.documents.select(
        F.col("doc_id").cast("string").alias("name"), "doc_id",
        F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit(_DOC_LINK), F.col("doc_id").cast("string"), F.lit("_orig")))
         .when(F.col("n_chars") % 5 == 1, F.lit(" ")).alias("link"),
        F.when(F.col("n_chars") % 3 == 0, F.array("lang")).otherwise(L.empty_str_array()).alias("categories"))
    out = fill_from_lookup(docs, hits, "name", "link", "categories", only_when_missing=True)   # J13
    return out.select("doc_id", "link", F.array_join("categories", "|").alias("categories_text"))


# --------------------------------------------------------------------------
# Entity resolution of part names against part-type keyword nodes
# --------------------------------------------------------------------------
def _resolve_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Existing nodes: the part types (ordered by text).  Incoming concepts:
    parts in key order; name = part name, aliases = its brand when the size is
    above 25 and the upper-case type when the size is at most 10, link only for
    sizes divisible by 3, categories = [type]."""
    part = Tables(spark, sf_dir).part
    types = part.select(F.col("p_type").alias("name")).distinct()
    existing = A.ranked_keys(types, "name", "ord").select(
        "ord", "name", F.array().cast("array<string>").alias("alias"),
        F.lit(None).cast("string").alias("link"), F.array(F.lit("type")).alias("categories"))
    alias = F.filter(F.array(F.when(F.col("p_size") > 25, F.col("p_brand")),
                             F.when(F.col("p_size") <= 10, F.upper("p_type"))), lambda x: x.isNotNull())
    incoming = part.select(
        F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), alias.alias("alias"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(X.WIKI_PREFIX + "Part_"), F.col("p_partkey").cast("string")))
         .alias("link"),
        F.array("p_type").alias("categories"))
    return existing, incoming


_RESOLVE_CTE = f"""
ex AS (
  SELECT (dense_rank() OVER (ORDER BY p_type) - 1)::BIGINT AS ord, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part)
), inc AS (
  SELECT p_partkey AS pos, p_name AS name,
         list_filter([CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN p_size <= 10 THEN upper(p_type) END],
                     lambda x: x IS NOT NULL) AS alias,
         CASE WHEN p_size % 3 = 0 THEN '{X.WIKI_PREFIX}Part_' || p_partkey END AS link,
         [p_type] AS categories
  FROM part
), t_terms AS (
  SELECT DISTINCT pos, term FROM (
    SELECT pos, {S.lower_strip('name')} AS term FROM inc
    UNION ALL
    SELECT pos, {S.lower_strip('a')} FROM (SELECT pos, unnest(alias) AS a FROM inc) WHERE a IS NOT NULL AND a <> '')
), s_terms AS (
  SELECT DISTINCT pos, term FROM (
    SELECT pos, lower(name) AS term FROM inc
    UNION ALL
    SELECT pos, lower(a) FROM (SELECT pos, unnest(alias) AS a FROM inc) WHERE a IS NOT NULL)
), e_terms AS (
  SELECT lower(name) AS term, min(ord) AS ord FROM ex GROUP BY 1
), init AS (
  SELECT inc.pos, least(coalesce(d.ord, 4611686018427387904 + inc.pos), 4611686018427387904 + inc.pos) AS lab
  FROM inc LEFT JOIN (SELECT t.pos, min(e.ord) AS ord FROM t_terms t JOIN e_terms e USING (term) GROUP BY t.pos) d
       ON d.pos = inc.pos
), links AS (
  SELECT DISTINCT s.pos AS src, t.pos AS dst FROM s_terms s JOIN t_terms t USING (term) WHERE s.pos < t.pos
), anc(pos, a) AS (
  SELECT pos, pos FROM inc
  UNION
  SELECT links.dst, anc.a FROM anc JOIN links ON links.src = anc.pos
), lab AS (
  SELECT anc.pos, min(init.lab) AS lab FROM anc JOIN init ON init.pos = anc.a GROUP BY anc.pos
), res AS (
  SELECT inc.*, lab.lab,
         CASE WHEN lab.lab = 4611686018427387904 + inc.pos THEN 'created' ELSE 'merged' END AS action
  FROM inc JOIN lab USING (pos)
), nodes AS (
  SELECT ord AS lab, name AS node_name, []::VARCHAR[] AS init_alias, NULL::VARCHAR AS init_link,
         ['type'] AS init_cats FROM ex
  UNION ALL
  SELECT lab, name, alias, link, categories FROM res WHERE action = 'created'
)"""


@query("entity_resolve", f"""
WITH RECURSIVE {_RESOLVE_CTE}
SELECT res.pos, res.name, res.action, nodes.node_name FROM res JOIN nodes ON nodes.lab = res.lab
""")
def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.resolve import resolve
    existing, incoming = _resolve_inputs(spark, sf_dir)
    actions, _nodes = resolve(existing, incoming)
    return actions


@query("entity_nodes", f"""
WITH RECURSIVE {_RESOLVE_CTE},
m AS (SELECT * FROM res WHERE action = 'merged'),
alias_items AS (
  SELECT m.lab, m.pos, i, a FROM (
    SELECT lab, pos, unnest([name] || alias) AS a, generate_subscripts([name] || alias, 1) AS i FROM m) m
  JOIN nodes n ON n.lab = m.lab
  WHERE a IS NOT NULL AND NOT list_contains(n.init_alias, a)
), alias_kept AS (
  SELECT * FROM alias_items
  QUALIFY pos = min(pos) OVER (PARTITION BY lab, a)
), cat_items AS (
  SELECT m.lab, m.pos, i, a FROM (
    SELECT lab, pos, unnest(categories) AS a, generate_subscripts(categories, 1) AS i FROM m) m
  JOIN nodes n ON n.lab = m.lab
  WHERE a IS NOT NULL AND NOT list_contains(n.init_cats, a)
), cat_kept AS (
  SELECT * FROM cat_items QUALIFY pos = min(pos) OVER (PARTITION BY lab, a)
), seq AS (
  SELECT lab, pos AS seq, link FROM m UNION ALL SELECT lab, -1, init_link FROM nodes
), link_pick AS (
  SELECT lab,
         arg_min(link, seq) FILTER (WHERE link IS NOT NULL AND link <> '') AS first_link,
         arg_max(link, seq) AS last_link, count(*) - 1 AS n_merged
  FROM seq GROUP BY lab
)
SELECT n.node_name,
       array_to_string(n.init_alias || coalesce((SELECT list(a ORDER BY pos, i) FROM alias_kept k WHERE k.lab = n.lab), []), '|') AS alias_text,
       CASE WHEN lp.first_link IS NOT NULL THEN lp.first_link ELSE lp.last_link END AS link,
       array_to_string(n.init_cats || coalesce((SELECT list(a ORDER BY pos, i) FROM cat_kept k WHERE k.lab = n.lab), []), '|') AS categories_text,
       lp.n_merged
FROM nodes n JOIN link_pick lp ON lp.lab = n.lab
""")
def entity_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.operators.resolve import resolve
    existing, incoming = _resolve_inputs(spark, sf_dir)
    _actions, nodes = resolve(existing, incoming)
    return nodes.select("node_name", F.array_join("alias", "|").alias("alias_text"), "link",
                        F.array_join("categories", "|").alias("categories_text"), "n_merged")


# --------------------------------------------------------------------------
# The full prerequisite-dataset cleaning flow (repair → group → link →
# explode → self-loop removal → orphans → node / edge tables)
# --------------------------------------------------------------------------
def _metacademy(spark: SparkSession, sf_dir: str):
    from noema.plans.kc_datasets import CONCEPT, PREREQ, clean_metacademy
    rows = _page_concepts(spark, sf_dir).select(
        F.col("name").alias(CONCEPT), F.explode_outer("hrefs").alias("h")) \
        .select(CONCEPT, F.regexp_replace("h", "^/", "").alias(PREREQ))
    return clean_metacademy(rows)


@query("metacademy_nodes", f"""
WITH {_PREREQ_CTE},
names AS (SELECT DISTINCT name FROM edges WHERE name IS NOT NULL),
orphans AS (SELECT DISTINCT prereq_name AS name FROM edges WHERE prereq_name IS NOT NULL
            EXCEPT SELECT name FROM names)
SELECT name, {S.name_link('name')} AS link FROM (SELECT name FROM names UNION ALL SELECT name FROM orphans)
""")
def metacademy_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metacademy(spark, sf_dir).nodes.select("name", "link")


@query("metacademy_edges", f"""
WITH {_PREREQ_CTE}
SELECT DISTINCT name, prereq_name FROM edges WHERE name IS NOT NULL AND prereq_name IS NOT NULL
""")
def metacademy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metacademy(spark, sf_dir).edges.select("name", "prereq_name")


# --------------------------------------------------------------------------
# D5 through the library flow: saved reference responses (one per line item
# in line order) + paper details (parts) → top-5 references per seed (order)
# --------------------------------------------------------------------------
@query("reference_selection", f"""
WITH refs AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS seed, CAST(l_partkey AS VARCHAR) AS ref, l_partkey,
         l_returnflag = 'R' AS inf, {_LINE_ORDER_SQL}
  FROM lineitem WHERE l_partkey IS NOT NULL AND l_orderkey IN (SELECT o_orderkey FROM orders)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {_LINE_ORDER_SQL}) = 1
), scored AS (
  SELECT r.*, p.p_name AS title, p.p_retailprice AS citationCount, coalesce(p.p_retailprice, 0) AS cit
  FROM refs r LEFT JOIN part p ON p.p_partkey = r.l_partkey
)
SELECT seed AS seed_paper_id, ref AS ref_paper_id, title, inf AS isInfluential, citationCount,
       row_number() OVER (PARTITION BY seed ORDER BY inf DESC, cit DESC, {_LINE_ORDER_SQL}) AS rank
FROM scored QUALIFY rank <= 5
""")
def reference_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from noema.plans.papers import select_references
    t = Tables(spark, sf_dir)
    seeds = t.orders.select(F.col("o_orderkey").cast("string").alias("paperId"))
    responses = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("seed_paper_id"),
        F.struct(*LINE_ORDER).alias("ref_pos"),                       # response order
        F.col("l_partkey").cast("string").alias("ref_paper_id"),
        (F.col("l_returnflag") == "R").alias("isInfluential"),
        F.array(F.col("l_linestatus")).alias("intents"), F.array().cast("array<string>").alias("contexts"))
    details = t.part.select(F.col("p_partkey").cast("string").alias("paperId"), F.col("p_name").alias("title"),
                            F.lit(None).cast("int").alias("year"), F.lit(None).cast("string").alias("url"),
                            F.lit(None).cast("string").alias("abstract"), F.col("p_brand").alias("venue"),
                            F.lit(None).cast("long").alias("referenceCount"),
                            F.col("p_retailprice").alias("citationCount"),
                            F.array("p_type").alias("fieldsOfStudy"),
                            F.lit(None).cast("array<struct<category:string,source:string>>").alias("s2FieldsOfStudy"))
    refs, _errors = select_references(seeds, responses, details, 5)
    return refs.select("seed_paper_id", "ref_paper_id", "title", "isInfluential", "citationCount",
                       F.col("rank").cast("long").alias("rank"))
