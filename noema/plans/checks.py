"""Catalog queries for branches and library functions that the other queries leave out:
summaries of columns with nulls, NaN and ties, overlays and edge properties of the graph build,
finalised concepts with their categories, positional lookups and nested JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noema.functions import text as X
from noema.operators import aggregates as A, columns as O, graph as G, rows as R
from noema.plans import _sql as S, catalog, graph_build, kc_datasets as K, papers as P
from noema.plans.catalog import query
from noema.session import fresh_path
from noema.sources import files
from noema.sources.tables import Tables


# --------------------------------------------------------------------------
# Summaries of derived columns
# --------------------------------------------------------------------------
@query("describe_branches", """
WITH v AS (SELECT CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 0.0 WHEN 3 THEN -1000.0 ELSE o_totalprice END AS x FROM orders),
c AS (SELECT 'mixed' AS col, x FROM v UNION ALL SELECT 'ties', CASE WHEN o_orderkey % 3 = 0 THEN 5.0 ELSE 7.0 END FROM orders
      UNION ALL SELECT 'one', CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 2.5 END FROM orders UNION ALL SELECT 'void', NULL FROM orders)
SELECT col, count(y) AS count, round(avg(y), 4) AS mean, CASE WHEN count(y) > 1 THEN round(stddev_samp(y), 4) END AS std, min(y) AS min, round(quantile_cont(y, 0.25), 4) AS p25,
       round(quantile_cont(y, 0.5), 4) AS p50, round(quantile_cont(y, 0.75), 4) AS p75, max(y) AS max
FROM (SELECT col, CASE WHEN isnan(x) THEN NULL ELSE x END AS y FROM c) GROUP BY col
""")
def describe_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = Tables(spark, sf_dir).orders, F.col("o_orderkey")
    least = o.agg(F.min("o_orderkey")).first()[0]
    cols = {"mixed": F.when(k % 7 == 1, F.lit(float("nan"))).when(k % 7 == 2, 0.0).when(k % 7 == 3, -1000.0).when(k % 7 > 3, F.col("o_totalprice")),
            "ties": F.when(k % 3 == 0, 5.0).otherwise(7.0), "one": F.when(k == F.lit(least), 2.5), "void": F.lit(None).cast("double")}
    out = None
    for name, x in cols.items():
        d = A.describe(o.select(x.alias("x")), "x").select(F.lit(name).alias("col"), "count", *[
            (F.round(c, 4) if c not in ("min", "max") else F.col(c)).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])
        out = d if out is None else out.unionByName(d)
    return out


@query("column_types", """
SELECT column_name, n_rows, non_null, dtype FROM (
  SELECT count(*) AS n_rows, count(p_partkey) AS id, count(CASE WHEN p_size % 3 <> 0 THEN 1 END) AS size, count(*) AS words, count(p_retailprice) AS price,
         0::BIGINT AS nothing FROM part)
UNPIVOT (non_null FOR column_name IN (id, size, words, price, nothing))
JOIN (VALUES ('id', 'bigint'), ('size', 'int'), ('words', 'array<string>'), ('price', 'double'), ('nothing', 'date')) t(column_name, dtype) USING (column_name)
""")
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("size"),
        F.split("p_name", " ").alias("words"), F.col("p_retailprice").alias("price"), F.lit(None).cast("date").alias("nothing"))
    return A.column_profile(p).select("column_name", "n_rows", "non_null", "dtype")


# --------------------------------------------------------------------------
# Keyword rows of two datasets, the later one replaces all properties
# --------------------------------------------------------------------------
@query("keyword_overlay", """
WITH r AS (
  SELECT p_type AS name, p_name AS link, string_split(p_name, ' ') AS alias, ['a, b', p_brand] AS categories, 0 AS s, p_partkey AS pos FROM part
  UNION ALL SELECT CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END, NULL, [p_brand, 'plain'], [], 1, p_partkey FROM part WHERE p_size < 20 AND p_size % 5 <> 0
  UNION ALL SELECT s_name, 'x', [], [], 2, s_suppkey FROM supplier)
SELECT name, link, array_to_string(alias, '|') AS alias_text, array_to_string(categories, '|') AS categories_text FROM r
QUALIFY row_number() OVER (PARTITION BY name ORDER BY s DESC, pos DESC) = 1
""")
def keyword_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    quoted = lambda *xs: F.concat(F.lit("['"), F.concat_ws("', '", *xs), F.lit("']"))
    first = t.part.select(F.col("p_type").alias("name"), F.col("p_name").alias("link"), quoted(F.split("p_name", " ")).alias("alias"),
                          quoted(F.lit("a, b"), F.col("p_brand")).alias("categories"), F.col("p_partkey").alias("pos"))
    second = t.part.where("p_size < 20").select(
        F.when(F.col("p_size") % 5 != 0, F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand"))).alias("name"),
        F.lit(None).cast("string").alias("link"), F.concat("p_brand", F.lit(" , plain")).alias("alias"),
        F.lit(None).cast("string").alias("categories"), F.col("p_partkey").alias("pos"))
    third = t.supplier.select(F.col("s_name").alias("name"), F.lit("x").alias("link"), F.lit("[]").alias("alias"), F.lit("").alias("categories"),
                              F.col("s_suppkey").alias("pos"))
    out = graph_build.overlay_keywords([graph_build.keyword_rows(d, i) for i, d in enumerate((first, second, third))])
    return out.select("name", "link", F.array_join("alias", "|").alias("alias_text"), F.array_join("categories", "|").alias("categories_text"))


# --------------------------------------------------------------------------
# Edges from keywords to papers, and reference edges with all their properties
# --------------------------------------------------------------------------
@query("edge_properties", """
WITH e AS (SELECT o_orderkey AS pos, o_orderkey % 60 AS a, CASE WHEN o_orderkey % 11 = 0 THEN 1000000000 ELSE o_custkey % 40 END AS b, o_totalprice, o_orderpriority, o_orderstatus FROM orders),
k AS (SELECT n_name, n_nationkey FROM nation),
last AS (SELECT * FROM e WHERE a IN (SELECT c_custkey FROM customer) AND b IN (SELECT c_custkey FROM customer)
         QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY pos DESC) = 1),
inn AS (SELECT n_name, b, e.* EXCLUDE (b) FROM e JOIN k ON n_nationkey = a % 25 WHERE b IN (SELECT c_custkey FROM customer)
        QUALIFY row_number() OVER (PARTITION BY n_name, b ORDER BY pos DESC) = 1)
SELECT 'REF_BY' AS kind, CAST(a AS VARCHAR) AS source, b AS target, o_totalprice AS strength, o_orderpriority || '|' || o_orderstatus AS intents,
       o_orderstatus = 'F' AS influential, 'c' || pos AS contexts FROM last
UNION ALL SELECT 'IN', n_name, b, o_totalprice, o_orderpriority, NULL, NULL FROM inn
UNION ALL SELECT 'dangling REF_BY', NULL, NULL, count(*), NULL, NULL, NULL FROM e WHERE b = 1000000000 OR a NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'dangling IN', NULL, NULL, count(*), NULL, NULL, NULL FROM e WHERE b = 1000000000
""")
def edge_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, k = Tables(spark, sf_dir), F.col("o_orderkey")
    papers = t.customer.select(F.col("c_custkey").alias("paperId"))
    kw = t.nation.select(F.col("n_name").alias("name"), "n_nationkey")
    e = t.orders.select(k.alias("pos"), (k % 60).alias("a"), F.when(k % 11 == 0, F.lit(1000000000).cast("bigint")).otherwise(F.col("o_custkey") % 40).alias("b"),
                        F.col("o_totalprice").alias("strength"), F.array("o_orderpriority", "o_orderstatus").alias("intents"),
                        (F.col("o_orderstatus") == "F").alias("isInfluential"), F.array(F.concat(F.lit("c"), k.cast("string"))).alias("contexts"),
                        F.col("o_orderpriority").alias("reason"))
    ref, gone = G.upsert_edges(e.drop("reason"), "a", "b", ["pos"], papers, "paperId", papers, "paperId")
    named = e.join(kw, F.col("a") % 25 == F.col("n_nationkey")).select(F.col("name").alias("keyword_name"), "b", "strength", "reason", "pos")
    inn, lost = G.upsert_edges(named, "keyword_name", "b", ["pos"], kw, "name", papers, "paperId")
    void = F.lit(None)
    counts = [d.agg(F.count(F.lit(1)).cast("double").alias("strength")).select(
        F.lit(kind).alias("kind"), void.cast("string").alias("source"), void.cast("bigint").alias("target"), "strength",
        void.cast("string").alias("intents"), void.cast("boolean").alias("influential"), void.cast("string").alias("contexts"))
        for kind, d in (("dangling REF_BY", gone), ("dangling IN", lost))]
    return ref.select(F.lit("REF_BY").alias("kind"), F.col("a").cast("string").alias("source"), F.col("b").alias("target"), "strength",
                      F.array_join("intents", "|").alias("intents"), F.col("isInfluential").alias("influential"),
                      F.array_join("contexts", "|").alias("contexts")).unionByName(
        inn.select(F.lit("IN").alias("kind"), F.col("keyword_name").alias("source"), F.col("b").alias("target"), "strength",
                   F.col("reason").alias("intents"), void.cast("boolean").alias("influential"), void.cast("string").alias("contexts"))) \
        .unionByName(counts[0]).unionByName(counts[1])


# --------------------------------------------------------------------------
# Concepts finalised, then link and categories filled from the lookup where they are empty
# --------------------------------------------------------------------------
@query("kc_filled", f"""
WITH r AS (SELECT p_partkey AS pos, p_name AS name, {catalog._KC_LINK_SQL} AS link, [p_brand, p_name] AS alias FROM part),
l AS (SELECT name, arg_min(link, (CASE WHEN contains(link, '#') THEN 0 ELSE 1 END, -length(link), pos)) FILTER (WHERE link IS NOT NULL AND {S.strip('link')} <> '') AS link
      FROM r GROUP BY name),
a AS (SELECT name, string_agg(x, '|' ORDER BY p) AS alias_text FROM (SELECT name, x, min(pos) AS p FROM (SELECT name, unnest(alias) AS x, pos FROM r) GROUP BY name, x) WHERE x <> name GROUP BY name),
hits AS (SELECT name, '{X.WIKI_PREFIX}' || replace(upper(name), ' ', '_') AS new_link, ['Kind ' || string_split(name, ' ')[2], 'Parts'] AS cats FROM l WHERE length(name) % 2 = 0)
SELECT name, coalesce(l.link, CASE WHEN {S.strip('name')} <> '' THEN new_link END) AS link, coalesce(array_to_string(cats, '|'), '') AS categories_text,
       coalesce(alias_text, '') AS alias_text
FROM l LEFT JOIN a USING (name) LEFT JOIN hits USING (name)
""")
def kc_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    rows = catalog.kc_mentions(part).withColumn("alias", F.array(F.col("alias")[0], F.col("name"))).withColumn("mention_pos", F.col("pos")).drop("pos")
    names = part.select(F.col("p_name").alias("name")).distinct().where(F.length("name") % 2 == 0)
    hits = names.select("name", F.concat(F.lit(X.WIKI_PREFIX), F.replace(F.upper("name"), F.lit(" "), F.lit("_"))).alias("new_link"),
                        F.array(F.concat(F.lit("Kind "), F.element_at(F.split("name", " "), 2)), F.lit("Parts")).alias("new_categories"))
    out = P.finalize_and_fill(rows, hits)
    return out.select("name", "link", F.coalesce(F.array_join("categories", "|"), F.lit("")).alias("categories_text"),
                      F.array_join("alias", "|").alias("alias_text"))


# --------------------------------------------------------------------------
# Rows by their position; D8: what two datasets share
# --------------------------------------------------------------------------
@query("positions", """
SELECT pos, doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS pos FROM documents) WHERE pos IN (0, 7, 150, 199)
""")
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.with_global_index(Tables(spark, sf_dir).documents.select("doc_id", "source"), ["source", "doc_id"], "pos")
    out = None
    for i in (0, 7, 150, 199, 10**15):
        one = O.at_position(rows, i)
        out = one if out is None else out.unionByName(one)
    return out.select("pos", "doc_id", "source")


@query("shared_datasets", """
SELECT 'name' AS kind, p_name AS name, NULL AS prereq_name FROM part WHERE p_partkey % 2 = 0 INTERSECT SELECT 'name', p_name, NULL FROM part WHERE p_partkey % 3 = 0
UNION ALL (SELECT 'pair', p_name, p_type FROM part WHERE p_partkey % 2 = 0 AND p_type IS NOT NULL INTERSECT SELECT 'pair', p_name, p_type FROM part WHERE p_partkey % 3 = 0)
""")
def shared_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat(F.lit(" "), "p_name").alias("name"), F.col("p_type").alias("prereq_name"))
    one, two = p.where("p_partkey % 2 = 0"), p.where("p_partkey % 3 = 0")
    names, pairs = K.duplicate_report(one, two, one, two)
    return names.select(F.lit("name").alias("kind"), F.trim("name").alias("name"), F.lit(None).cast("string").alias("prereq_name")).unionByName(
        pairs.select(F.lit("pair").alias("kind"), F.trim("name").alias("name"), "prereq_name"))


# --------------------------------------------------------------------------
# JSON lines with nested values and nulls that are written
# --------------------------------------------------------------------------
@query("nested_json_lines", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'é ' || event_type END AS note,
       event_id % 3 = 0 AS null_is_written, true AS is_nested, true AS keeps_letters FROM events
""")
def nested_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "nested-json")
    e = Tables(spark, sf_dir).events.select("event_id", "props", F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("é "), "event_type")).alias("note"))
    files.write_json_lines(e, path, json_cols=("props",))
    line, v = F.col("value"), F.from_json("value", "event_id bigint, props struct<k: bigint>, note string")
    return spark.read.text(path).select(
        v["event_id"].alias("event_id"), v["props"]["k"].alias("k"), v["note"].alias("note"), line.contains('"note":null').alias("null_is_written"),
        line.contains('"props":{').alias("is_nested"), (line.contains("é") | line.contains('"note":null')).alias("keeps_letters"))
