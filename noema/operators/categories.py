"""Encyclopedia category lookup: S6 response scan, J14 title resolution
(normalised → redirect → page, compared case-insensitively with ``_`` = space),
A10 merged category sets, J13 lookup-fill, P10 lookup mask.

Responses arrive as saved JSON (``query.pages`` map, ``redirects``,
``normalized``; continuation parts are simply more rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from noema.functions import text as X
from noema.functions.lists import empty_str_array, parse_to_list
from noema.functions.predicates import is_empty_arr, is_empty_str, needs_lookup

FROM_TO = T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("to", T.StringType())]))
PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("missing", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))),
])
RESPONSE = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("query", T.StructType([
        T.StructField("redirects", FROM_TO),
        T.StructField("normalized", FROM_TO),
        T.StructField("pages", T.MapType(T.StringType(), PAGE)),
    ])),
])


def page_hits(responses: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """S6 + J14 + A10: for each input name, the page it resolves to, its link
    (F9c) and the sorted union of its categories over all response parts.

    Every input whose normalised or redirected spelling reaches the page gets
    the hit.  Spellings are compared without case, but an exact title wins, a
    normalised or redirected spelling counts in its own batch, and an input gets one
    page's categories, never a mixture."""
    q = responses.select("batch_id", "query.*")
    pages = q.select("batch_id", F.explode("pages").alias("page_id", "p")) \
             .where((F.col("page_id") != "-1") & F.col("p.missing").isNull() &
                    F.col("p.title").isNotNull() & (F.col("p.title") != "")) \
             .select("batch_id", F.col("p.title").alias("page_title"),
                     F.transform(F.coalesce("p.categories", F.array()),
                                 lambda c: X.strip_category_prefix(F.coalesce(c["title"], F.lit(""))))
                     .alias("cats"))
    pages = pages.select("batch_id", "page_title", F.filter("cats", lambda c: c != "").alias("cats"))
    cats = pages.select("page_title", F.explode_outer("cats").alias("c")).distinct() \
                .groupBy("page_title").agg(F.array_sort(F.collect_list("c")).alias("new_categories"))  # A10
    titles = pages.select("batch_id", "page_title").distinct().withColumn("_pk", X.page_key("page_title"))
    inp = names.select(F.col(name).alias("_in")).where(F.col("_in").isNotNull()).distinct()

    def renamed(kind: str) -> DataFrame:
        return q.select(F.col("batch_id").alias("_rb"), F.explode(kind).alias("x")).select(
            "_rb", X.page_key("x.from").alias("_from"), F.col("x.to").alias("_to")).distinct()

    # spellings to try, each within the batch whose response gave it (null: any batch)
    tried = inp.select("_in", F.lit(None).cast("bigint").alias("_b"), F.col("_in").alias("_t"), F.lit(0).alias("_step"))
    for step, kind in ((1, "normalized"), (2, "redirects")):
        r = renamed(kind)
        more = tried.join(r, (X.page_key(tried["_t"]) == r["_from"]) & F.coalesce(tried["_b"] == r["_rb"], F.lit(True)))
        tried = tried.unionByName(more.select("_in", F.col("_rb").alias("_b"), F.col("_to").alias("_t"),
                                              F.lit(step).alias("_step"))).distinct()
    hit = tried.join(titles, (X.page_key("_t") == titles["_pk"])
                     & F.coalesce(F.col("_b") == F.col("batch_id"), F.lit(True)))
    # one page per input: an exact title before one that differs in case, then the shortest way
    best = hit.groupBy("_in").agg(F.min(F.struct((F.col("_t") != F.col("page_title")).alias("inexact"), "_step",
                                                 "page_title")).alias("h")).select("_in", "h.page_title")
    return best.join(cats, "page_title").select(
        F.col("_in").alias(name), "page_title", X.page_link("page_title").alias("new_link"), "new_categories")


def fill_from_lookup(df: DataFrame, hits: DataFrame, key: str = "name", link: str = "link",
                     categories: str = "categories", only_when_missing: bool = True) -> DataFrame:
    """Link filled only when empty (and the hit has one); categories filled
    only when empty, or unioned (sorted) in merge mode (F28; a text column is
    parsed first).  Only rows passing the P10 mask are looked up; the lookup key is
    the stripped name."""
    if dict(df.dtypes)[categories] == "string":
        df = df.withColumn(categories, parse_to_list(categories))
    h = hits.select(F.col(key).alias("_hk"), "new_link", "new_categories")
    d = df.withColumn("_need", needs_lookup(key, link, categories)) \
          .withColumn("_k", X.strip(F.col(key)))
    j = d.join(h, (d["_k"] == h["_hk"]) & d["_need"], "left")
    new_link = F.when(is_empty_str(link) & F.col("new_link").isNotNull() & (F.col("new_link") != ""),
                      F.col("new_link")).otherwise(F.col(link))
    new_cats = F.coalesce(F.col("new_categories"), empty_str_array())
    if only_when_missing:
        cats = F.when(F.col("_hk").isNotNull() & is_empty_arr(categories) & (F.size(new_cats) > 0),
                      F.array_distinct(new_cats)).otherwise(F.col(categories))
    else:
        cats = F.when(F.col("_hk").isNotNull(),
                      F.array_sort(F.array_union(F.coalesce(F.col(categories), empty_str_array()), new_cats))
                      ).otherwise(F.col(categories))
    return j.withColumn(link, new_link).withColumn(categories, cats).drop(
        "_need", "_k", "_hk", "new_link", "new_categories")
