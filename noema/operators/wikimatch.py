"""J10 prioritised multi-candidate match of concept nodes against encyclopedia
section titles and page titles.

Candidates of a node are ``[name] + alias`` (stripped, ordered distinct).  All
candidates are tried against section titles before any is tried against page
titles; the first hit wins.  Lookup tables keep the first row per normalised
key (page order, then section order).

Spark plan: explode candidates with their position, equi-join both lookup
tables on the normalised text, keep per node the hit with the smallest
(kind, candidate position) via ``min_by`` (partial aggregate), then rebuild
name / alias / link with column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noema.functions import lists as L, text as X
from noema.operators.rows import first_per_key

STR_ARRAY = "array<string>"


def _dedup(c):
    """Ordered distinct of stripped, non-blank values (null → dropped)."""
    xs = F.transform(c, lambda x: X.strip(F.coalesce(x, F.lit(""))))
    return F.array_distinct(F.filter(xs, lambda x: x != ""))


def lookup_tables(wiki: DataFrame, pos: str = "pos", title: str = "title",
                  subtitles: str = "subtitles") -> tuple[DataFrame, DataFrame]:
    """(section map: ``sub_n → (wiki_title, wiki_sub)``, title map: ``title_n → wiki_title``).

    ``subtitles`` may be an array column or list-like text (F4)."""
    w = wiki.where(F.col(title).isNotNull()).select(
        F.col(pos).alias("_pos"), F.col(title).cast("string").alias("wiki_title"), F.col(subtitles).alias("_subs"))
    subs_t = dict(w.dtypes)["_subs"]
    subs = F.col("_subs") if subs_t.startswith("array") else L.listlike(F.col("_subs"))
    ws = w.select("_pos", "wiki_title", F.posexplode(subs).alias("_i", "_s")) \
          .select("_pos", "_i", "wiki_title", X.strip(F.coalesce("_s", F.lit(""))).alias("wiki_sub"))
    ws = ws.withColumn("sub_n", X.norm("wiki_sub")).where(F.col("sub_n") != "")
    sub_map = first_per_key(ws, ["sub_n"], ["_pos", "_i"]).select("sub_n", "wiki_title", "wiki_sub")
    title_map = first_per_key(w.withColumn("title_n", X.norm("wiki_title")).select("title_n", "_pos", "wiki_title"),
                              ["title_n"], ["_pos"]).select("title_n", "wiki_title")
    return sub_map, title_map


def wiki_map(nodes: DataFrame, wiki: DataFrame, node_id: str = "node_id", name: str = "name",
             alias: str = "alias", pos: str = "pos", title: str = "title",
             subtitles: str = "subtitles") -> DataFrame:
    """Returns ``nodes`` with ``name``, ``alias``, ``link`` and
    ``wiki_match_type`` rewritten (``node_id`` must be unique per row)."""
    sub_map, title_map = lookup_tables(wiki, pos, title, subtitles)
    a_t = dict(nodes.dtypes)[alias]
    alias_list = F.coalesce(F.col(alias) if a_t.startswith("array") else L.listlike(F.col(alias)),
                            F.array().cast(STR_ARRAY))
    base = nodes.withColumn("_alias_list", alias_list) \
                .withColumn("_cand", _dedup(F.concat(F.array(F.col(name).cast("string")), F.col("_alias_list"))))
    cands = base.select(node_id, F.posexplode("_cand").alias("_ci", "_c")).withColumn("_cn", X.norm("_c"))
    sub_hits = cands.join(sub_map, cands["_cn"] == sub_map["sub_n"]).select(
        node_id, F.lit(0).alias("_kind"), "_ci", "_cn", "wiki_title", "wiki_sub")
    title_hits = cands.join(title_map, cands["_cn"] == title_map["title_n"]).select(
        node_id, F.lit(1).alias("_kind"), "_ci", "_cn", "wiki_title", F.lit(None).cast("string").alias("wiki_sub"))
    best = sub_hits.unionByName(title_hits).groupBy(node_id).agg(
        F.min_by(F.struct("_kind", "_cn", "wiki_title", "wiki_sub"), F.struct("_kind", "_ci")).alias("_hit"))
    j = base.join(best, node_id, "left")
    hit = F.col("_hit")
    kept = F.filter("_cand", lambda x: X.norm(x) != hit["_cn"])
    new_alias = _dedup(F.concat(kept, F.array(F.col(name).cast("string"))))
    link = F.when(hit["_kind"] == 0, X.article_link(hit["wiki_title"], hit["wiki_sub"])) \
            .when(hit["_kind"] == 1, X.article_link(hit["wiki_title"]))
    return j.select(
        *[c for c in nodes.columns if c not in (name, alias, "link", "wiki_match_type")],
        F.when(hit.isNull(), F.col(name)).when(hit["_kind"] == 0, hit["wiki_sub"])
         .otherwise(hit["wiki_title"]).alias(name),
        F.when(hit.isNull(), _dedup(F.col("_alias_list"))).otherwise(new_alias).alias(alias),
        link.alias("link"),
        F.when(hit["_kind"] == 0, F.lit("subtitle")).when(hit["_kind"] == 1, F.lit("title"))
         .alias("wiki_match_type"))
