"""G4 / X1 entity resolution of incoming concepts against a keyword graph.

Reference semantics (sequential): rows are processed in input order; a row is
merged into an existing node whose lower-cased name or any lower-cased alias is
among the row's search terms (``lower(strip(name))`` and the stripped,
lower-cased non-empty aliases), otherwise it creates a node.  Merging appends
the row's name and aliases to the node, so later rows can match through
earlier rows.  Where several nodes match we take the lowest node ordinal
(existing nodes in their order, then created nodes in creation order).

Parallel formulation used here.  Give every row the initial label
``min(lowest directly matched existing ordinal, CREATED + pos)``.  A row
``r`` can reach the node of an earlier row ``r'`` exactly when ``r'``'s stored
terms (``lower(name)``, ``lower(alias)``) meet ``r``'s search terms, and the
node a row ends in is the minimum initial label over all rows that reach it
through such links (labels only flow forward in ``pos``; the node of a
created row is always the smallest label it can see, and a created node's
label is larger than any node that existed before it).  So:

    label(r) = min(init(r), min{label(r') : r' < r, S(r') ∩ T(r) ≠ ∅})

computed by iterating to a fixpoint.  Per iteration, each term carries a
prefix minimum of labels over ``pos``; the prefix is split into fixed-size
``pos`` buckets (bucket minima, a prefix over buckets, a running minimum inside
a bucket), so a term shared by a third of all rows is spread over many tasks.
No pairs are emitted and no group is collected into one task.  Joins of rows with something
their term or node has go by (term, bucket) and (node, bucket) as well: what a key has is first
joined with the key's buckets, one row for ``bucket`` input rows.  After each round
a row whose label names a creating row takes that row's own label (pointer
jumping), so rounds grow with the logarithm of a chain of matches, not with its
length.  Rows are checkpointed to the shared folder with their labels and shared terms, and rounds
are semi-naive: only rows whose label dropped act as sources in the next round, and only
rows above the least of these labels, with a term of theirs, are targets.

The final node properties are the fold results in closed form: an appended
alias survives iff it is not already on the node and no earlier merged row of
the same node carried it; the link is the first non-empty value in
(node, merged rows…) order, else the last one assigned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from noema.functions.text import lower_strip
from noema.session import checkpoint_dir

CREATED = 1 << 62          # labels ≥ CREATED are "created by row label - CREATED"
DEFAULT_BUCKET = 1 << 16   # pos values per prefix bucket
STR_ARRAY = "array<string>"


def _search_terms(rows: DataFrame) -> DataFrame:
    """T(r): (pos, term) distinct."""
    by_name = rows.select("pos", lower_strip(F.col("name")).alias("term"))
    by_alias = rows.select("pos", F.explode(F.coalesce("alias", F.array().cast(STR_ARRAY))).alias("a")) \
                   .where(F.col("a").isNotNull() & (F.col("a") != "")) \
                   .select("pos", lower_strip(F.col("a")).alias("term"))
    return by_name.unionByName(by_alias).distinct()


def _stored_terms(df: DataFrame, key: str) -> DataFrame:
    """S(x): lower(name) and lower(alias) (no strip), nulls skipped."""
    by_name = df.where(F.col("name").isNotNull()).select(key, F.lower("name").alias("term"))
    by_alias = df.select(key, F.explode(F.coalesce("alias", F.array().cast(STR_ARRAY))).alias("a")) \
                 .where(F.col("a").isNotNull()).select(key, F.lower("a").alias("term"))
    return by_name.unionByName(by_alias).distinct()


def _join_spread(rows: DataFrame, of_key: DataFrame, key: str, bucket: int, how: str = "inner") -> DataFrame:
    """``rows`` (with ``pos``) joined with ``of_key`` (one row for each ``key``) by key and ``pos`` bucket, so that
    the rows of a frequent key are not joined in one task."""
    rows = rows.withColumn("_b", F.floor(F.col("pos") / bucket))
    hits = rows.select(key, "_b").distinct().join(of_key, key)
    return rows.join(hits, [key, "_b"], how).drop("_b")


def _propagate_once(src_labeled: DataFrame, tgt: DataFrame, bucket: int) -> DataFrame:
    """One round: for every target entry (pos, term), the minimum label over
    source entries (pos, term, label) of that term with a smaller-or-equal pos."""
    s = src_labeled.withColumn("b", F.floor(F.col("pos") / bucket))
    t = tgt.withColumn("b", F.floor(F.col("pos") / bucket))
    entries = s.select("term", "b", "pos", F.lit(0).alias("kind"), "label") \
        .unionByName(t.select("term", "b", "pos", F.lit(1).alias("kind"),
                              F.lit(None).cast("long").alias("label")))
    # bucket minima over sources (null for target-only buckets), then the
    # minimum over all earlier buckets of the term
    bmin = entries.groupBy("term", "b").agg(F.min("label").alias("bmin"))
    prefix = bmin.withColumn("before", F.min("bmin").over(
        Window.partitionBy("term").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))) \
        .select("term", "b", "before")
    run = entries.withColumn("seen", F.min("label").over(
        Window.partitionBy("term", "b").orderBy("pos", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(F.col("kind") == 1)
    reach = run.join(prefix, ["term", "b"], "left").select(
        "pos", F.least(F.col("seen"), F.col("before")).alias("cand"))
    return reach.groupBy("pos").agg(F.min("cand").alias("cand"))


def resolve_labels(existing: DataFrame, incoming: DataFrame, bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """(pos, label) for every incoming row with a non-null name.

    ``existing``: ord, name, alias.  ``incoming``: pos, name, alias.
    """
    spark = incoming.sparkSession
    checkpoint_dir(spark)
    rows = incoming.where(F.col("name").isNotNull()).select("pos", "name", "alias")
    # one materialised table of all term entries: kind 0 = stored (source), 1 = searched (target)
    terms = _stored_terms(rows, "pos").withColumn("kind", F.lit(0)) \
        .unionByName(_search_terms(rows).withColumn("kind", F.lit(1))).checkpoint(eager=True)
    ek = _stored_terms(existing.select("ord", "name", "alias"), "ord") \
        .groupBy("term").agg(F.min("ord").alias("ord"))
    direct = _join_spread(terms.where(F.col("kind") == 1), ek, "term", bucket).groupBy("pos").agg(F.min("ord").alias("direct"))
    # only terms held by at least two rows can carry a label from one row to another
    shared = terms.select("term", "pos").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1).select("term")
    own_terms = _join_spread(terms, shared, "term", bucket, "left_semi").groupBy("pos").agg(
        *[F.collect_list(F.when(F.col("kind") == k, F.col("term"))).alias(c) for k, c in ((0, "stored"), (1, "searched"))])
    # a row has its label and its shared terms with it, so a round joins nothing to find what moved
    state = rows.select("pos").join(direct, "pos", "left").join(own_terms, "pos", "left").select(
        "pos", F.least(F.coalesce("direct", F.lit(CREATED) + F.col("pos")), F.lit(CREATED) + F.col("pos")).alias("label"),
        F.lit(True).alias("moved"), F.lit(False).alias("joined"), "stored", "searched").checkpoint(eager=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own, drops = F.lit(CREATED) + F.col("pos"), F.coalesce(F.col("cand") < F.col("label"), F.lit(False))
    follows = F.coalesce((F.col("label") > F.lit(CREATED // 2)) & (F.col("label") != own), F.lit(False))
    # semi-naive rounds: only rows whose label dropped in the previous round
    # can lower anyone else's label, so only they act as sources
    least, first = state.agg(F.min("label")).first()[0], True
    while least is not None:
        src = state.where("moved").select("pos", "label", F.explode("stored").alias("term"))
        # no label that moves is below ``least``: rows at or below it stay as they are, out of the round's joins
        is_open = F.coalesce(F.col("label") > F.lit(least), F.lit(False))
        tgt = state.where(is_open).select("pos", "label", F.explode("searched").alias("term"))
        if not first:                           # in the first round every row is new
            low = src.groupBy("term").agg(F.min("label").alias("low"))
            tgt = _join_spread(tgt, low, "term", bucket).where("label > low")
        cand = _propagate_once(src, tgt.select("pos", "term"), bucket)
        met = state.where(is_open).join(cand, "pos", "left").select(
            "pos", F.least("label", "cand").alias("label"), drops.alias("moved"),
            (drops & (F.col("label") == own)).alias("joined"), "stored", "searched")
        kept = state.where(~is_open).withColumns({"moved": F.lit(False), "joined": F.lit(False)})
        state = met.unionByName(kept).coalesce(parts).checkpoint(eager=True)
        first, dropped = False, F.min(F.when(F.col("moved"), F.col("label")))
        least, following, joined = state.agg(dropped, F.max(follows), F.max("joined")).first()
        if not (following and joined):
            continue
        # shortcut: a row labelled by row q takes q's label.  q reaches the row, so what
        # reaches q does too; a chain of matches halves each round.  Only a q that no longer creates
        # since this round has such rows: they left the others in the round those joined a node
        roots = state.where("joined").groupBy(own.alias("label")).agg(F.min("label").alias("further"))
        taken = _join_spread(state.where(follows), roots, "label", bucket, "left").select(
            "pos", F.least("label", "further").alias("label"), (F.col("moved") | F.col("further").isNotNull()).alias("moved"),
            "joined", "stored", "searched")
        state = taken.unionByName(state.where(~follows)).coalesce(parts).checkpoint(eager=True)
        least = state.agg(dropped).first()[0]
    return state.select("pos", "label")


def resolve(existing: DataFrame, incoming: DataFrame, bucket: int = DEFAULT_BUCKET
            ) -> tuple[DataFrame, DataFrame]:
    """Run G4 over all incoming rows.

    ``existing``: ord, name, alias, link, categories.
    ``incoming``: pos, name, alias, link, categories.
    Returns (actions: pos, name, action, node_name;
             nodes: node_name, alias, link, categories, node_ord, n_merged).
    """
    labels = resolve_labels(existing, incoming, bucket)
    inc = incoming.where(F.col("name").isNotNull()).join(labels, "pos")
    created = inc.where(F.col("label") == F.lit(CREATED) + F.col("pos"))
    merged = inc.where(F.col("label") != F.lit(CREATED) + F.col("pos"))
    node_init = existing.select(F.col("ord").alias("label"), F.col("name").alias("node_name"),
                                F.coalesce("alias", F.array().cast(STR_ARRAY)).alias("init_alias"),
                                F.col("link").alias("init_link"),
                                F.coalesce("categories", F.array().cast(STR_ARRAY)).alias("init_cats")) \
        .unionByName(created.select("label", F.col("name").alias("node_name"),
                                    F.coalesce("alias", F.array().cast(STR_ARRAY)).alias("init_alias"),
                                    F.col("link").alias("init_link"),
                                    F.coalesce("categories", F.array().cast(STR_ARRAY)).alias("init_cats")))
    own = F.col("label") == F.lit(CREATED) + F.col("pos")
    names = node_init.select("label", "node_name")
    actions = _join_spread(merged.select("pos", "name", "label"), names, "label", bucket, "left").select(
        "pos", "name", F.lit("merged").alias("action"), "node_name").unionByName(
        inc.where(own).select("pos", "name", F.lit("created").alias("action"), F.col("name").alias("node_name")))

    def appended(items_col: str, init_col: str, out: str) -> DataFrame:
        """Items that no earlier row of the node and not the node itself had; a null among the node's own
        items keeps all out.  By (node, item), combined before the shuffle."""
        ex = merged.select("label", "pos", items_col, F.posexplode(items_col).alias("i", "a")).where(F.col("a").isNotNull())
        ex = ex.select("label", "a", "pos", "i", (F.array_position(items_col, F.col("a")) == F.col("i") + 1).alias("first"))
        first = ex.where("first").groupBy("label", "a").agg(F.min(F.struct("pos", "i")).alias("at"))
        had = node_init.select("label", F.explode(init_col).alias("a"))
        kept = first.join(had.where(F.col("a").isNotNull()).distinct(), ["label", "a"], "left_anti") \
            .join(had.where(F.col("a").isNull()).select("label").distinct(), "label", "left_anti") \
            .select("label", "a", "at.pos", "at.i")
        # an item that its first row has twice is appended twice
        again = ex.where("not first").join(kept.select("label", "a", "pos"), ["label", "a", "pos"], "left_semi")
        return kept.unionByName(again.select("label", "a", "pos", "i")).groupBy("label").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "i", "a"))), lambda z: z["a"]).alias(out))

    merged = merged.withColumn("_new_alias", F.concat(F.array("name"), F.coalesce("alias", F.array().cast(STR_ARRAY)))) \
                   .withColumn("_new_cats", F.coalesce("categories", F.array().cast(STR_ARRAY)))
    add_alias = appended("_new_alias", "init_alias", "add_alias")
    add_cats = appended("_new_cats", "init_cats", "add_cats")
    seq = merged.select("label", F.col("pos").alias("seq"), F.col("link")) \
        .unionByName(node_init.select("label", F.lit(-1).cast("long").alias("seq"), F.col("init_link").alias("link")))
    link = seq.groupBy("label").agg(
        F.min_by("link", F.when(F.col("link").isNotNull() & (F.col("link") != ""), F.col("seq"))).alias("_first"),
        F.max_by("link", "seq").alias("_last"),
        (F.count(F.lit(1)) - 1).alias("n_merged"))
    nodes = node_init.join(add_alias, "label", "left").join(add_cats, "label", "left").join(link, "label", "left")
    nodes = nodes.select(
        "node_name",
        F.concat("init_alias", F.coalesce("add_alias", F.array().cast(STR_ARRAY))).alias("alias"),
        F.coalesce("_first", "_last").alias("link"),
        F.concat("init_cats", F.coalesce("add_cats", F.array().cast(STR_ARRAY))).alias("categories"),
        F.col("label").alias("node_ord"), F.col("n_merged").cast("long").alias("n_merged"))
    return actions, nodes
