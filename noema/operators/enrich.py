"""Model enrichment as Spark jobs.

Every step has the same shape: distinct keys → prompt text (L1) → generate
(L2) → parse (F23/F24) → typed fields → back-join to all rows with that key
(J7) with defaults.

The model is pluggable: ``generator(systems, users) -> raws`` is any Python
callable run on Arrow batches by ``mapInPandas``; offline, a ``responses``
table ``(prompt_key, raw)`` can be joined in instead.  Results are keyed by a
hash of the prompt, never by position, and the generated table is written to
the shared checkpoint folder once.  With a plain generator a failure before that
asks its finished prompts again; an ``operators.answers.AnswerStore`` in its place
keeps answers as they come and asks no prompt twice.  Prompt templates are parameters; the defaults below are short
placeholders using the reference's placeholder names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from noema.functions import lists as L, text as X
from noema.functions.jsonx import clamp01, with_parsed
from noema.operators.answers import AnswerStore, Generator, ask
from noema.operators.rows import first_per_key, last_per_key

# Placeholder names substituted into the prompt templates.
ALIAS_TEMPLATE = "List other names for the concept {INPUT_TITLE} as JSON {\"alias\": [...]}."
CONCEPT_ALIAS_TEMPLATE = "List other names for the concept {INPUT_name} as JSON {\"alias\": [...]}."
PREREQ_EDGE_TEMPLATE = ("Rate how much {PREREQ} is needed to learn {TARGET}; "
                        "answer JSON {\"strength\": 0..1, \"reason\": \"...\"}.")
ABOUT_EDGE_TEMPLATE = ("Paper: {PAPER_TITLE}\n{PAPER_ABSTRACT}\nHow central is {CONCEPT} to this paper? "
                       "JSON {\"strength\": 0..1, \"reason\": \"...\"}.")
IN_EDGE_TEMPLATE = ("Paper: {PAPER_TITLE}\n{PAPER_ABSTRACT}\nHow much does this paper rely on {CONCEPT}? "
                    "JSON {\"strength\": 0..1, \"reason\": \"...\"}.")
REF_EDGE_TEMPLATE = ("Target: {TARGET_TITLE}\n{TARGET_ABSTRACT}\nReference: {REF_TITLE}\n{REF_ABSTRACT}\n"
                     "Intents: {INTENTS} Influential: {IS_INF} Contexts: {CONTEXTS}\n"
                     "JSON {\"strength\": 0..1}.")
CONCEPTS_TEMPLATE = ("Title: {INPUT_TITLE}\nAbstract: {INPUT_ABSTRACT}\nJSON {\"proposed_concepts\": [...], "
                     "\"prerequisite_concepts\": [...]}.")
DESCRIPTION_TEMPLATE = ("Title: {INPUT_TITLE}\nAbstract: {INPUT_ABSTRACT}\nCategories: {INPUT_CATEGORIES}\n"
                        "JSON {\"description\": \"...\"}.")
ARTICLE_SYSTEM = ("Name the 20 linked topics that a reader should know first, best first, as JSON "
                  "{\"prerequisites\": [{\"rank\": 1, \"topic\": \"...\", \"rationale\": \"...\"}]}.")

# Default user messages; every step takes its own as a parameter.
USER_RAW_JSON = "Answer with one JSON object."
USER_ALIAS = "Answer with one JSON object that holds the list alias."
USER_CONCEPTS = "Answer with one JSON object that holds the lists proposed_concepts and prerequisite_concepts."
USER_DESCRIPTION = "Answer with one JSON object that holds the text description."
ARTICLE_USER = "Article {INPUT_TITLE} links to: {INPUT_LINKS}"


# --------------------------------------------------------------------------
# L1 / L2
# --------------------------------------------------------------------------
def render(template: str, values: dict[str, Column]) -> Column:
    """L1: literal ``{PLACEHOLDER}`` replacement, applied in order (not a
    template engine: text inserted earlier can be replaced later)."""
    out = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def prompt_key(system: Column, user: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", system, user), 256)


def generate(prompts: DataFrame, generator: Generator | AnswerStore | None = None, responses: DataFrame | None = None,
             materialize: bool = True) -> DataFrame:
    """L2: ``(prompt_key, system, user)`` → ``(prompt_key, raw)`` with ``raw``
    stripped.  Distinct prompts only; the result is checkpointed once.  An ``AnswerStore``
    as generator answers from what it keeps and asks the rest."""
    distinct = prompts.select("prompt_key", "system", "user").dropDuplicates(["prompt_key"])
    if responses is not None:
        out = distinct.join(responses.select("prompt_key", "raw"), "prompt_key", "left") \
                      .select("prompt_key", F.coalesce(X.strip("raw"), F.lit("")).alias("raw"))
    elif isinstance(generator, AnswerStore):
        return generator.ask(distinct)
    elif generator is not None:
        out = ask(distinct, generator)
    else:
        raise ValueError("need a generator or a responses table")
    return out.checkpoint(eager=True) if materialize else out


def _scored(keys: DataFrame, system: Column, user: str, generator, responses, fields: tuple[str, ...]) -> DataFrame:
    p = keys.withColumn("system", system).withColumn("user", F.lit(user)) \
            .withColumn("prompt_key", prompt_key(F.col("system"), F.col("user")))
    gen = generate(p, generator, responses)
    return with_parsed(p.join(gen, "prompt_key", "left"), "raw", fields)


# --------------------------------------------------------------------------
# L3 alias enrichment
# --------------------------------------------------------------------------
def add_alias(df: DataFrame, generator: Generator | None = None, responses: DataFrame | None = None,
              name: str = "name", template: str = ALIAS_TEMPLATE, placeholder: str = "INPUT_TITLE",
              user: str = USER_ALIAS) -> DataFrame:
    """L3: per distinct name → ``alias`` (F15), ``alias_raw``, ``alias_ok``."""
    names = df.where(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("_name")).distinct()
    s = _scored(names, render(template, {placeholder: F.col("_name")}), user, generator, responses, ("is_object", "alias"))
    ok = F.col("p.is_object") & F.col("p.alias").isNotNull()
    res = s.select("_name", F.when(ok, L.clean_aliases(F.col("p.alias"), F.col("_name")))
                   .otherwise(L.empty_str_array()).alias("alias"),
                   F.col("raw").alias("alias_raw"), F.coalesce(ok, F.lit(False)).alias("alias_ok"))
    out = df.drop("alias", "alias_raw", "alias_ok").join(
        res, df[name].cast("string") == res["_name"], "left").drop("_name")
    return out.withColumn("alias", F.coalesce("alias", L.empty_str_array())) \
              .withColumn("alias_raw", F.coalesce("alias_raw", F.lit(""))) \
              .withColumn("alias_ok", F.coalesce("alias_ok", F.lit(False)))


# --------------------------------------------------------------------------
# L4 / L5 edge scoring (strength, reason, raw, ok)
# --------------------------------------------------------------------------
EDGE_FIELDS = ("has_strength_or_reason", "strength", "reason")


def _edge_fields(s: DataFrame, keys: Sequence[str]) -> DataFrame:
    return s.select(*keys, clamp01(F.col("p.strength")).alias("strength"),
                    X.reason_clean(F.col("p.reason")).alias("reason"),
                    F.col("raw").alias("edge_raw"),
                    F.coalesce(F.col("p.has_strength_or_reason"), F.lit(False)).alias("edge_ok"))


def _back_join(df: DataFrame, res: DataFrame, keys: Sequence[str], defaults: dict[str, Column]) -> DataFrame:
    out = df.drop(*[c for c in defaults if c in df.columns]).join(res, list(keys), "left")
    for c, d in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), d))
    return out


def _edge_defaults() -> dict[str, Column]:
    return {"strength": F.lit(None).cast("double"), "reason": F.lit(None).cast("string"),
            "edge_raw": F.lit(""), "edge_ok": F.lit(False)}


def score_prereq_edges(df: DataFrame, generator: Generator | None = None, responses: DataFrame | None = None,
                       template: str = PREREQ_EDGE_TEMPLATE) -> DataFrame:
    """L4: per distinct (name, prereq_name)."""
    keys = df.select("name", "prereq_name").dropna().distinct()
    s = _scored(keys, render(template, {"TARGET": F.col("name"), "PREREQ": F.col("prereq_name")}),
                USER_RAW_JSON, generator, responses, EDGE_FIELDS)
    return _back_join(df, _edge_fields(s, ["name", "prereq_name"]), ["name", "prereq_name"], _edge_defaults())


def score_concept_edges(edges: DataFrame, template: str, generator: Generator | None = None,
                        responses: DataFrame | None = None) -> DataFrame:
    """L5 (one edge type): per distinct (paperId, concept) with the paper's
    first title/abstract as context (J6)."""
    keys = edges.select(F.col("paperId").cast("string").alias("paperId"),
                        F.col("concept").cast("string").alias("concept")).dropna().distinct()
    ctx = first_per_key(edges.select(F.col("paperId").cast("string").alias("paperId"), "title", "abstract", "pos"),
                        ["paperId"], ["pos"]).drop("pos")
    k = keys.join(ctx, "paperId", "left")
    s = _scored(k, render(template, {"PAPER_TITLE": F.col("title"), "PAPER_ABSTRACT": F.col("abstract"),
                                     "CONCEPT": F.col("concept")}), USER_RAW_JSON, generator, responses, EDGE_FIELDS)
    return _back_join(edges, _edge_fields(s, ["paperId", "concept"]), ["paperId", "concept"], _edge_defaults())


def build_scored_edges(mentions: DataFrame, generator: Generator | None = None, responses: DataFrame | None = None,
                       about_template: str = ABOUT_EDGE_TEMPLATE, in_template: str = IN_EDGE_TEMPLATE) -> DataFrame:
    """ABOUT and IN edges from concept mentions (D3), scored, unioned."""
    from noema.plans.papers import make_edges_from_mentions
    about, inn = make_edges_from_mentions(mentions)
    a = score_concept_edges(about, about_template, generator, responses).withColumn("edge_type", F.lit("ABOUT"))
    b = score_concept_edges(inn, in_template, generator, responses).withColumn("edge_type", F.lit("IN"))
    return a.unionByName(b)


# --------------------------------------------------------------------------
# L6 reference edge scoring
# --------------------------------------------------------------------------
def score_ref_edges(refs: DataFrame, seeds: DataFrame, generator: Generator | None = None,
                    responses: DataFrame | None = None, template: str = REF_EDGE_TEMPLATE,
                    max_contexts: int | None = None) -> DataFrame:
    """Per distinct (seed, ref): seed context from the seed papers, ref
    context and the first row's intents / influence / contexts from the
    reference table (all contexts, or the first ``max_contexts``).  Of several seed rows with one id
    the last counts.  ok = numeric strength."""
    r = refs.withColumn("seed_paper_id", F.col("seed_paper_id").cast("string")) \
            .withColumn("ref_paper_id", F.col("ref_paper_id").cast("string"))
    seed_ctx = last_per_key(seeds.where(F.col("paperId").isNotNull()).select(
        F.col("paperId").cast("string").alias("seed_paper_id"),
        F.coalesce("title", F.lit("")).alias("t_title"), F.coalesce("abstract", F.lit("")).alias("t_abs"), "pos"),
        ["seed_paper_id"], ["pos"]).drop("pos")
    ref_ctx = first_per_key(r.select("ref_paper_id", F.col("title").alias("r_title"),
                                     F.col("abstract").alias("r_abs"), "pos"), ["ref_paper_id"], ["pos"]).drop("pos")
    row0 = first_per_key(r.select("seed_paper_id", "ref_paper_id", "intents", "isInfluential", "contexts", "pos")
                         .where(F.col("seed_paper_id").isNotNull() & F.col("ref_paper_id").isNotNull()),
                         ["seed_paper_id", "ref_paper_id"], ["pos"]).drop("pos")
    contexts = F.coalesce("contexts", L.empty_str_array())
    k = row0.join(seed_ctx, "seed_paper_id", "left").join(ref_ctx, "ref_paper_id", "left")
    system = render(template, {
        "TARGET_TITLE": F.col("t_title"), "TARGET_ABSTRACT": F.col("t_abs"),
        "REF_TITLE": F.col("r_title"), "REF_ABSTRACT": F.col("r_abs"),
        "INTENTS": F.to_json(F.coalesce("intents", L.empty_str_array())),
        "IS_INF": F.initcap(F.coalesce(F.col("isInfluential"), F.lit(False)).cast("string")),
        "CONTEXTS": F.to_json(contexts if max_contexts is None else F.slice(contexts, 1, max_contexts))})
    s = _scored(k, system, USER_RAW_JSON, generator, responses, ("is_object", "strength"))
    ok = F.coalesce(F.col("p.is_object") & F.col("p.strength").isNotNull(), F.lit(False))
    res = s.select("seed_paper_id", "ref_paper_id", F.when(ok, clamp01(F.col("p.strength"))).alias("strength"),
                   F.col("raw").alias("edge_raw"), ok.alias("edge_ok"))
    return _back_join(r, res, ["seed_paper_id", "ref_paper_id"],
                      {"strength": F.lit(None).cast("double"), "edge_raw": F.lit(""), "edge_ok": F.lit(False)})


# --------------------------------------------------------------------------
# L7 concept extraction, L8 description
# --------------------------------------------------------------------------
def add_concepts(papers: DataFrame, generator: Generator | None = None, responses: DataFrame | None = None,
                 template: str = CONCEPTS_TEMPLATE, key: str = "pos") -> DataFrame:
    """Per row → ``proposed_concepts``, ``prerequisite_concepts`` (F14), raw, ok."""
    k = papers.select(key, X.strip(F.coalesce("title", F.lit(""))).alias("_t"),
                      X.strip(F.coalesce("abstract", F.lit(""))).alias("_a"))
    s = _scored(k, render(template, {"INPUT_TITLE": F.col("_t"), "INPUT_ABSTRACT": F.col("_a")}),
                USER_CONCEPTS, generator, responses, ("is_object", "proposed", "prerequisite"))
    ok = F.coalesce(F.col("p.is_object") & F.col("p.proposed").isNotNull() & F.col("p.prerequisite").isNotNull(),
                    F.lit(False))
    res = s.select(key, F.when(ok, L.clean_concepts(F.col("p.proposed"))).alias("proposed_concepts"),
                   F.when(ok, L.clean_concepts(F.col("p.prerequisite"))).alias("prerequisite_concepts"),
                   F.col("raw").alias("kc_raw"), ok.alias("kc_ok"))
    return _back_join(papers, res, [key], {"proposed_concepts": L.empty_str_array(),
                                           "prerequisite_concepts": L.empty_str_array(),
                                           "kc_raw": F.lit(""), "kc_ok": F.lit(False)})


def add_description(papers: DataFrame, generator: Generator | None = None, responses: DataFrame | None = None,
                    template: str = DESCRIPTION_TEMPLATE, key: str = "pos") -> DataFrame:
    """Per row → one-line ``description`` (F22), raw, ok; categories rendered by F21."""
    cat_t = dict(papers.dtypes).get("categories", "string")
    cats = (X.categories_text(F.col("categories")) if cat_t.startswith("array")
            else X.categories_text_from_string(F.col("categories")))
    k = papers.select(key, X.strip(F.coalesce("title", F.lit(""))).alias("_t"),
                      X.strip(F.coalesce("abstract", F.lit(""))).alias("_a"),
                      X.strip(F.coalesce(cats, F.lit(""))).alias("_c"))
    s = _scored(k, render(template, {"INPUT_TITLE": F.col("_t"), "INPUT_ABSTRACT": F.col("_a"),
                                     "INPUT_CATEGORIES": F.col("_c")}), USER_DESCRIPTION, generator, responses,
                ("is_object", "description"))
    ok = F.coalesce(F.col("p.is_object") & F.col("p.description").isNotNull(), F.lit(False))
    res = s.select(key, F.when(ok, X.one_line(F.col("p.description"))).otherwise(F.lit("")).alias("description"),
                   F.col("raw").alias("desc_raw"), ok.alias("desc_ok"))
    return _back_join(papers, res, [key], {"description": F.lit(""), "desc_raw": F.lit(""),
                                           "desc_ok": F.lit(False)})


# --------------------------------------------------------------------------
# L9 article prerequisites
# --------------------------------------------------------------------------
def article_prerequisites(articles: DataFrame, generator: Generator | None = None,
                          responses: DataFrame | None = None, system: str = ARTICLE_SYSTEM,
                          user_template: str = ARTICLE_USER,
                          max_links: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles ``(pos, title, links)`` with list-literal links → parsed
    results per article and the flattened ``(title, rank, prerequisite_topic,
    rationale)`` rows (F6).  Results are joined back by key (the reference
    attaches them by position inside a batch [Q1])."""
    a = articles.withColumn("links_parsed", L.literal_or_empty("links")) \
                .where(F.size("links_parsed") > 0)                                   # F2 / P6
    user = render(user_template, {"INPUT_TITLE": F.col("title"),
                                  "INPUT_LINKS": L.quoted_list(F.col("links_parsed"), max_links)})   # F26 / L1
    p = a.select("pos", "title", F.lit(system).alias("system"), user.alias("user")) \
         .withColumn("prompt_key", prompt_key(F.col("system"), F.col("user")))
    gen = generate(p, generator, responses)
    parsed = with_parsed(p.join(gen, "prompt_key", "left"), "raw", ("truthy", "prerequisites", "json"), "fenced")   # F24
    results = parsed.select("pos", F.col("title").alias("original_title"), F.col("p.json").alias("result"),
                            F.col("raw").alias("raw_output"),
                            F.coalesce(F.col("p.truthy"), F.lit(False)).alias("ok"))   # parsed and non-empty
    flat = parsed.where(F.col("p.prerequisites").isNotNull()).select(
        "pos", "title", F.posexplode("p.prerequisites").alias("_i", "x")).select(
        "pos", "_i", "title", F.col("x.rank").alias("rank"), F.col("x.topic").alias("prerequisite_topic"),
        F.col("x.rationale").alias("rationale"))                                     # F6
    return results, flat
