"""Flows with a deterministic fake generator: enrichment (L3-L9), paper flow
(E1), graph build (E3), articles (E4), resumable processing (S9)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from noema.operators import enrich as E
from noema.plans.articles import article_flow
from noema.plans.graph_build import build_graph, graph_stats
from noema.streaming.resume import run_resumable


def fake_model(systems, users):
    """Deterministic stand-in for the language model: answers from the prompt text."""
    out = []
    for s, u in zip(systems, users):
        if "list alias" in u:
            name = s.split("concept ", 1)[1].split(" as JSON", 1)[0]
            out.append(f'Sure: {{"alias": ["{name.upper()}", " {name} ", 3]}}')
        elif "proposed_concepts" in u:
            out.append('```json\n{"proposed_concepts": ["Graphs", " Trees "], "prerequisite_concepts": ["Sets"]}\n```')
        elif "description" in u:
            out.append('<think>hm</think>{"description": "  A paper\\n about graphs"}')
        elif u.startswith("Article "):
            out.append('```json\n{"prerequisites": [{"rank": 1, "topic": "A", "rationale": "r"}, {"topic": "B"}]}\n```')
        else:
            out.append('{"strength": 1.5, "reason": " because "}')
    return out


def test_enrichment_steps(spark):
    df = spark.createDataFrame([("Graph", 0), ("Graph", 1), ("Tree", 2)], "name string, pos long")
    out = {r["pos"]: r for r in E.add_alias(df, fake_model).collect()}
    assert out[0]["alias"] == ["GRAPH"] and out[1]["alias"] == ["GRAPH"] and out[0]["alias_ok"]
    edges = spark.createDataFrame([("A", "B"), ("A", None)], "name string, prereq_name string")
    sc = {r["prereq_name"]: r for r in E.score_prereq_edges(edges, fake_model).collect()}
    assert sc["B"]["strength"] == 1.0 and sc["B"]["reason"] == "because" and sc["B"]["edge_ok"]
    assert sc[None]["edge_ok"] is False and sc[None]["edge_raw"] == ""


def test_offline_responses_table(spark):
    df = spark.createDataFrame([("Graph", 0)], "name string, pos long")
    key = E.prompt_key(E.render(E.ALIAS_TEMPLATE, {"INPUT_TITLE": F.lit("Graph")}), F.lit(E.USER_ALIAS))
    resp = spark.range(1).select(key.alias("prompt_key"), F.lit('{"alias": ["G"]}').alias("raw"))
    assert E.add_alias(df, responses=resp).first()["alias"] == ["G"]


def test_paper_side_enrichment(spark):
    papers = spark.createDataFrame([(0, "p1", "T1", "abs", ["CS", "Math"])],
                                   "pos long, paperId string, title string, abstract string, categories array<string>")
    d = E.add_description(papers, fake_model).first()
    assert d["description"] == "A paper about graphs." and d["desc_ok"]
    k = E.add_concepts(papers, fake_model).first()
    assert k["proposed_concepts"] == ["Graphs", "Trees"] and k["prerequisite_concepts"] == ["Sets"]


def test_articles(spark):
    arts = spark.createDataFrame([(0, "Graph", "['Vertex', 'Edge']"), (1, "Empty", "[]"), (2, "Bad", "x")],
                                 "pos long, title string, links string")
    results, flat, stats, top = article_flow(arts, fake_model)
    assert results.count() == 1
    assert sorted((r["rank"], r["prerequisite_topic"], r["rationale"]) for r in flat.collect()) == \
        [(0, "B", ""), (1, "A", "r")]
    s = stats.first()
    assert (s["n_total"], s["n_ok"], s["mean_per_ok"]) == (1, 1, 2.0)
    assert top.count() == 2
    from noema.plans.articles import write_article_outputs
    out = tempfile.mkdtemp(prefix="noema-article-out-")
    write_article_outputs(results, flat, out)
    assert spark.read.json(os.path.join(out, "results")).count() == 1


def test_graph_build(spark):
    kw1 = spark.createDataFrame([(0, "Machine Learning", None, "['ML']", "['AI']"), (1, "K", "a", "x", None)],
                                "pos long, name string, link string, alias string, categories string")
    kw2 = spark.createDataFrame([(0, "K", None, "['y']", None)],
                                "pos long, name string, link string, alias string, categories string")
    pre = spark.createDataFrame([(0, "K", "Machine Learning", 0.2, None), (1, "K", "Machine Learning", 0.9, "r"),
                                 (2, "K", "Nope", 1.0, None)],
                                "pos long, name string, prereq_name string, strength double, reason string")
    kc = spark.createDataFrame([(0, "ml", "L1", "['machine-learning', 'ML']", "['AI', 'CS']"),
                                (1, "Deep Net", "L2", "['DNN']", "[]")],
                               "pos long, name string, link string, alias string, categories string")
    papers = spark.createDataFrame([(0, "p0", "Paper One", None), (1, "p2", "Paper Two", "['CS']"),
                                    (2, "p3", "  ", None), (3, "p1", "Paper One", None)],
                                   "pos long, paperId string, title string, categories string")
    pkc = spark.createDataFrame([(0, "p1", " ML ", "ABOUT", 0.5, None), (1, "p1", "dnn", "IN", 0.4, "x"),
                                 (2, "p2", "unknown", "ABOUT", 0.1, None)],
                                "pos long, paperId string, concept string, name string, strength double, reason string")
    refs = spark.createDataFrame([(0, "p2", "p1", "['background']", True, 0.7, "[]"),
                                  (1, "p9", "p1", "[]", False, 0.1, "[]")],
                                 "pos long, ref_paper_id string, seed_paper_id string, intents string, "
                                 "isInfluential boolean, strength double, contexts string")
    g = build_graph([kw1, kw2], [pre], kc, papers, pkc, refs)
    kws = {r["name"]: r for r in g.keywords.collect()}
    assert kws["K"]["link"] is None and kws["K"]["alias"] == ["y"]            # later source replaces
    assert kws["Machine Learning"]["alias"] == ["ML", "ml", "machine-learning"]
    assert "Deep Net" in kws
    assert [(r["source"], r["target"], r["strength"]) for r in g.prereq.collect()] == [("Machine Learning", "K", 0.9)]
    assert [(r["paperId"], r["keyword_name"]) for r in g.about.collect()] == [("p1", "Machine Learning")]
    assert [(r["keyword_name"], r["paperId"]) for r in g.in_edges.collect()] == [("Deep Net", "p1")]
    assert [(r["ref_paper_id"], r["seed_paper_id"]) for r in g.ref_by.collect()] == [("p2", "p1")]
    assert g.quarantined_papers.count() == 1
    assert [(r["paperId"], r["kept_paperId"]) for r in g.collapsed_papers.collect()] == [("p0", "p1")]
    s = {r["table"]: r["n"] for r in graph_stats(g).collect()}
    assert (s["keywords"], s["papers"], s["failed_mappings"], s["created"], s["merged"]) == (3, 2, 1, 1, 1)


def test_resumable_stream(spark):
    base = tempfile.mkdtemp(prefix="noema-resume-")
    inp = os.path.join(base, "in")
    os.makedirs(inp)
    for i, names in enumerate([["a", "b"], ["b", "c"]]):
        with open(os.path.join(inp, f"part{i}.json"), "w") as f:
            f.write("\n".join(json.dumps({"name": n}) for n in names))
    calls = []

    def process(df):
        calls.append(1)
        return df.withColumn("result", F.upper("name"))
    done = os.path.join(base, "done")
    ckpt = os.path.join(base, "ckpt")
    out = run_resumable(spark, inp, "name string", "name", process, done, ckpt, fmt="json", max_files_per_trigger=1)
    assert sorted(r["name"] for r in out.collect()) == ["a", "b", "c"]
    # a restart finds nothing new
    out2 = run_resumable(spark, inp, "name string", "name", process, done, ckpt, fmt="json")
    assert out2.count() == 3


def test_paper_flow_end_to_end(spark):
    from noema.plans.papers import paper_flow
    from noema.schemas import PAPER
    seeds = spark.createDataFrame(
        [(0, "s1", "Seed paper", 2020, "u", "seed abstract", "V", 10, 100, ["CS"], None, None)],
        "pos long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAPER.fields))
    responses = spark.createDataFrame(
        [("s1", 0, "r1", True, ["background"], ["ctx"]), ("s1", 1, "r2", False, [], [])],
        "seed_paper_id string, ref_pos int, ref_paper_id string, isInfluential boolean, "
        "intents array<string>, contexts array<string>")
    details = spark.createDataFrame([("r1", "Ref one", None, None, "ref abs", None, None, 5, None, None, None),
                                     ("r2", "Ref two", None, None, None, None, None, None, None, None, None)], PAPER)
    wiki = spark.createDataFrame([(0, "Graph theory", "['Graphs', 'Trees']")], "pos long, title string, subtitles string")
    res = paper_flow(seeds, responses, details, wiki, fake_model)
    assert sorted(r["ref_paper_id"] for r in res.references.collect()) == ["r1", "r2"]
    nodes = {r["paperId"]: r for r in res.paper_nodes.collect()}
    assert sorted(nodes) == ["r1", "r2", "s1"] and nodes["s1"]["description"] == "A paper about graphs."
    kc = {r["name"]: r for r in res.kc_nodes.collect()}
    assert kc["Graphs"]["link"] == "https://en.wikipedia.org/wiki/Graph_theory#Graphs"
    assert "Sets" in kc and kc["Sets"]["link"] is None
    edges = res.paper_kc_edges.collect()
    assert {(r["paperId"], r["concept"], r["name"]) for r in edges} >= {("s1", "Graphs", "ABOUT"), ("s1", "Sets", "IN")}
    assert all(r["strength"] == 1.0 for r in edges)
    ref = {r["ref_paper_id"]: r for r in res.ref_edges.collect()}
    assert ref["r1"]["name"] == "REF_BY" and ref["r1"]["strength"] == 1.0 and ref["r1"]["edge_ok"]
    from noema.plans.papers import write_paper_outputs
    out = tempfile.mkdtemp(prefix="noema-paper-out-")
    write_paper_outputs(res, out)
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(out, "nodes_kc"))
    assert back.count() == res.kc_nodes.count()
