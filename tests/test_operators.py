"""Operator cases from FIXTURES: D5/W1/W3, D1, A2, J10, G1/G3, G2/J11, G5/J9, J14/A10/J13."""

from pyspark.sql import functions as F

from noema.operators import aggregates as A, graph as G
from noema.operators.categories import RESPONSE, fill_from_lookup, page_hits
from noema.operators.wikimatch import wiki_map
from noema.plans.papers import build_paper_nodes, select_references
from noema.schemas import PAPER


def test_topk_references_fixture(spark):
    refs = [("r1", False, 10), ("r2", True, 5), ("r1", True, 99), (None, False, 1), ("r3", False, None),
            ("r4", False, 10), ("r5", True, 5), ("r6", False, 100), ("r7", False, None)]
    responses = spark.createDataFrame(
        [("s1", i, r, inf, ["x"], ["c"]) for i, (r, inf, _) in enumerate(refs)],
        "seed_paper_id string, ref_pos int, ref_paper_id string, isInfluential boolean, "
        "intents array<string>, contexts array<string>")
    cits = {"r1": 10, "r2": 5, "r3": None, "r4": 10, "r5": 5, "r6": 100}
    details = spark.createDataFrame([(k, f"T{k}", None, None, None, None, None, v, None, None, None)
                                     for k, v in cits.items()], PAPER)
    seeds = spark.createDataFrame([("s1", "seed", None, None, None, None, None, None, None, None, None),
                                   ("s2", "no refs", None, None, None, None, None, None, None, None, None)], PAPER)
    out, errors = select_references(seeds, responses, details, 5)
    got = [r["ref_paper_id"] for r in out.orderBy("rank").collect()]
    assert got == ["r2", "r5", "r6", "r1", "r4"]
    assert len(out.columns) == 15  # 14 reference columns + rank
    assert sorted((r["seed_paper_id"], r["kind"]) for r in errors.collect()) == [("s2", "references")]


def test_paper_nodes_fixture(spark):
    papers = spark.createDataFrame([(0, "p1", "A", "V1"), (1, "p2", "B", "V2")],
                                   "pos long, paperId string, title string, venue string")
    refs = spark.createDataFrame([(0, "s", "p2", "B-ref"), (1, "s", "p3", "C1"), (2, "s", "p3", "C2")],
                                 "pos long, seed_paper_id string, ref_paper_id string, title string")
    nodes = {r["paperId"]: r for r in build_paper_nodes(papers, refs).collect()}
    assert sorted(nodes) == ["p1", "p2", "p3"]
    assert nodes["p2"]["title"] == "B" and nodes["p2"]["publication"] == "V2"
    assert nodes["p3"]["title"] == "C1"


def test_finalize_kc_fixture(spark):
    df = spark.createDataFrame([(0, "X", None, ["x", " x ", "y"], None), (1, "X", "https://w/A", ["y", "X"], "c"),
                                (2, "X", "https://w/A#b", None, None)],
                               "pos long, name string, link string, alias array<string>, category string")
    r = A.finalize_kc_nodes(df).first()
    assert r["link"] == "https://w/A#b" and r["alias"] == ["x", "y"] and r["categories"] is None
    assert r["category"] == "c"


def test_wiki_map_fixture(spark):
    wiki = spark.createDataFrame([(0, "Neural network", "['Training', 'Back  propagation']"),
                                  (1, "Backpropagation", "[]"), (2, "training", "['Loss']")],
                                 "pos long, title string, subtitles string")
    nodes = spark.createDataFrame([(0, "backpropagation", ["BP", "back propagation"]), (1, "Training", []),
                                   (2, "NEURAL NETWORK", ["NN"]), (3, "Loss fn", ["lf", "lf"])],
                                  "node_id long, name string, alias array<string>")
    got = {r["node_id"]: (r["name"], r["alias"], r["link"], r["wiki_match_type"])
           for r in wiki_map(nodes, wiki).collect()}
    assert got[0] == ("Back  propagation", ["backpropagation", "BP"],
                      "https://en.wikipedia.org/wiki/Neural_network#Back__propagation", "subtitle")
    assert got[1] == ("Training", ["Training"], "https://en.wikipedia.org/wiki/Neural_network#Training", "subtitle")
    assert got[2] == ("Neural network", ["NN", "NEURAL NETWORK"], "https://en.wikipedia.org/wiki/Neural_network",
                      "title")
    assert got[3] == ("Loss fn", ["lf"], None, None)


def test_overlay_and_edges(spark):
    inc = spark.createDataFrame([("K", "a", ["x"], 1, 0), ("K", None, ["y"], 2, 0)],
                                "name string, link string, alias array<string>, so int, pos long")
    r = G.upsert_nodes(None, inc, "name", ["so", "pos"]).first()
    assert r["link"] is None and r["alias"] == ["y"]
    nodes = spark.createDataFrame([("A",), ("B",)], "name string")
    edges = spark.createDataFrame([("A", "B", 0.2, 0), ("A", "B", 0.9, 1), ("A", "Z", 1.0, 2)],
                                  "src string, dst string, strength double, pos long")
    written, dangling = G.upsert_edges(edges, "src", "dst", ["pos"], nodes, "name", nodes, "name")
    assert [(r["src"], r["dst"], r["strength"]) for r in written.collect()] == [("A", "B", 0.9)]
    assert dangling.count() == 1


def test_alias_map_fixture(spark):
    nodes = spark.createDataFrame([("Machine Learning", ["ML", "ml", "machine-learning", "dnn", "Machine-Learning"], 0),
                                   ("Deep Net", ["DNN"], 1)], "name string, alias array<string>, ord long")
    amap = G.alias_map(nodes, "name", "alias", [F.col("ord")])
    edges = spark.createDataFrame([("p", " ML "), ("p", "dnn"), ("p", "unknown")], "paperId string, concept string")
    ok, failed = G.map_concepts(edges, amap, "concept")
    assert sorted((r["concept"], r["keyword_name"]) for r in ok.collect()) == \
        [(" ML ", "Machine Learning"), ("dnn", "Deep Net")]
    assert [(r["concept"], r["reason"]) for r in failed.collect()] == [("unknown", G.NO_MATCH_REASON)]


def test_category_lookup_fixture(spark):
    responses = spark.read.json(spark.sparkContext.parallelize([
        '{"batch_id":0,"part":0,"query":{"redirects":[{"from":"NLP","to":"Natural language processing"}],'
        '"pages":{"1":{"title":"Natural language processing","categories":[{"title":"Category:AI"}]},'
        '"-1":{"title":"Nope","missing":""}}}}',
        '{"batch_id":0,"part":1,"query":{"pages":{"1":{"title":"Natural language processing",'
        '"categories":[{"title":"Category:Linguistics"},{"title":"Category:AI"}]}}}}']),
        schema=RESPONSE)
    names = spark.createDataFrame([("NLP", None, []), ("Nope", "keep", [])],
                                  "name string, link string, categories array<string>")
    hits = page_hits(responses, names)
    out = {r["name"]: (r["link"], r["categories"]) for r in fill_from_lookup(names, hits).collect()}
    assert out["NLP"] == ("https://en.wikipedia.org/wiki/Natural_language_processing", ["AI", "Linguistics"])
    assert out["Nope"] == ("keep", [])


def test_upsert_onto_existing_snapshot(spark):
    current = spark.createDataFrame([("K", "old", ["a"]), ("L", "keep", ["b"])],
                                    "name string, link string, alias array<string>")
    incoming = spark.createDataFrame([("K", None, ["z"], 0), ("M", "new", [], 1)],
                                     "name string, link string, alias array<string>, pos long")
    out = {r["name"]: (r["link"], r["alias"]) for r in G.upsert_nodes(current, incoming, "name", ["pos"]).collect()}
    assert out == {"K": (None, ["z"]), "L": ("keep", ["b"]), "M": ("new", [])}


def test_describe_skips_null_and_nan_and_handles_hot_values(spark):
    from noema.operators.aggregates import describe
    nan = float("nan")
    df = spark.createDataFrame([(x,) for x in [1.0, nan, 3.0, None]], "v double")
    r = describe(df, "v").first()
    assert (r["count"], r["mean"], r["p25"], r["p50"], r["p75"], r["min"], r["max"]) == (2, 2.0, 1.5, 2.0, 2.5, 1.0, 3.0)
    assert abs(r["std"] - 2 ** 0.5) < 1e-12
    hot = spark.createDataFrame([(0.0,)] * 500 + [(float(i),) for i in range(1, 501)], "v double")
    r = describe(hot, "v").first()
    assert (r["count"], r["p25"], r["p50"], r["p75"]) == (1000, 0.0, 0.5, 250.25)
    one = describe(spark.createDataFrame([(4.0,)], "v double"), "v").first()
    assert (one["count"], one["std"], one["p50"]) == (1, None, 4.0)
    none = describe(spark.createDataFrame([], "v double"), "v").first()
    assert (none["count"], none["mean"], none["p50"]) == (0, None, None)


def test_page_hits_prefers_exact_titles_and_never_mixes_pages(spark):
    from noema.operators.categories import RESPONSE, page_hits
    page = lambda t, *c: (t, None, [(f"Category:{x}",) for x in c])
    data = [(1, 0, (None, None, {"1": page("IT", "Computing")})), (2, 0, (None, None, {"2": page("It", "Pronouns", "Films")})),
            (2, 1, (None, None, {"2": page("It", "English")})),
            (3, 0, ([("Learning machine", "Machine learning")], [("learning machine", "Learning machine")],
                    {"3": page("Machine learning", "AI")})),
            (4, 0, (None, [("x", "Elsewhere")], {"-1": page("X")}))]
    hits = {r["name"]: (r["page_title"], r["new_categories"]) for r in page_hits(
        spark.createDataFrame(data, RESPONSE),
        spark.createDataFrame([("It",), ("IT",), ("learning machine",), ("x",), (None,)], "name string")).collect()}
    assert hits == {"It": ("It", ["English", "Films", "Pronouns"]), "IT": ("IT", ["Computing"]),
                    "learning machine": ("Machine learning", ["AI"])}


def test_bad_model_texts_never_fail_the_job(spark):
    from noema.functions import jsonx as J
    texts = ['{"strength": ' + "9" * 400 + "}", '{"reason": "\\ud800 x"}', '{"prerequisites": [{"rank": 1.0, "topic": "a"}, '
             '{"rank": 99999999999999999999}]}', "[" * 5000, '{"a":' * 3000, "```json\n{\"strength\": 0.5}\n```", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    fields = tuple(J.PARSED.fieldNames())
    rows = {r["i"]: r["p"] for r in J.with_parsed(df, "t", fields).collect()}
    assert not rows[0]["is_object"] and rows[0]["strength"] is None
    assert rows[1]["reason"] == "\ufffd x"
    assert [x["rank"] for x in rows[2]["prerequisites"]] == [1, None]
    assert not any(rows[i]["is_object"] for i in (3, 4, 6, 7)) and rows[5]["strength"] == 0.5
    fenced = J.with_parsed(df, "t", fields, "fenced").collect()
    assert {r["i"] for r in fenced if r["p"]["is_object"]} >= {1, 2, 5}
