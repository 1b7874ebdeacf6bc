from pyspark.sql import functions as F

from noema.operators import columns as C
from noema.operators.aggregates import column_profile, describe, frequency
from noema.operators.rows import batch_number, with_global_index


def test_column_helpers(spark):
    df = spark.createDataFrame([(0, "a", True, "x" * 400), (1, None, False, "bad"), (2, "c", None, "y")],
                               "pos long, name string, ok boolean, raw string")
    assert C.ensure_columns(df, {"alias": "array<string>"}).schema["alias"].dataType.simpleString() == "array<string>"
    assert C.drop_null(df, ["name"]).count() == 2
    rej = C.rejected(df, "ok", ["pos"], ["pos"], 5, "raw", 2).collect()
    assert [(r["pos"], r["raw"]) for r in rej] == [(1, "ba"), (2, "y")]
    assert [r["name"] for r in C.sorted_distinct(df, "name").collect()] == ["a", "c"]
    assert C.at_position(df, 2).first()["name"] == "c"
    s = C.stage_counts("load", df, missing_name=F.col("name").isNull()).first()
    assert (s["stage"], s["rows"], s["missing_name"]) == ("load", 3, 1)
    assert {r["name"]: r["count"] for r in frequency(df, "name").collect()} == {"a": 1, None: 1, "c": 1}
    prof = {r["column_name"]: r["non_null"] for r in column_profile(df).collect()}
    assert prof == {"pos": 3, "name": 2, "ok": 2, "raw": 3}


def test_global_index_and_batches(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    idx = with_global_index(df, ["v"], "i", partitions=5)
    assert sorted((r["v"], r["i"]) for r in idx.collect()) == [(v, v) for v in range(1000)]
    b = batch_number(df, ["v"], 300)
    assert sorted({r["batch"] for r in b.collect()}) == [0, 1, 2, 3]


def test_describe_matches_numpy(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(3).normal(10, 3, 501)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = describe(df, "x").first()
    a = np.array(vals)
    assert r["count"] == 501 and abs(r["mean"] - a.mean()) < 1e-9 and abs(r["std"] - a.std(ddof=1)) < 1e-9
    for q, k in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]:
        assert abs(r[k] - np.quantile(a, q)) < 1e-9


def test_top_cited_and_one_hop(spark):
    from noema.operators.graph import graph_counts, one_hop
    papers = spark.createDataFrame([("p1", "Deep nets", None, 5), ("p2", "Graph theory", "about graphs", 50),
                                    ("p3", "Cooking", None, 99), ("p4", "Deep graphs", None, 50)],
                                   "paperId string, title string, abstract string, citationCount long")
    got = [r["paperId"] for r in C.top_cited(papers, "(?i)deep|graph", 2).collect()]
    assert got == ["p2", "p4"]
    nodes = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "k string, name string")
    edges = spark.createDataFrame([("A", "B", 0.5), ("A", "Z", 0.1)], "s string, d string, strength double")
    hop = one_hop(edges, "s", "d", nodes, "k", "name", nodes, "k", "name", ["strength"]).collect()
    assert [(r["source"], r["target"], r["strength"]) for r in hop] == [("Alpha", "Beta", 0.5)]
    assert {r["table"]: r["n"] for r in graph_counts({"nodes": nodes, "edges": edges}).collect()} == \
        {"nodes": 2, "edges": 2}


def test_small_list_functions(spark):
    from noema.functions import lists as L, text as X
    df = spark.createDataFrame([("a, b, c", ["x", "y"], "['AI', 'ML']", "Category:Natural_language")],
                               "s string, l array<string>, c string, t string")
    r = df.select(L.split_alias("s").alias("a"), L.quoted_list("l", 1).alias("q"),
                  L.merge_categories("c", F.array(F.lit("CS"), F.lit("AI"))).alias("m"),
                  X.page_key(X.strip_category_prefix("t")).alias("k"),
                  X.categories_text_from_string("c").alias("ct")).first()
    assert r["a"] == ["a", "b", "c"] and r["q"] == '"x"'
    assert r["m"] == ["AI", "CS", "ML"] and r["k"] == "natural language" and r["ct"] == "AI, ML"
