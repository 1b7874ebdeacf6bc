from noema.plans.kc_datasets import clean_metacademy, clean_tutorialbank, duplicate_report


def test_metacademy_fixture(spark):
    rows = [("A", "B"), ("A", " B "), ("A", "A"), ("C", "C"), ("D", None), ("B", "E"), (None, "F"),
            ("G\ufffddel's completeness theorem", "A")]
    raw = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                                "pos long, concept_wiki_canonical_title string, prereq_wiki_canonical_title string")
    res = clean_metacademy(raw)
    nodes = [(r["name"], r["link"]) for r in res.nodes.collect()]
    assert [n for n, _ in nodes] == ["A", "B", "D", "E", "Gödel's completeness theorem"]
    assert dict(nodes)["Gödel's completeness theorem"] == \
        "https://en.wikipedia.org/wiki/G%C3%B6del's_completeness_theorem"
    edges = [(r["name"], r["prereq_name"]) for r in res.edges.collect()]
    assert edges == [("A", "B"), ("B", "E"), ("Gödel's completeness theorem", "A")]
    assert res.missing_edge_names.count() == 0 and res.missing_edge_prereqs.count() == 0


def test_tutorialbank_fixture(spark):
    topics = spark.createDataFrame([
        (0, 1, "ML", "https://en.wikipedia.org/wiki/Machine_learning"),
        (1, 2, "CR", "https://en.wikipedia.org/wiki/Chain_rule/?x=1#top"),
        (2, 3, "X", None),
        (3, 4, "BP", "https://en.wikipedia.org/wiki/Backpropagation#History")],
        "pos long, topic_id long, topic_name string, wikipedia_link string")
    ann = spark.createDataFrame([(0, 2, 4, 1), (1, 1, 4, 0), (2, 3, 4, 1), (3, 4, 3, 1), (4, 9, 4, 1)],
                                "pos long, source_topic_id long, target_topic_id long, prereq_relation int")
    res = clean_tutorialbank(topics, ann)
    assert sorted(r["name"] for r in res.nodes.collect()) == ["Backpropagation", "Chain_rule", "Machine_learning"]
    edges = sorted((r["name"], r["prereq_name"] or "") for r in res.edges.collect())
    assert edges == [("Backpropagation", ""), ("Backpropagation", "Chain_rule")]
    assert res.unmatched.count() == 1


def test_duplicate_report(spark):
    a = spark.createDataFrame([("a",), (" b",)], "name string")
    b = spark.createDataFrame([("b",), ("c",)], "name string")
    ea = spark.createDataFrame([("x", "y"), ("p", None)], "name string, prereq_name string")
    eb = spark.createDataFrame([("x", "y"), (None, "q")], "name string, prereq_name string")
    names, pairs = duplicate_report(a, b, ea, eb)
    assert [r["name"] for r in names.collect()] == ["b"]
    assert [(r["name"], r["prereq_name"]) for r in pairs.collect()] == [("x", "y")]
