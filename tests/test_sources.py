"""S1-S5, S7, S8, S10 readers / writers on small files."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from noema.sources import files as S


def test_csv_reader(spark):
    d = tempfile.mkdtemp(prefix="noema-csv-")
    p = os.path.join(d, "topics.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(' topic_id , topic_name ,wikipedia_link\n1,"Machine\nlearning",https://x/ML\n2,NA,\n3,"say ""hi""",N/A\n')
    df = S.read_csv(spark, p, "topic_id long, topic_name string, wikipedia_link string")
    rows = [(r["pos"], r["topic_id"], r["topic_name"], r["wikipedia_link"]) for r in df.orderBy("pos").collect()]
    assert rows == [(0, 1, "Machine\nlearning", "https://x/ML"), (1, 2, None, None), (2, 3, 'say "hi"', None)]


def test_json_readers_and_writers(spark):
    d = tempfile.mkdtemp(prefix="noema-json-")
    seeds = {"total": 2, "token": None, "data": [
        {"paperId": "s1", "title": "A", "fieldsOfStudy": ["CS"], "s2FieldsOfStudy": [{"category": "Math"}]},
        {"paperId": None, "title": "no id"}]}
    with open(os.path.join(d, "papers.json"), "w") as f:
        json.dump(seeds, f, indent=2)
    sp = S.read_seed_papers(spark, os.path.join(d, "papers.json"))
    assert [(r["pos"], r["paperId"]) for r in sp.orderBy("pos").collect()] == [(0, "s1"), (1, None)]
    with open(os.path.join(d, "refs.jsonl"), "w") as f:
        f.write(json.dumps({"seed_paper_id": "s1", "data": [
            {"isInfluential": True, "citedPaper": {"paperId": "r1"}, "intents": ["x"], "contexts": []},
            {"citedPaper": {"paperId": "r2"}}]}) + "\n")
    refs = S.read_reference_responses(spark, os.path.join(d, "refs.jsonl"))
    assert [(r["ref_pos"], r["ref_paper_id"], r["isInfluential"]) for r in refs.collect()] == \
        [(0, "r1", True), (1, "r2", None)]
    with open(os.path.join(d, "details.jsonl"), "w") as f:
        f.write(json.dumps({"paperId": "r1", "citationCount": 3}) + "\n" + "null\n" + json.dumps({"title": "x"}) + "\n")
    assert [r["paperId"] for r in S.read_paper_details(spark, os.path.join(d, "details.jsonl")).collect()] == ["r1"]
    out = os.path.join(d, "out")
    S.write_csv(sp, os.path.join(out, "csv"), ["paperId", "fieldsOfStudy"])
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(out, "csv"))
    assert sorted((r["paperId"] or "", r["fieldsOfStudy"] or "") for r in back.collect()) == [("", ""), ("s1", '["CS"]')]
    S.write_json_lines(sp.select("paperId", "title"), os.path.join(out, "json"))
    assert spark.read.json(os.path.join(out, "json")).count() == 2
    S.write_graph_snapshot({"papers": sp.select("paperId")}, os.path.join(out, "graph"))
    assert S.read_graph_snapshot(spark, os.path.join(out, "graph"), ["papers"])["papers"].count() == 2


def test_input_order_across_files(spark):
    d = tempfile.mkdtemp(prefix="noema-order-")
    for name, rows in [("b.csv", ["3,c", "4,d"]), ("a.csv", ["1,a", "2,b"])]:
        with open(os.path.join(d, name), "w") as f:
            f.write("id,v\n" + "\n".join(rows) + "\n")
    df = S.read_csv(spark, d, "id long, v string")
    assert [r["v"] for r in df.orderBy("pos").collect()] == ["a", "b", "c", "d"]


def test_double_lookup(spark):
    from noema.operators.joins import lookup_twice
    dim = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 0)], "id long, name string, pos long")
    edges = spark.createDataFrame([(1, 2), (9, 1)], "src long, dst long")
    out = lookup_twice(edges, dim, "id", "name", [("src", "src_name"), ("dst", "dst_name")], dim_order="pos")
    got = sorted((r["src"], r["src_name"], r["dst_name"]) for r in out.collect())
    assert got == [(1, "y", "z"), (9, None, "y")]       # duplicate id: the last row wins


def test_seed_papers_are_exploded_before_any_shuffle(spark, tmp_path, monkeypatch):
    want = []
    for k, docs in enumerate([[["a", "b", "c"], ["d"]], [["e"], [], ["f", "g"]]]):  # two documents, then three
        saved = [{"total": len(d), "token": None, "data": [{"paperId": p, "title": p} for p in d]} for d in docs]
        (tmp_path / f"{k}.json").write_text(json.dumps(saved))
        want += [p for d in docs for p in d]
    shuffled, index = [], S.with_global_index
    monkeypatch.setattr(S, "with_global_index", lambda df, *a, **k: (shuffled.append(df), index(df, *a, **k))[1])
    out = S.read_seed_papers(spark, str(tmp_path))
    assert [(r.pos, r.paperId) for r in out.orderBy("pos").collect()] == list(enumerate(want))
    assert [("data" in df.columns, "paperId" in df.columns) for df in shuffled] == [(False, True)]


def test_input_order_of_many_blocks(spark, tmp_path):
    """Blocks of a file go to any tasks; rows come back in the order of the files' names and lines."""
    want = []
    for k in (3, 1, 2):
        lines = [f"{k}-{i}" + "x" * (i % 50) for i in range(900)]
        (tmp_path / f"part{k}.json").write_text("\n".join(json.dumps({"v": v}) for v in lines))
    for k in (1, 2, 3):
        want += [f"{k}-{i}" + "x" * (i % 50) for i in range(900)]
    conf = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.read.schema("v string").json(str(tmp_path))
        assert df.rdd.getNumPartitions() > 12
        out = S.with_input_order(df.select(F.concat("v", F.lit("")).alias("v")))
        assert [(r.pos, r.v) for r in out.orderBy("pos").collect()] == list(enumerate(want))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_rejected_json(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"paperId": "a", "year": 2000}\n{"paperId": "b", "ye\n\nnull\n{"title": "no id"}\n'
                                      '{"paperId": "c", "year": "not a year"}\n{"paperId": "d", "extra": 1}\n[1]\n')
    rows, bad = S.paper_details(spark, str(tmp_path / "d.jsonl"))
    assert sorted(r.paperId for r in rows.collect()) == ["a", "d"]
    got = sorted((r.reason, r.record) for r in bad.collect())
    assert got == sorted([("broken", '{"paperId": "b", "ye'), ("broken", '{"paperId": "c", "year": "not a year"}'), ("broken", "[1]"),
                          ("no paperId", '{"title":"no id"}')])
    assert all(r.file.endswith("d.jsonl") for r in bad.collect())
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text('{"total": 1,\n "data": [{"paperId": "x"}]}')
    (docs / "b.json").write_text('{"total": 1,\n "data": [{"paperId": "y"')
    (docs / "c.json").write_text('{"total": 1}')
    rows, bad = S.seed_papers(spark, str(docs))
    assert [(r.pos, r.paperId) for r in rows.collect()] == [(0, "x")]
    assert sorted((r.file[-6:], r.reason) for r in bad.collect()) == [("b.json", "broken"), ("c.json", "no data")]
    (tmp_path / "c.jsonl").write_text('{"batch_id": 1, "query": {"pages": {"1": {"title": "T"}}}}\n{"batch_id": 2, "query"\n{"batch_id": 3}\n')
    rows, bad = S.category_responses(spark, str(tmp_path / "c.jsonl"))
    assert [r.batch_id for r in rows.collect()] == [1] and sorted(r.reason for r in bad.collect()) == ["broken", "no query"]
