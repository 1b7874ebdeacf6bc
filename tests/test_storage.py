"""Bucketed snapshots, uniqueness at the write, the adjacency layout, counters of a write."""

import json
import os
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from noema.operators.adjacency import write_adjacency
from noema.operators.metrics import counted, write_counted
from noema.sources import snapshots as S

NODES = "id bigint, label string, pos int"


def nodes(spark, rows):
    return spark.createDataFrame(rows, NODES)


def content(spark, root, number=None):
    return sorted((r.id, r.label) for r in S.read_snapshot(spark, root, number).collect())


def files(spark, root):
    """bucket -> the names of its current files"""
    v = S.version(spark, root)
    return {b: sorted(f for f in os.listdir(f"{root}/{p}") if f.endswith(".parquet")) for b, p in v.folders.items()}


def test_upserts_rewrite_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    assert S.upsert_snapshot(root, nodes(spark, []), ["id"], ["pos"], buckets=8) == 0
    assert S.upsert_snapshot(root, nodes(spark, [(i, f"a{i}", 0) for i in range(100)]), ["id"], ["pos"], buckets=8) == 1
    before = files(spark, root)
    assert set(before) == set(range(8)) and all(len(f) == 1 for f in before.values())
    assert S.upsert_snapshot(root, nodes(spark, [(5, "late", 2), (5, "early", 1), (5, "late too", 2), (1000, None, 0)]), ["id"], ["pos"]) == 2
    want = {i: f"a{i}" for i in range(100)} | {5: "late too", 1000: None}
    assert content(spark, root) == sorted(want.items())
    after = files(spark, root)
    touched = {r.b for r in nodes(spark, [(5, "", 0), (1000, "", 0)]).select(S._bucket(["id"], 8).alias("b")).collect()}
    assert {b for b in after if after[b] != before[b]} == touched and len(touched) < 8
    assert content(spark, root, 1) == [(i, f"a{i}") for i in range(100)]          # the older version is still there
    assert S.upsert_snapshot(root, nodes(spark, []), ["id"], ["pos"]) == 2


def test_a_write_that_fails_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    S.upsert_snapshot(root, nodes(spark, [(1, "a", 0), (2, "b", 0)]), ["id"], ["pos"], buckets=4)

    def fails(*a, **k):
        raise RuntimeError("lost")
    monkeypatch.setattr(S, "json", SimpleNamespace(loads=json.loads, dumps=fails))
    with pytest.raises(RuntimeError):
        S.upsert_snapshot(root, nodes(spark, [(1, "half", 0), (3, "c", 0)]), ["id"], ["pos"])
    monkeypatch.undo()
    assert os.path.isdir(f"{root}/data/version=2") and content(spark, root) == [(1, "a"), (2, "b")]
    assert S.upsert_snapshot(root, nodes(spark, [(1, "whole", 0)]), ["id"], ["pos"]) == 2
    assert content(spark, root) == [(1, "whole"), (2, "b")]


def test_new_columns_are_null_in_older_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    S.upsert_snapshot(root, nodes(spark, [(i, "a", 0) for i in range(20)]), ["id"], ["pos"], buckets=4)
    S.upsert_snapshot(root, nodes(spark, [(3, "b", 0)]).withColumn("more", F.lit(7)), ["id"], ["pos"])
    got = {r.id: (r.label, r.more) for r in S.read_snapshot(spark, root).collect()}
    assert got[3] == ("b", 7) and got[4] == ("a", None) and len(got) == 20


def test_no_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_snapshot(spark, str(tmp_path / "none"))


def test_unique_keys_are_enforced_and_counted(spark, tmp_path):
    root = str(tmp_path / "t")
    one = S.insert_unique(root, nodes(spark, [(1, "a", 3), (1, "first", 1), (2, "b", 0), (None, "n", 0)] + [(9, "hot", 10 + i) for i in range(50)]),
                          ["id"], ["pos"], buckets=4)
    assert one == {"version": 1, "accepted": 3, "stored": 0, "repeated": 50, "null": 1}
    assert content(spark, root) == [(1, "first"), (2, "b"), (9, "hot")]
    two = S.insert_unique(root, nodes(spark, [(2, "again", 0), (2, "again", 1), (3, "c", 0)]), ["id"], ["pos"])
    assert two == {"version": 2, "accepted": 1, "stored": 2, "repeated": 0, "null": 0}
    assert content(spark, root) == [(1, "first"), (2, "b"), (3, "c"), (9, "hot")]
    bad = sorted((r.id, r.label, r.reason) for r in S.read_rejects(spark, root, 2).collect())
    assert bad == [(2, "again", "stored"), (2, "again", "stored")]
    assert S.read_rejects(spark, root, 1).count() == 51


def adjacency(spark, tmp_path):
    people = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id bigint, name string")
    edges = spark.createDataFrame([(i, (i * 7) % 50, i * 0.5) for i in range(50)] + [(1, 99, 0.0), (99, 1, 0.0), (None, 2, 0.0)],
                                  "a bigint, b bigint, w double")
    return write_adjacency(f"t{uuid.uuid4().hex}", str(tmp_path / "adj"), people, "id", "name", edges, "a", "b", ["w"], buckets=4)


def test_one_hop_scans_both_ways(spark, tmp_path):
    adj = adjacency(spark, tmp_path)
    want = sorted((f"n{i}", f"n{(i * 7) % 50}", i * 0.5) for i in range(50))
    for df in (adj.hop_out(spark), adj.hop_in(spark)):
        assert sorted((r.source, r.target, r.w) for r in df.collect()) == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_one_hop_scans_have_no_exchange(spark, tmp_path, adaptive):
    adj, was = adjacency(spark, tmp_path), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for df in (adj.hop_out(spark), adj.hop_in(spark)):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_counts_are_taken_while_writing(spark, tmp_path):
    base = spark.range(100).withColumn("action", F.when(F.col("id") % 4 == 0, "created").otherwise("merged"))
    got = write_counted({"nodes": spark.range(7), "actions": base}, str(tmp_path / "g"),
                        {"actions": {k: F.col("action") == k for k in ("created", "merged", "lost")}})
    assert {r.table: r.n for r in got.collect()} == {"nodes": 7, "actions": 100, "created": 25, "merged": 75, "lost": 0}
    assert spark.read.parquet(str(tmp_path / "g" / "actions")).count() == 100
    spark.range(10).write.parquet(str(tmp_path / "in"))
    df, seen = counted(spark.read.parquet(str(tmp_path / "in")), odd=F.col("id") % 2 == 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Aggregate" not in plan
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"n": 10, "odd": 5}


def test_saved_references_written_by_tasks_that_follow_the_rows(spark, tmp_path):
    """5,000 customers in one small file, a key twice and one null: three files of responses, not one."""
    from noema.plans.evidence import saved_references
    keys = [*range(4_998), 7, None]
    spark.createDataFrame([(k,) for k in keys], "c_custkey bigint").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    out = saved_references(spark, str(tmp_path))
    assert len(out.inputFiles()) == 3
    assert out.count() == 150 * len(keys) and out.where("seed_paper_id = 7").count() == 300
    row = out.where("seed_paper_id = 9 AND ref_pos = 149").first()
    assert (row.ref_paper_id, row.isInfluential) == ("r212", False)


def test_spread_keeps_the_rows(spark):
    from noema.operators.rows import spread
    df = spark.range(0, 1_001, 1, 1)
    out = spread(df, 100)
    assert out.rdd.getNumPartitions() == 11 and out.agg(F.sum("id")).first()[0] == 500_500
    assert spread(df.where("id < 0"), 100).count() == 0
