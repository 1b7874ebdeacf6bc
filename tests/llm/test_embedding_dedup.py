import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, functions as F

from noema.llm import embedding_dedup as E

VECS = "vec_id bigint, embedding array<float>, label int"


def usable(v, label):
    return label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)


def brute_force(rows, threshold=0.98):
    data = [(i, np.array(v, np.float32).astype(float) if usable(v, label) else None, label) for i, v, label in rows]
    n = len(data)

    def link(a, b):
        if data[a][1] is None or data[b][1] is None or data[a][2] != data[b][2] or len(data[a][1]) != len(data[b][1]):
            return False
        x, y = data[a][1], data[b][1]
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold
    near = [[b for b in range(n) if b != a and link(a, b)] for a in range(n)]
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        comp = min(data[b][0] for b in seen)
        out.append((data[a][0], len(near[a]), comp, comp == data[a][0]))
    return sorted(out)


def corpus(seed, n=160, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for _ in range(n):
        c = centres[rng.integers(12)]
        v = c + rng.normal(size=dim) * rng.choice([0, 0.05, 0.15, 0.3, 1.0])
        rows.append(((v * rng.choice([1, 1, 3])).tolist(), int(rng.integers(2))))
    rows += [(rows[0][0], rows[0][1])] * 30
    rows += [(None, 0), ([0.0] * dim, 0), ([float("nan")] * dim, 1), ([None] + [1.0] * (dim - 1), 1), ([], 0),
             (rows[3][0], None), ([float("inf")] + [1.0] * (dim - 1), 0), ([1.0, 2.0], 0), ([2.0, 4.0], 0), ([-0.0] * dim, 1),
             ([0.0, 1.0], 0), ([-0.0, 1.0], 0)]
    random.Random(seed).shuffle(rows)
    return [(5 * i + 2, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("seed, cell, block", [(1, 512, 1024), (2, 10, 1024), (3, 10, 4), (4, 512, 7)])
def test_same_as_brute_force(spark, seed, cell, block):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, VECS).withColumn("rid", F.lit(1)).withColumn("item", F.lit("x")).repartition(3)
    got = sorted(tuple(r) for r in E.near_duplicate_vectors(df, cell_rows=cell, large_rows=4 * cell, block_rows=block).collect())
    assert got == brute_force(rows)


def test_every_label_with_several_vectors_gets_pivots(spark, monkeypatch):
    """The given table runs the range join, and many small labels do too."""
    split, table = [], E.table

    def seen(df, name):
        out = table(df, name)
        if name == "split-cells":
            split.append(out)
        return out
    monkeypatch.setattr(E, "table", seen)
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    E.near_duplicate_vectors(v).count()
    labels = v.where("label is not null").select(F.xxhash64(F.col("label").cast("bigint"), F.size("embedding").cast("bigint")).alias("g")).distinct()
    assert {r.parent for r in split[0].select("parent").distinct().collect()} == {r.g for r in labels.collect()}
    assert all(r.n >= 2 for r in split[0].groupBy("parent").agg(F.countDistinct("grp").alias("n")).collect())
    split.clear()
    many = spark.range(6000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), (F.col("id") % 3) * 0.5, F.lit(0.1)).cast("array<float>").alias("embedding"),
                                    (F.col("id") / 3).cast("int").alias("label"))
    out = E.near_duplicate_vectors(many).agg(F.sum("n_links"), F.count_if("kept")).first()
    assert tuple(out) == (0, 6000) and split[0].select("parent").distinct().count() == 2000


def test_cells_are_split_again_unless_they_are_dense(spark):
    g = np.random.default_rng(0)
    loose = [(i, v.tolist(), 0) for i, v in enumerate(g.normal(size=(700, 6)))]
    dense = [(1000 + i, (np.eye(6)[0] + 0.02 * g.normal(size=6)).tolist(), 1) for i in range(300)]
    rows = loose + dense
    df = spark.createDataFrame(rows, VECS)
    reps = df.select(F.col("vec_id").alias("rid"), F.lit(1).cast("bigint").alias("copies"), F.col("label").cast("bigint").alias("label"),
                     F.lit(6).cast("bigint").alias("dim"), F.col("embedding").alias("vec"))
    cells, full = E._cells(reps, (2 - 2 * 0.98) ** 0.5, 50, 40)
    assert full == 0b111 and cells.where("rid < 1000").groupBy("grp").count().count() > 14
    assert cells.where("rid >= 1000").groupBy("grp").count().count() >= 6
    assert sorted(tuple(r) for r in E.near_duplicate_vectors(df, cell_rows=50, large_rows=40).collect()) == brute_force(rows)


def test_repeated_ids_and_empty(spark):
    v = [1.0, 0.0]
    rows = [(1, v, 0), (1, v, 0), (1, v, 1), (2, [1.0, 0.01], 0), (None, v, 0)]
    got = sorted((tuple(r) for r in E.near_duplicate_vectors(spark.createDataFrame(rows, VECS)).collect()), key=repr)
    assert sorted((r[0], r[1]) for r in got if r[0]) == [(1, 0), (1, 2), (1, 2), (2, 2)]
    assert [r[1:3] for r in got if r[0] is None] == [(2, 1)]
    assert E.near_duplicate_vectors(spark.createDataFrame([], VECS)).collect() == []
    text = spark.createDataFrame([(1, v, "a"), (2, v, "a"), (3, v, "b")], "vec_id bigint, embedding array<float>, label string")
    assert sorted(tuple(r)[:3] for r in E.near_duplicate_vectors(text).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_query_equals_its_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    df, rel = E.op3(spark, d), con.sql(E.OP3_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = (sorted(tuple(r) for r in x) for x in (df.select(*rel.columns).collect(), rel.fetchall()))
    assert got == want


def vectors_table(rows):
    return pa.table({"rid": pa.array([i for i, *_ in rows], pa.int64()), "copies": pa.array([c for _, _, c, _ in rows], pa.int64()),
                     "own": pa.array([o for _, _, _, o in rows], pa.int64()), "dim": pa.array([len(v) for _, v, _, _ in rows], pa.int64()),
                     "vec": pa.array([v for _, v, _, _ in rows], pa.list_(pa.float32()))})


@pytest.mark.parametrize("seed, dim, block, noise", [(0, 40, 16, 0.02), (1, 40, 8, 0.3), (2, 6, 16, 0.2), (3, 40, 1024, 0.02), (4, 20, 8, 0.0)])
def test_panel_meets_every_pair_once(seed, dim, block, noise):
    """A panel with pivots and short vectors of its own finds what all pairs in double precision do."""
    g = np.random.default_rng(seed)
    centres = g.normal(size=(15, dim))
    x = (centres[g.integers(15, size=700)] + noise * g.normal(size=(700, dim)) * g.random((700, 1))).astype(np.float32)
    rows = [(int(i), v.tolist(), int(c), int(o)) for i, v, c, o in zip(g.permutation(700), x, g.integers(1, 4, 700), g.choice([1, 2, 3], 700))]
    held, met = rows[:450], rows[450:]
    panel = E._Panel(vectors_table(held), 0.98, 3, block)
    out = [*panel.itself(), *panel.meet(vectors_table(met[:100])), *panel.meet(vectors_table(met[100:])), *panel.rows()]
    links, up = {}, {i: i for i, *_ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for b in out:
        for i, k, root in zip(*(c.to_pylist() for c in b.columns)):
            links[i] = links.get(i, 0) + k
            up[max(top(i), top(root))] = min(top(i), top(root))
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    own = np.array([o for *_, o in rows])
    near = (y @ y.T >= 0.98) & ((own[:, None] | own[None, :]) == 3)
    np.fill_diagonal(near, False)
    near[450:, 450:] = False
    want = near @ np.array([c for _, _, c, _ in rows])
    assert {i: n for (i, *_), n in zip(rows, want.tolist()) if n} == {i: n for i, n in links.items() if n}
    label = np.array([i for i, *_ in rows])
    while True:
        low = np.minimum(label, np.where(near, label[None, :], 10**9).min(axis=1))
        if (low == label).all():
            break
        label = low
    assert [top(i) for i, *_ in rows] == label.tolist()


def test_vectors_are_held_once_and_compared_in_rounds(spark, monkeypatch):
    """Cells list names of vectors; several panels, segments and rounds give the same result as all pairs."""
    written, table, drop = {}, E.table, E.drop
    gone = []

    def seen(df, name):
        frames = [df] if isinstance(df, DataFrame) else list(df)
        written.setdefault(name, []).append((frames[0].columns, len(frames)))
        return table(iter(frames), name)
    monkeypatch.setattr(E, "table", seen)
    monkeypatch.setattr(E, "drop", lambda df: (gone.append(1), drop(df)))
    monkeypatch.setattr(E, "PANEL", 10 * 8 * 4)
    monkeypatch.setattr(E, "SPAN", 2)
    monkeypatch.setattr(E, "ROUND", 1)
    rows = corpus(9, 240)
    got = sorted(tuple(r) for r in E.near_duplicate_vectors(spark.createDataFrame(rows, VECS), cell_rows=60, large_rows=100, block_rows=8).collect())
    assert got == brute_force(rows)
    assert written["vector-links"][0][1] > 5                                    # rounds
    assert all("vec" not in c for name in ("split-cells", "cells", "vectors") for c, _ in written[name])
    assert "vec" in written["dealt-vectors"][0][0] and len(gone) >= 2
