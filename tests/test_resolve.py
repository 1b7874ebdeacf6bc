import random

from pyspark.sql import functions as F

from noema.operators.resolve import resolve
from sequential_fold import fold

EX_SCHEMA = "ord long, name string, alias array<string>, link string, categories array<string>"
IN_SCHEMA = "pos long, name string, alias array<string>, link string, categories array<string>"


def run(spark, existing, incoming, bucket=4):
    ex = spark.createDataFrame([(i, e["name"], e["alias"], e["link"], e["categories"])
                                for i, e in enumerate(existing)], EX_SCHEMA)
    inc = spark.createDataFrame([(r["pos"], r["name"], r["alias"], r["link"], r["categories"])
                                 for r in incoming], IN_SCHEMA)
    actions, nodes = resolve(ex, inc, bucket=bucket)
    acts = {r["pos"]: (r["action"], r["node_name"]) for r in actions.collect()}
    nd = {r["node_name"]: (list(r["alias"]), r["link"], list(r["categories"]), r["n_merged"])
          for r in nodes.collect()}
    return acts, nd


def expected(existing, incoming):
    acts, nodes = fold(existing, incoming)
    return acts, {n["name"]: (n["alias"] or [], n["link"], n["categories"] or [], n["n_merged"]) for n in nodes}


def test_fixture_case(spark):
    # FIXTURES G4: existing Machine Learning; rows ml / Deep Net / dnn
    existing = [dict(name="Machine Learning", alias=["ML"], link=None, categories=["AI"])]
    incoming = [dict(pos=0, name="ml", alias=["machine-learning", "ML"], link="L1", categories=["AI", "CS"]),
                dict(pos=1, name="Deep Net", alias=["DNN"], link="L2", categories=[]),
                dict(pos=2, name="dnn", alias=["Machine-Learning"], link=None, categories=[])]
    acts, nodes = run(spark, existing, incoming)
    assert [acts[i][0] for i in range(3)] == ["merged", "created", "merged"]
    assert nodes["Machine Learning"][0] == ["ML", "ml", "machine-learning", "dnn", "Machine-Learning"]
    assert nodes["Machine Learning"][1] == "L1"
    assert nodes["Machine Learning"][2] == ["AI", "CS"]
    assert nodes["Deep Net"][0] == ["DNN"]
    assert (acts, nodes) == expected(existing, incoming)


def test_chain_needs_several_rounds(spark):
    # each row only meets the previous one: labels must travel the whole chain
    existing = [dict(name="t0", alias=[], link="", categories=[])]
    incoming = [dict(pos=i, name=f"t{i}", alias=[f"t{i + 1}"], link=None, categories=[]) for i in range(12)]
    incoming = [dict(pos=i, name=f"t{i + 1}", alias=[f"T{i}"], link=None if i % 2 else "", categories=["c"])
                for i in range(12)]
    assert run(spark, existing, incoming, bucket=3) == expected(existing, incoming)


def test_random_against_sequential_fold(spark):
    rng = random.Random(7)
    vocab = ["a", "b", "c", "d", "e", "f", " A ", "B", "g", "h"]
    for trial in range(8):
        existing = [dict(name=rng.choice(vocab).strip() + str(i % 3), alias=[rng.choice(vocab)],
                         link=rng.choice([None, "", "x"]), categories=[rng.choice("pq")])
                    for i in range(rng.randint(0, 3))]
        # distinct existing names (uniqueness constraint)
        seen, ex = set(), []
        for e in existing:
            if e["name"] not in seen:
                seen.add(e["name"])
                ex.append(e)
        incoming = []
        for p in rng.sample(range(100), 25):
            # names unpadded: a padded name equal to an existing node name would
            # break the reference's uniqueness constraint (its write fails)
            incoming.append(dict(pos=p, name=rng.choice(vocab).strip() + rng.choice(["", "1", "2"]),
                                 alias=[rng.choice(vocab) for _ in range(rng.randint(0, 2))],
                                 link=rng.choice([None, "", f"L{p}"]),
                                 categories=[rng.choice("pqr") for _ in range(rng.randint(0, 2))]))
        assert run(spark, ex, incoming, bucket=rng.choice([2, 8, 64])) == expected(ex, incoming), trial


def test_catalog_mapping_matches_fold(spark):
    from noema.plans.catalog import _resolve_inputs
    existing, incoming = _resolve_inputs(spark, "/root/testdata/sf0.001")
    ex = [r.asDict() for r in existing.orderBy("ord").collect()]
    inc = [r.asDict() for r in incoming.collect()]
    actions, nodes = resolve(existing, incoming)
    got = {r["pos"]: (r["action"], r["node_name"]) for r in actions.collect()}
    want, _ = fold(ex, inc)
    assert got == want
    assert nodes.groupBy("node_name").count().where(F.col("count") > 1).count() == 0


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    """Row k matches row k - 1 only; each chain ends in its first row."""
    from pyspark.sql import functions as F
    from noema.operators import resolve as V
    rounds = []
    once = V._propagate_once
    monkeypatch.setattr(V, "_propagate_once", lambda *a: rounds.append(1) or once(*a))
    existing = spark.createDataFrame([], "ord long, name string, alias array<string>")
    taken = {}
    for n in (16, 1000):
        rows = spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit("n"), "id").alias("name"),
                                     F.array(F.concat(F.lit("n"), (F.col("id") - 1).cast("string"))).alias("alias"))
        rounds.clear()
        labels = {r["pos"]: r["label"] for r in V.resolve_labels(existing, rows).collect()}
        taken[n] = len(rounds)
        assert set(labels.values()) == {V.CREATED}
    assert taken[1000] <= taken[16] + 7


def test_a_third_of_the_rows_in_one_node(spark):
    """A hot term and a hot node, repeated items in a row, a null among a node's own items."""
    rng = random.Random(11)
    existing = [dict(name="hot", alias=["h"], link="", categories=["c0"]), dict(name="void", alias=["v", None], link="x", categories=[None])]
    incoming = []
    for p in range(150):
        kind = p % 3
        name = rng.choice(["hot", "Hot", "h"]) if kind == 0 else f"n{rng.randrange(40)}" if kind == 1 else rng.choice(["void", "V", f"m{p}"])
        alias = [rng.choice(["h", "x1", "x2", f"x{rng.randrange(9)}"])] * rng.randint(1, 2) if kind == 0 else [f"a{p}", f"a{p}"]
        incoming.append(dict(pos=p, name=name, alias=alias, link=rng.choice([None, "", f"L{p}"]), categories=[rng.choice("pqr")] * rng.randint(0, 2)))
    assert run(spark, existing, incoming, bucket=16) == expected(existing, incoming)


def test_spread_join_meets_a_frequent_key_once_a_bucket(spark):
    from noema.operators import resolve as V
    rows = spark.range(1000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("term"))
    keys = spark.createDataFrame([("hot", 1), ("t4", 2)], "term string, ord int")
    got = V._join_spread(rows, keys, "term", 100)
    assert sorted((r.pos, r.ord) for r in got.collect()) == sorted([(i, 1) for i in range(0, 1000, 3)] + [(4, 2)])
    assert V._join_spread(rows, keys, "term", 100, "left_semi").count() == 335 and V._join_spread(rows, keys, "term", 100, "left").count() == 1000
    # the key's own join has a row for each of its buckets, not for each row
    pairs = rows.withColumn("_b", F.floor(F.col("pos") / 100)).select("term", "_b").distinct().join(keys, "term")
    assert pairs.where("term = 'hot'").count() == 10


def test_settled_rows_are_no_targets_of_later_rounds(spark, monkeypatch):
    """All rows share terms and end in the first node; once there, nothing can lower their labels."""
    from noema.operators import resolve as V
    targets, once = [], V._propagate_once
    monkeypatch.setattr(V, "_propagate_once", lambda src, tgt, bucket: targets.append(tgt.count()) or once(src, tgt, bucket))
    existing = spark.createDataFrame([(0, "t0", [])], "ord long, name string, alias array<string>")
    i = F.col("id")
    rows = spark.range(60).select(i.alias("pos"), F.when(i % 2 == 0, "t0").otherwise("hot").alias("name"),
                                  F.array(F.when(i % 2 == 0, "hot").otherwise("warm")).alias("alias"))
    assert {r["label"] for r in V.resolve_labels(existing, rows, 16).collect()} == {0}
    assert targets == [60, 0]
