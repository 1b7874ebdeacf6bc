import hashlib
import random

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from noema.llm import decontaminate as D, textcore as T

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def brute_force(docs, items, window=10):
    wins = {}
    for name, text in items:
        if name is None:
            continue
        w = brute.words(text)
        m = min(window, len(w))
        for s in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + m]), set()).add(str(name))
    out = []
    for key, text in docs:
        w = brute.words(text)
        hit, names = set(), set()
        for m in {len(x) for x in wins}:
            for s in range(len(w) - m + 1):
                found = wins.get(tuple(w[s:s + m]))
                if found:
                    names |= found
                    hit |= set(range(s, s + m))
        out.append((key, len(w), len(hit), tuple(sorted(names))))
    return sorted(out, key=repr)


def run(df, items, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in D.find_matches(df, items, **kw).collect()),
                  key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("the of and rain stone Élan x1 sea".split()) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(12)] + [(99, ""), (98, None), (None, text(20)), (3, text(30))]
    docs = [(i, text(60)) for i in range(20)]
    for i, (_, t) in enumerate(items):
        w = (t or "").split()
        docs.append((100 + i, text(15) + " " + (t or "").upper() + "! " + text(5)))
        docs.append((200 + i, " ".join(w[:len(w) // 2] + ["zzz"] + w[len(w) // 2:])))
        docs.append((300 + i, " ".join(w[2:-2])))
    docs += [(400, None), (401, ""), (402, "... !"), (None, items[4][1]), (100, items[5][1]), (100, items[5][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    docs, items = corpus(seed)
    df = spark.createDataFrame(docs, DOCS).withColumn("key", F.lit("x")).withColumn("item", F.lit(1)).repartition(3)
    it = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(7))
    assert run(df, it) == brute_force(docs, items)
    assert run(df, it, window=4, near=0) == brute_force(docs, items, 4)


def test_spans_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "alpha x beta gamma")], DOCS)
    items = spark.createDataFrame([(7, "b c d"), (8, "alpha beta gamma")], ITEMS)
    got = {r.doc_id: r for r in D.find_matches(docs, items, window=3, near=2).collect()}
    assert [tuple(s) for s in got[1].spans] == [(1, 3)] and got[1]["items"] == ["7"]
    assert got[2]["items"] == [] and got[2].near_items == ["8"]


def test_empty_tables(spark):
    docs, items = corpus(3)
    none = spark.createDataFrame([], ITEMS)
    assert all(r[2] == 0 for r in run(spark.createDataFrame(docs, DOCS), none))
    assert run(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)) == []


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = D.op8(spark, d)
    rel = con.sql(D.OP8_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted(tuple(r) for r in df.select(*rel.columns).collect())
    assert got == sorted(rel.fetchall()) and any(r[rel.columns.index("contaminated")] for r in got)
    assert hashlib.sha256(b"").hexdigest() in {r[rel.columns.index("items_sha256")] for r in got}


def test_words_of_one_name_are_told_apart_by_their_letters(spark):
    """A Thue-Morse word of 1,024 letters and its complement have the same 64-bit name."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    ids = T.words(data, np.array([0, len(data)])).id
    assert ids[0] == ids[1]
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y"), (3, f"X {one.upper()}, y and x {two} y")], "doc_id bigint, text string")
    items = spark.createDataFrame([("i", f"x {two} y")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in D.find_matches(docs, items).collect()}
    assert got == {1: (0, []), 2: (3, ["i"]), 3: (3, ["i"])}
