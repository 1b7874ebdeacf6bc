import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from noema.llm import mixing as M

DOCS = "doc_id bigint, text string, source string"


def brute_force(docs, cap=3.0, weights=(1, 2, 3)):
    rows = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in docs]
    sources = sorted({s for _, s, _ in rows if s is not None}) + ([None] if any(s is None for _, s, _ in rows) else [])
    size = {s: sum(n for _, x, n in rows if x == s) for s in sources}
    w = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    total, target, open_ = float(sum(size.values())), {}, list(sources)
    while open_:
        left = total - sum(target.values())
        share = left / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * share > cap * size[s]]
        if not over:
            target.update({s: w[s] * share for s in open_})
            break
        target.update({s: cap * size[s] for s in over})
        open_ = [s for s in open_ if s not in over]
    out = []
    for s in sources:
        mine = sorted(((hashlib.md5(str(i).encode()).hexdigest() if i is not None else "", i, n) for i, x, n in rows if x == s),
                      key=lambda r: (r[1] is not None, r[0], r[1] or 0, r[2]))
        left = int(target.get(s, 0))
        taken = [0] * len(mine)
        while left > 0 and size[s]:
            for k, (_, _, n) in enumerate(mine):
                got = min(n, left)
                taken[k] += got
                left -= got
        out += [(i, n, size[s], round(target.get(s, 0.0), 6), t) for (_, i, n), t in zip(mine, taken)]
    return sorted(out, key=repr)


def run(df, **kw):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in M.mix(df, **kw).collect()), key=repr)


def corpus():
    docs = [(i, "w " * (i % 17), "hot" if i % 3 else f"s{i % 7}") for i in range(120)]
    docs += [(200, "one word\x0b two\x1cthree", "tiny"), (201, None, "none"), (202, "", "none"), (203, "a b c", None),
             (204, "x " * 4000, "s1"), (None, "n u l l", "s2"), (5, "w " * 5, "hot"), (5, "w " * 5, "hot"), (206, "é b", "Z")]
    return docs


@pytest.mark.parametrize("cap", [3.0, 1.5])
def test_same_as_brute_force(spark, cap):
    df = spark.createDataFrame(corpus(), DOCS).withColumn("size", F.lit("x")).withColumn("rank", F.lit(1)).repartition(5)
    assert run(df, cap=cap) == brute_force(corpus(), cap)


def test_budgets_are_met_and_reruns_agree(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    a, b = run(df.repartition(7)), run(df.coalesce(1))
    assert a == b
    out = M.mix(df).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(r.t == int(r.g) for r in out)


def test_empty(spark):
    assert run(spark.createDataFrame([], DOCS)) == []
    assert run(spark.createDataFrame([(1, "", "a"), (2, None, None)], DOCS)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df, rel = M.op4(spark, d), con.sql(M.OP4_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = (sorted(tuple(r) for r in x) for x in (df.select(*rel.columns).collect(), rel.fetchall()))
    assert got == want
