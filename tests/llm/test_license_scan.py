import math

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from noema.llm import license_scan as L

DOCS = "doc_id bigint, text string"


def brute_blocks(text, block=64):
    at = 0
    for line in (text or "").split("\n"):
        w = brute.words(line)
        k = 0
        while w:
            yield at + k, w[k:k + block]
            if k + block >= len(w):
                break
            k += block // 2
        at += len(w)


def brute_force(docs, threshold=L.THRESHOLD):
    out = []
    for key, text in docs:
        w = brute.words(text)
        found = []
        for p, label in L.PHRASES:
            q = p.split()
            found += [("phrase", label, s, s + len(q) - 1, 1.0) for s in range(len(w)) if w[s:s + len(q)] == q]
        for s, b in brute_blocks(text):
            for t, label in L.TEMPLATES:
                want = set(brute.words(t))
                c = len(want & set(b))
                if c >= math.ceil(threshold * len(want) - 1e-9):
                    found.append(("block", label, s, s + len(b) - 1, round(c / len(want), 9)))
        out.append((key, len(w), sorted(found)))
    return sorted(out, key=repr)


def corpus():
    docs = [t for t, _ in L.TEMPLATES] + [t.upper() + "." for t, _ in L.TEMPLATES]
    docs += ["x " * 40 + t + " y" * 70 for t, _ in L.TEMPLATES]
    docs += ["\n".join(["rain", t, "under the MIT license apache license, version 2", "the of"]) for t, _ in L.TEMPLATES]
    docs += [" ".join(t.split()[:-1]) for t, _ in L.TEMPLATES] + [" z ".join(t.split()) for t, _ in L.TEMPLATES]
    docs += [None, "", "...", "under the mit", "cc by nc cc by nc", "\n\n", "license " * 300, "cc\nby\nnc",
             "this work is licensed under the", "overé the MIT License"]
    return list(enumerate(docs)) + [(None, "CC BY-NC"), (3, docs[3]), (3, docs[3])]


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_same_as_brute_force(spark, threshold):
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS).withColumn("id", F.lit(1)).withColumn("found", F.lit(2)).repartition(2)
    got = sorted(((r.doc_id, r.n_words, sorted((*tuple(x)[:4], round(x[4], 9)) for x in r.found))
                  for r in L.scan_licenses(df, threshold=threshold).collect()), key=repr)
    assert got == brute_force(docs, threshold)


def brute_windows(text, threshold, block=64):
    """Windows of the whole document: those of its words in one line."""
    out = []
    for s, b in brute_blocks(" ".join(brute.words(text)), block):
        for t, label in L.TEMPLATES:
            want = set(brute.words(t))
            c = len(want & set(b))
            if c >= math.ceil(threshold * len(want) - 1e-9):
                out.append(("window", label, s, s + len(b) - 1, round(c / len(want), 9)))
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_windows_same_as_brute_force(spark, threshold):
    docs = corpus() + [(1000 + i, "\n".join(t.split())) for i, (t, _) in enumerate(L.TEMPLATES)]
    docs += [(2000 + i, "\n".join(["x"] * n + t.split() + ["y"] * 80)) for n in (40, 63, 64, 130)
             for i, (t, _) in enumerate(L.TEMPLATES)]
    got = sorted(((r.doc_id, sorted((*tuple(x)[:4], round(x[4], 9)) for x in r.windows))
                  for r in L.scan_licenses(spark.createDataFrame(docs, DOCS), threshold=threshold).collect()), key=repr)
    assert got == sorted(((k, brute_windows(t, threshold)) for k, t in docs), key=repr)


def test_wrapped_notices_are_found(spark, tmp_path):
    gpl = ("This program is free software: you can redistribute it and/or modify\n"
           "it under the terms of the GNU General Public License as published by\n")
    bsd = ("Redistribution and use in source and binary forms, with or without\n"
           "modification, are permitted provided that the following conditions\n")
    docs = [(1, gpl), (2, bsd), (3, "a b\n" * 50 + gpl.replace("\n", "\n * ") + "c d\n" * 50), (4, "rain\nand sun\n"),
            (5, "Redistribution and use in source\n" + "a\n" * 100 + "and binary forms, with or without modification\n")]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.labels, r.score) for r in L.op9(spark, str(tmp_path)).collect()}
    assert "gpl" in got[1][0].split(",") and "gpl" in got[3][0].split(",") and got[1][1] == got[3][1] == 1.0
    assert got[2] == ("bsd", 1.0) and got[4] == got[5] == ("", 0.0)


def test_empty_table_and_long_template(spark):
    assert L.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        L.scan_licenses(spark.createDataFrame([], DOCS), templates=[("a " * 33, "x")])


def test_whole_text_as_template(spark):
    text = "\n".join(f"w{i} v{i} u{i}" for i in range(60))
    docs = spark.createDataFrame([(1, "x\n" * 100 + text + "\ny" * 300), (2, text[:200])], DOCS)
    out = L.scan_licenses(docs, templates=[(text, "long")], block_words=360).collect()
    assert {r.doc_id: {x.label for x in r.windows} for r in out} == {1: {"long"}, 2: set()}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df, rel = L.op9(spark, d), con.sql(L.OP9_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, df.select(*rel.columns).collect()), key=repr) == sorted(map(key, rel.fetchall()), key=repr)
