import random

import brute
import pytest
from pyspark.sql import functions as F

from noema.llm import suffix_dedup as S


def rows(df):
    return [tuple(r) for r in df.collect()]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "rain", "élan", "ocean", "über", "stone"]) + str(rng.randint(0, 60))
                    for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    shared, line = prose(rng, 40), prose(rng, 9)
    base = prose(rng, 80)
    docs = [base, base, base[:200] + "X" + base[201:], "a" * 450, "", None, "short", "b" + "a" * 200,
            shared, "pre " + shared + " post", prose(rng, 30) + line + prose(rng, 30), line + prose(rng, 50),
            "ab" * 300, base[50:260], prose(rng, 10) + base[90:195], "é" * 120, "x" + "é" * 90]
    docs += [prose(rng, 15) + line + prose(rng, 15) for _ in range(12)]
    docs += [shared[:rng.randint(100, 200)] + prose(rng, 12) + shared[rng.randint(0, 60):] for _ in range(8)]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, bucket_rows", [(1, 2000), (2, 2000), (3, 2)])
def test_same_as_brute_force(spark, seed, bucket_rows):
    docs = corpus(seed)
    want = brute.substring_dedup(docs)
    got = {r[0]: (r[1], r[2], r[3], bytes(r[4]))
           for r in rows(S.dedup_substrings(frame(spark, docs), bucket_rows=bucket_rows))}
    assert got == want


def test_other_length_and_extra_columns(spark):
    docs = corpus(4)
    df = frame(spark, docs).withColumn("rid", F.lit(1)).withColumn("gram", F.lit("x")).withColumn("kept", F.lit(0))
    got = {r[0]: bytes(r[4]) for r in rows(S.dedup_substrings(df, length=40))}
    assert got == {k: v[3] for k, v in brute.substring_dedup(docs, 40).items()}


def test_repeated_and_null_ids(spark):
    docs = corpus(5)[:12]
    data = [(None if i % 5 == 0 else i // 2, t) for i, t in docs] + [(1, docs[3][1]), (1, docs[3][1])]
    df = frame(spark, data)
    order = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct() \
        .withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").isNull(), "doc_id", "h").collect()
    want = brute.substring_dedup([((r.doc_id, r.text), r.text) for r in order])
    got = rows(S.dedup_substrings(df))
    assert len(got) == len(data)
    expected = sorted((repr(i), want[(i, t or "")][3]) for i, t in data)
    assert sorted((repr(r[0]), bytes(r[4])) for r in got) == expected


def test_empty_table_and_text_ids(spark):
    assert rows(S.dedup_substrings(frame(spark, []))) == []
    df = spark.createDataFrame([("b", "z" * 150), ("a", "z" * 150)], "doc_id string, text string")
    got = {r[0]: r[2] for r in rows(S.dedup_substrings(df))}
    assert got == {"a": 149, "b": 150}  # in "a" each later start repeats the first


def test_query_columns(spark):
    df = S.op10(spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint",
                               "n_spans": "bigint", "kept_sha256": "string"}
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .orderBy("doc_id").select("doc_id", "text").collect()]
    want = {k: (*v[:3], brute.sha(v[3])) for k, v in brute.substring_dedup(docs).items()}
    assert {r[0]: tuple(r[1:]) for r in rows(df)} == want
