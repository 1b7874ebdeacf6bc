import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from noema.llm import sharding as S

DOCS = "doc_id bigint, text string, slot string, `Shard` int"


def corpus():
    docs = [(i, f"text {i}" * (i % 5), "x", i) for i in range(90)]
    docs += [(7, "same", None, 1)] * 60 + [(7, "same", None, 2)] * 3 + [(None, None, None, None)] * 5
    return docs + [(900, "", "y", 1), (901, "long é " * 50_000, "z", 2), (None, "n", "", 0)]


def shards_of(df, **kw):
    out = S.shuffle_into_shards(df, **kw)
    return [(r.doc_id, r.text, r.extra.slot, r.extra.Shard, r.shard, r.slot) for r in out.collect()]


def check(got, docs, shards):
    assert Counter(r[:4] for r in got) == Counter(docs)                       # each row once
    counts = Counter(r[4] for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    assert sorted((r[4], r[5]) for r in got) == [(s, k) for s in range(shards) for k in range(counts[s])]


@pytest.mark.parametrize("shards", [1, 24])
def test_every_row_once_in_gapless_even_shards(spark, shards):
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS)
    got = shards_of(df.repartition(5), shards=shards, bucket_bytes=40_000)
    check(got, docs, shards)
    assert sorted(got, key=repr) == sorted(shards_of(df.coalesce(1), shards=shards, bucket_bytes=40_000), key=repr)
    assert sorted(got, key=repr) != sorted(shards_of(df, shards=shards, bucket_bytes=40_000, seed=5), key=repr)


def test_hot_repeated_row_is_scattered(spark):
    docs = [(i, str(i), "", 0) for i in range(2000)] + [(1, "copy", "", 0)] * 9000
    got = shards_of(spark.createDataFrame(docs, DOCS).repartition(4), bucket_rows=500)
    check(got, docs, 24)
    per = Counter(r[4] for r in got if r[1] == "copy")
    assert max(per.values()) < 1.2 * 9000 / 24


def test_equal_keys_of_different_rows(spark):
    """Rows that share a hash stay apart; here they share id and text and differ beside."""
    rows = spark.createDataFrame([(1, "t", "a", 5), (1, "t", "b", 5), (1, "t", "b", 5)], DOCS).select(
        F.col("doc_id").alias("id"), "text", F.struct("slot").alias("extra"), F.lit(5).cast("bigint").alias("key"))
    got = S._copies(rows, spark.createDataFrame([(5,)], "key bigint")).collect()
    assert sorted(r.copy for r in got) == [0, 1, 2]
    assert Counter(r.extra.slot for r in got) == {"a": 1, "b": 2}


def test_buckets_follow_the_seeded_hash(spark):
    """One bucket a row at most on average: shards in bucket order follow xxHash64 as another library has it."""
    def name(i, text):
        h = 42
        for part in ((S.SEED).to_bytes(4, "little"), i.to_bytes(8, "little"), text.encode()):
            h = xxhash.xxh64_intdigest(part, h)
        return h - (h >> 63 << 64)

    docs = [(i, f"t{i}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    h = df.select("doc_id", F.xxhash64(F.lit(S.SEED), "doc_id", "text").alias("h")).collect()
    assert {r.doc_id: r.h for r in h} == {i: name(i, t) for i, t in docs}
    n = len(docs)

    def bucket(i, text):
        b = xxhash.xxh64_intdigest((S.SEED + 1).to_bytes(4, "little"), 42)
        b = xxhash.xxh64_intdigest((name(i, text) & (2**64 - 1)).to_bytes(8, "little"), b)
        b = xxhash.xxh64_intdigest((0).to_bytes(8, "little"), b)
        return (b - (b >> 63 << 64)) % n

    out = S.shuffle_into_shards(df, shards=1, bucket_rows=1)
    order = [bucket(r.doc_id, r.text) for r in out.orderBy("slot").collect()]
    assert order == sorted(order)


def test_orders_of_a_bucket_are_equally_likely(spark):
    df = spark.createDataFrame([(i, "abc"[i]) for i in range(3)], "doc_id bigint, text string")
    one = df.select(F.sort_array(F.collect_list("text")).alias("l"))
    rows = one.select(*[F.concat_ws("", F.shuffle("l", s)).alias(f"s{s}") for s in range(600)]).first()
    seen = Counter(rows)
    assert len(seen) == 6 and all(60 <= v <= 140 for v in seen.values())


def test_files_hold_runs_of_slots_in_order(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(400)], "doc_id bigint, text string")
    S.shuffle_into_shards(df, shards=4, path=str(tmp_path / "out"), bucket_rows=50)
    for s in range(4):
        runs = [pq.ParquetFile(p).read(["slot"])["slot"].to_pylist() for p in (tmp_path / "out" / f"shard={s}").glob("*.parquet")]
        assert all(r == list(range(r[0], r[0] + len(r))) for r in runs)
        assert sorted(x for r in runs for x in r) == list(range(100))


def test_empty(spark):
    out = S.shuffle_into_shards(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and out.columns == ["doc_id", "text", "extra", "slot", "shard"]
    with pytest.raises(ValueError):
        S.shuffle_into_shards(spark.createDataFrame([], DOCS), shards=0)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = S.op11(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(24) for k in range(counts[s])]
