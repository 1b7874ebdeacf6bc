"""Sharding by a two-pass external shuffle.

The first pass scatters the rows uniformly into buckets of bounded size by seeded hashes;
the second shuffles each bucket by Fisher-Yates (Spark's ``shuffle`` of an array) and
writes it.  The shuffled buckets one after the other are a random order of all rows,
which equal cuts make into shards: their counts are at most one apart.

Built-in functions only.  The hash is of the id, the text and, where a row occurs more
than once, the number of the copy: such rows are counted first and then numbered in
blocks, so one that makes up a third of the table is scattered like any other.  What
a task collects are the names of one bucket's rows (two bigints each, of at most about
``bucket_rows`` rows), never texts.  Texts cross once; the buckets' rows meet their
places without another exchange, as both sides are dealt by the bucket's number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from noema.llm.store import partitions, release, schema, table
from noema.session import checkpoint_dir

SHARDS, SEED, BUCKET_BYTES, BUCKET_ROWS = 24, 20240, 64 << 20, 1 << 18
_BLOCK = 4096


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def _copies(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows whose key another row has, with ``copy`` 0, 1, ... within the key."""
    same = rows.join(shared, "key", "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    # the distinct rows of one 64-bit key: one, but for a collision of hashes
    earlier = Window.partitionBy("key").orderBy("id", "text").rowsBetween(Window.unboundedPreceding, -1)
    same = same.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = same.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {_BLOCK}L)")))
    blocks = blocks.repartition("key", "block")
    number = F.expr(f"sequence(block * {_BLOCK}L, least(n, (block + 1) * {_BLOCK}L) - 1)")
    return blocks.withColumn("i", F.explode(number)).select(*rows.columns, (F.col("first") + F.col("i")).alias("copy"))


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, path: str | None = None,
                        id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Write every row of ``docs`` to one of ``shards`` shards in random order and read them
    back: ``id_col``, ``text_col``, ``extra`` (a struct of the other columns, if there
    are any, so that their names cannot clash), ``slot`` (bigint, the place in the shard,
    gapless from 0) and ``shard`` (int, 0 to ``shards`` - 1).

    ``path`` (default: a new folder under ``spark.checkpoint.dir``) gets one folder a
    shard, whose Parquet files each hold a run of slots in order.  Shards differ by one
    row at most; the same rows, seed and number of buckets give the same order,
    however the input is partitioned.

    Null ids and texts are values like others.  Rows that are equal in all columns are
    as many rows, each with a place of its own.  An empty table gives no file and no row.
    Very long texts only make their bucket larger.  Column types must be groupable.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("extra")] if others else []))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "id", "text"))
    seen = Observation()
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(size_of(F.col("text"))).alias("bytes"))
    keys = keys.observe(seen, F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    shared = table(keys.where("n > 1").select("key"), "shared-keys")
    n_rows, n_bytes = (seen.get[k] or 0 for k in ("n", "bytes"))
    numbered = rows.withColumn("copy", F.lit(0).cast("bigint"))
    if shared.limit(1).count():
        numbered = numbered.join(shared, "key", "left_anti").unionByName(_copies(rows, shared))

    buckets = max(partitions(spark), -(-n_bytes // bucket_bytes), -(-n_rows // bucket_rows))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), "key", "copy"), F.lit(buckets)).cast("int")
    scattered = numbered.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket"))
    # a partition is a bucket, so the seed that Spark adds its number to is the bucket's own
    names = F.sort_array(F.collect_list(F.struct("key", "copy")))
    shuffled = scattered.groupBy("bucket").agg(names.alias("names"))
    shuffled = shuffled.select("bucket", F.posexplode(F.shuffle("names", seed)).alias("rank", "name"))
    ranks = table(shuffled.select("bucket", "rank", "name.key", "name.copy"), "bucket-ranks")

    counts = ranks.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    total = ranks.count()
    place = F.col("offset") + F.col("rank")
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    placed = ranks.join(offsets, "bucket").withColumn("place", place).withColumn("shard", shard)
    placed = placed.select("bucket", "key", "copy", (F.col("place") - first).alias("slot"), F.col("shard").cast("int"))
    # the names of a bucket fit a hash table: texts are not sorted for the join
    placed = placed.repartitionById(buckets, F.col("bucket")).hint("shuffle_hash")
    out = scattered.join(placed, ["bucket", "key", "copy"])
    names = {"id": id_col, "text": text_col}
    out = out.select(*[F.col(c).alias(names.get(c, c)) for c in rows.columns if c != "key"], "slot", "shard")
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/noema-llm/shards-{uuid.uuid4().hex}"
    release(spark)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def op11(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of ``documents`` in 24 shards, counts at most one apart."""
    out = shuffle_into_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", size_of(F.col("text")).alias("size"),
                      F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
