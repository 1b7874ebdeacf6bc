"""S10 graph sink: versioned snapshots in key buckets, and G10 enforced at the write.

A table is a folder::

    data/version=N/bucket=B/part-*.parquet    the buckets that version N rewrote
    manifest/version=N/part-*.parquet         for each bucket of version N, the folder that holds it
    rejects/version=N/part-*.parquet          rows that ``insert_unique`` of version N turned away

An upsert reads and rewrites the buckets its keys fall into and leaves the others' files
alone.  The version becomes the current one when its manifest, a single file, is
moved into place; a failure before that leaves the snapshot as it was, and the next
write of the same version replaces what it left.  Older versions stay readable.  A table
has one writer at a time.

``buckets`` is fixed when the table is made; buckets of a few hundred MB keep a rewrite
cheap.  What reaches the driver is a row for each bucket.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from noema.operators.rows import last_per_key
from noema.session import path_exists

BUCKETS = 64
MANIFEST = "bucket int, path string, schema string, buckets int"


@dataclass(frozen=True)
class Version:
    """A committed version: its number, its number of buckets, bucket -> folder (relative), schema."""
    number: int
    buckets: int
    folders: dict[int, str]
    schema: StructType


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """Version ``number`` (default: the current one), or None if there is none."""
    path = f"{root}/manifest"
    if not path_exists(spark, path):
        return None
    manifest = spark.read.schema(f"{MANIFEST}, version bigint").parquet(path)
    number = number or manifest.agg(F.max("version")).first()[0]
    rows = manifest.where(F.col("version") == F.lit(number)).collect() if number else []
    if not rows:
        return None
    return Version(number, rows[0].buckets, {r.bucket: r.path for r in rows},
                   StructType.fromJson(json.loads(rows[0].schema)))


def _read(spark: SparkSession, root: str, v: Version, buckets: Sequence[int] | None = None) -> DataFrame:
    folders = [f"{root}/{p}" for b, p in sorted(v.folders.items()) if buckets is None or b in set(buckets)]
    return spark.read.schema(v.schema).parquet(*folders) if folders else spark.createDataFrame([], v.schema)


def read_snapshot(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of a version (default: the current one)."""
    v = version(spark, root, number)
    if v is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return _read(spark, root, v)


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _commit(spark: SparkSession, root: str, old: Version | None, staged: DataFrame, keys: Sequence[str], n: int) -> int:
    """Merge the staged rows (one for each key, with ``bucket``) into their buckets; the new version's number."""
    touched = [r.bucket for r in staged.select("bucket").distinct().collect()]
    if not touched:
        return old.number if old else 0
    rows = staged.withColumn("_gen", F.lit(1))
    if old:
        kept = _read(spark, root, old, touched).withColumn("bucket", _bucket(keys, n)).withColumn("_gen", F.lit(0))
        rows = kept.unionByName(rows, allowMissingColumns=True)
    # one task for each bucket, which writes one file; both sides have a key at most once
    out = last_per_key(rows.repartitionById(n, F.col("bucket")), ["bucket", *keys], ["_gen"]).drop("_gen")
    schema = StructType([f for f in out.schema.fields if f.name != "bucket"])
    number = (old.number if old else 0) + 1
    data = f"data/version={number}"
    out.select(*schema.names, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{data}")
    folders = {**(old.folders if old else {}), **{b: f"{data}/bucket={b}" for b in touched}}
    manifest = spark.createDataFrame([(b, p, json.dumps(schema.jsonValue()), n) for b, p in sorted(folders.items())], MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={number}")
    return number


def upsert_snapshot(root: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> int:
    """G1 / G2 as a write: rows replace all properties of the stored row with the same keys; among
    incoming rows the last in ``order`` wins.  Columns of ``order`` are not stored.  Returns the number
    of the version that is current afterwards (no incoming rows: unchanged)."""
    spark = incoming.sparkSession
    old = version(spark, root)
    n = old.buckets if old else buckets
    staged = last_per_key(incoming, list(keys), list(order)).drop(*[c for c in order if c not in keys])
    return _commit(spark, root, old, _staged(root, staged.withColumn("bucket", _bucket(keys, n)), old), keys, n)


def _staged(root: str, rows: DataFrame, old: Version | None) -> DataFrame:
    """Computed once: read for the touched buckets and again for the merge."""
    path = f"{root}/staged/version={(old.number if old else 0) + 1}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def insert_unique(root: str, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS
                  ) -> dict[str, int]:
    """G10 as a write: rows with new keys are stored; a row whose key is stored already, or comes
    earlier in ``order`` among the incoming rows, goes to the table of rejects with the reason
    ``stored`` or ``repeated``, as does one with a null in its keys (``null``).

    Returns the version and the numbers of rows ``accepted``, ``stored``, ``repeated`` and ``null``, which are
    counted while the rows are written.  ``order`` must be total and is not stored.
    """
    spark = incoming.sparkSession
    old = version(spark, root)
    n = old.buckets if old else buckets
    number = (old.number if old else 0) + 1
    rows = incoming.withColumn("_at", F.struct(*[F.col(c) for c in order]))
    complete = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    first = rows.where(complete).groupBy(*keys).agg(F.min("_at").alias("_first"))
    if old:
        stored = _read(spark, root, old).select(*keys).withColumn("_stored", F.lit(True))
        first = first.join(stored, list(keys), "left")
    else:
        first = first.withColumn("_stored", F.lit(None).cast("boolean"))
    reason = F.when(~F.expr(complete), "null").when(F.col("_stored"), "stored").when(F.col("_at") != F.col("_first"), "repeated")
    tagged = rows.join(first, list(keys), "left").withColumn("reason", F.coalesce(reason, F.lit("accepted")))
    seen = Observation()
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in ("accepted", "stored", "repeated", "null")]
    path = f"{root}/staged/version={number}"
    rest = [c for c in incoming.columns if c not in order or c in keys]
    out = tagged.withColumn("bucket", _bucket(keys, n)).select(*rest, "bucket", "reason").observe(seen, *counts)
    out.write.mode("overwrite").partitionBy("reason").parquet(path)
    staged = spark.read.schema(out.schema).parquet(path)
    rejected = staged.where("reason <> 'accepted'").drop("bucket")
    rejected.write.mode("overwrite").parquet(f"{root}/rejects/version={number}")
    got = dict(seen.get)
    return {"version": _commit(spark, root, old, staged.where("reason = 'accepted'").drop("reason"), keys, n), **got}


def read_rejects(spark: SparkSession, root: str, number: int) -> DataFrame:
    """What the write of version ``number`` turned away, with ``reason``."""
    return spark.read.parquet(f"{root}/rejects/version={number}")
