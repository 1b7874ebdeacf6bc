"""Intermediate tables, and small column helpers of the operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType

from noema.operators.rows import with_global_index
from noema.session import checkpoint_dir


def table(df: DataFrame | Iterable[DataFrame], name: str) -> DataFrame:
    """Write ``df`` to the folder that all executors share (the one of
    ``spark.checkpoint.dir``) and read it back.

    Cuts the lineage: what follows survives lost executors without redoing
    what came before, and one computation serves several readers.  Several frames
    of one schema are written in turn, to one table: what one has shuffled can go
    while the next is under way.
    """
    path = None
    for one in [df] if isinstance(df, DataFrame) else df:
        spark, kind = one.sparkSession, one.schema
        release(spark)
        path = path or f"{checkpoint_dir(spark).rstrip('/')}/noema-llm/{name}-{uuid.uuid4().hex}"
        one.write.mode("append").option("compression", "zstd").parquet(path)
    out = spark.read.schema(kind).parquet(path)
    out._written_to = path
    return out


def drop(written: DataFrame) -> None:
    """Remove the files of a ``table`` that nothing reads any more."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written._written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps.  Its cleaner follows the
    driver's garbage collection, which a driver with little to do seldom runs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def schema(ddl: str, **fields: DataType) -> StructType:
    """A schema from DDL text and fields of given types (whose names may be odd)."""
    out = StructType.fromDDL(ddl)
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


def held_out(doc_id: str | Column) -> Column:
    """True where crc32 of the id's text leaves remainder 2 modulo 4 (null id: false)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def columns(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under internal names: others may not clash."""
    return df.select(*[F.col(f"`{v}`").alias(k) for k, v in names.items()])


def with_row_order(docs: DataFrame, payload: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """``docs`` (id, payload) with ``rid``, a bigint that orders documents.

    Distinct non-null bigint ids are their own order.  Otherwise each distinct
    (id, payload hash) gets its index in the order of id (null last) and hash; the
    second result then maps rid to (id, hash of the payload).
    """
    kind = dict(docs.dtypes)["id"]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        odd = docs.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull())
        if odd.limit(1).count() == 0:
            return docs.select(F.col("id").cast("bigint").alias("rid"), payload), None
    keyed = docs.withColumn("key", F.xxhash64(payload)).withColumn("void", F.col("id").isNull())
    index = table(with_global_index(keyed.select("void", "id", "key").distinct(), ["void", "id", "key"], "rid"),
                  "row-order")
    on = keyed["id"].eqNullSafe(index["id"]) & (keyed["key"] == index["key"])
    rows = keyed.join(index, on).groupBy(index["rid"]).agg(F.any_value(keyed[payload]).alias(payload))
    return table(rows, "ordered-docs"), index.select("rid", "id", "key")
