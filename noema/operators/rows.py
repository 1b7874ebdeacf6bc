"""Row-order operators: first / last per key (W2, A9), top-k per key (W1),
first occurrence (W3), global row index (W4, W5, O5), rows dealt over tasks.

pandas keeps rows in input order and the reference leans on it ("first wins",
"last wins", stable sorts).  Spark has no row order, so every operator here
takes an explicit ordering that must be total; ties are the caller's bug.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from noema.functions._col import col_of
from noema.session import checkpoint_dir

ColumnLike = str | Column


def _as_cols(xs: Sequence[ColumnLike] | ColumnLike) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [col_of(x) for x in xs]


def _pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], pick) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = [c.alias(f"_ord{i}") for i, c in enumerate(_as_cols(order))]
    # min / max of a struct compares the ordering fields first; the payload
    # only breaks exact ties, so even a non-total order gives one fixed answer
    packed = F.struct(*ordering, *[F.col(f"`{c}`") for c in rest])
    out = df.groupBy(*keys).agg(pick(packed).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """W2 / A9 first-wins: the row with the smallest ``order`` for each key.

    An aggregate (``min`` of an (order, row) struct) rather than
    ``row_number``: the partial aggregate runs before the shuffle, so a key
    holding a third of the rows still sends one row per map task.
    """
    return _pick_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """A9 / G1 last-wins: the row with the largest ``order`` for each key."""
    return _pick_per_key(df, keys, order, F.max)


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per key under ``order`` and number them 1..k.

    ``row_number() <= k`` plans as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after, so at most ``k`` rows per key leave each map
    task however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def with_global_index(df: DataFrame, order: Sequence[ColumnLike], name: str = "row_index",
                      partitions: int | None = None) -> DataFrame:
    """A dense 0-based row index under a total ``order``, computed
    without a single-partition window.

    Range-partition and sort, tag rows with ``monotonically_increasing_id``
    (partition index in the high bits, position inside the partition in the low
    33 bits), materialise once (reliable checkpoint), then add each partition's
    offset from a table with one row per partition (broadcast: its size is the
    partition count).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cols = _as_cols(order)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)) \
                   .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid") \
                .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local"))
    return out.drop("_mid", "_pid", "_local", "_off")


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """``df`` dealt over tasks of about ``rows_per_task`` rows, for steps that make much of a row: the tasks of
    a scan follow the size of the files, so a small file with many rows is one task.  Counts ``df`` first."""
    return df.repartition(max(1, math.ceil(df.count() / rows_per_task)))


def batch_number(df: DataFrame, order: Sequence[ColumnLike], size: int, name: str = "batch") -> DataFrame:
    """``floor(row_index / size)`` under a total order."""
    idx = with_global_index(df, order, "_row_index")
    return idx.withColumn(name, F.floor(F.col("_row_index") / F.lit(size))).drop("_row_index")
