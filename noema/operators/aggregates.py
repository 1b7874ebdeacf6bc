"""Aggregations: A1 grouped sorted-distinct list, A2-A5 KC finalisation,
A6 frequency table, A7 top values, A8 exact numeric summary, A10 merged
category sets, A11 run statistics, A14 stage counts, A15 column profile.

Every grouping is written so the map-side partial aggregate runs before the
shuffle (``groupBy`` on distinct pairs first, then a collect over the
already-deduplicated values), so a hot group never ships its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from noema.functions._col import col_of
from noema.functions.text import strip
from noema.operators.rows import with_global_index
from noema.session import checkpoint_dir


def grouped_sorted_distinct(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """A1: per key (null keys dropped) the sorted distinct list of stripped,
    non-null values; keys with no value get ``[]``."""
    rows = df.where(F.col(key).isNotNull()).select(key, strip(F.col(value)).alias("_v"))
    pairs = rows.distinct()                        # distinct pairs: partial agg per map task
    lists = pairs.groupBy(key).agg(
        F.array_sort(F.collect_list("_v")).alias(out))   # collect_list drops the null values
    return lists


def ordered_distinct_union(df: DataFrame, key: str, list_col: str, order: Sequence[Column],
                           out: str) -> DataFrame:
    """A5: ordered distinct union of list values per key (strip, non-empty, strings).

    Explode with the element position, keep each value's first (order, pos),
    then collect the survivors in that order.  The final collect per key holds
    distinct values only.
    """
    ordering = F.struct(*order)
    ex = df.select(key, ordering.alias("_o"), F.posexplode(list_col).alias("_i", "_a")) \
           .select(key, "_o", "_i", strip(F.col("_a")).alias("_a")) \
           .where(F.col("_a").isNotNull() & (F.col("_a") != ""))
    first = ex.groupBy(key, "_a").agg(F.min(F.struct("_o", "_i")).alias("_first"))
    return first.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_first", "_a"))), lambda z: z["_a"]).alias(out))


def best_link(link: Column, pos: Column) -> Column:
    """A3 (aggregate): non-blank links only; containing ``#`` first, then the
    longest, then the earliest ``pos``.  A null ordering is ignored by
    ``min_by``, so blank links never win."""
    nonblank = link.isNotNull() & (strip(link) != "")
    # smallest (no '#', -length, pos) = has '#', longest, earliest; pos may be any orderable type
    return F.min_by(link, F.when(nonblank, F.struct(~F.contains(link, F.lit("#")), -F.length(link), pos)))


def first_non_null(value: Column, pos: Column) -> Column:
    """A4 (aggregate): the value at the smallest ``pos`` among non-null values."""
    return F.min_by(value, F.when(value.isNotNull(), pos))


def finalize_kc_nodes(df: DataFrame, pos: str = "pos") -> DataFrame:
    """A2: one row per KC name with the best link (A3), first category (A4,
    discarded like the reference: ``categories`` stays null until the category
    lookup fills it) and the ordered alias union (A5) minus the name itself."""
    p = F.col(pos)
    base = df.groupBy("name").agg(
        best_link(F.col("link"), p).alias("link"),
        first_non_null(F.col("category"), p).alias("category"))
    aliases = ordered_distinct_union(df.where(F.col("name").isNotNull()), "name", "alias", [p], "alias")
    out = base.join(aliases, "name", "left").withColumn(
        "alias", F.array_remove(F.coalesce("alias", F.array().cast("array<string>")), F.col("name")))
    return out.select("name", "link", F.lit(None).cast("array<string>").alias("categories"), "alias",
                      "category")


def frequency(df: DataFrame, c: str) -> DataFrame:
    """Value counts including the null value."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, c: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent non-null values; ties by value."""
    return (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(c)).limit(n))


def describe(df: DataFrame, c: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample std, min, exact quantiles (linear interpolation), max of
    the values that are neither null nor NaN.

    Values are counted first (with map-side combine), so a value that a third of the rows
    share is one row; the distinct values are range-sorted, and a value's first rank is
    the sum of the counts before it: inside its partition by a window, plus the sums
    of the earlier partitions (a row per partition).
    """
    x = F.col(c).cast("double")
    vals = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    spark = df.sparkSession
    checkpoint_dir(spark)
    counts = vals.groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    parted = counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_x") \
                   .withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    sums = parted.groupBy("_p").agg(F.sum("_n").alias("_s"), F.sum(F.col("_n") * F.col("_x")).alias("_sx"))
    everything = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
                          F.sum("_s").over(everything).alias("_total"),
                          (F.sum("_sx").over(everything) / F.sum("_s").over(everything)).alias("_mean"))
    inside = Window.partitionBy("_p").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parted.withColumn("_lo", F.coalesce(F.sum("_n").over(inside), F.lit(0))) \
                   .join(F.broadcast(offsets), "_p").withColumn("_lo", F.col("_lo") + F.col("_off"))
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    at = [(names.get(q, f"p{int(q * 100)}"), (F.col("_total") - 1) * F.lit(float(q))) for q in quantiles]
    holds = lambda r: F.max(F.when((F.col("_lo") <= r) & (r < F.col("_lo") + F.col("_n")), F.col("_x")))
    off = F.col("_x") - F.col("_mean")
    out = ranked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("count"), F.max("_mean").alias("mean"),
        F.when(F.sum("_n") > 1, F.sqrt(F.sum(F.col("_n") * off * off) / (F.sum("_n") - 1))).alias("std"),
        F.min("_x").alias("min"), F.max("_x").alias("max"),
        *[holds(F.floor(h)).alias(f"_{n}_lo") for n, h in at], *[holds(F.ceil(h)).alias(f"_{n}_hi") for n, h in at],
        *[F.max(h - F.floor(h)).alias(f"_{n}_f") for n, h in at])
    lo, hi, part = (lambda n: F.col(f"_{n}_lo")), (lambda n: F.col(f"_{n}_hi")), (lambda n: F.col(f"_{n}_f"))
    values = [(lo(n) + (hi(n) - lo(n)) * part(n)).alias(n) for n, _ in at]
    return out.select("count", "mean", "std", "min", *values, "max")


def merged_category_sets(df: DataFrame, key: str, cats: str, out: str = "categories") -> DataFrame:
    """A10: union of category lists over response parts of one page, sorted."""
    ex = df.select(key, F.explode(cats).alias("_c")).distinct()
    return ex.groupBy(key).agg(F.array_sort(F.collect_list("_c")).alias(out))


def run_stats(df: DataFrame, ok: Column, size: Column) -> DataFrame:
    """Total, successes, failures, mean size per success (2 decimals)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(ok).alias("n_ok"),
        F.count_if(~ok).alias("n_failed"),
        F.round(F.sum(F.when(ok, size)) / F.count_if(ok), 2).alias("mean_per_ok"))


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null count per column next to the row count, one row per column
    (``stack`` unpivot of a single aggregate row)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _nn_{i}" for i, c in enumerate(cols))
    dtypes = dict(df.dtypes)
    prof = agg.selectExpr("_rows AS n_rows", f"stack({len(cols)}, {pairs}) AS (column_name, non_null)")
    types = df.sparkSession.createDataFrame([(c, dtypes[c]) for c in cols], "column_name string, dtype string")
    return prof.join(F.broadcast(types), "column_name")


def ranked_keys(df: DataFrame, key: str, out: str) -> DataFrame:
    """Dense 0-based ordinal of each distinct ``key`` value in sort order,
    computed with the distributed row index (no single-partition window)."""
    return with_global_index(df.select(key).distinct(), [key], out)
