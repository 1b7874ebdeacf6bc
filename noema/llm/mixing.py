"""Mixing sources to target weights.

Every source gets a budget of words.  Its documents are put in a random but
reproducible order (the MD5 of the id), range-sorted by (source, key), and given
the prefix sum of their sizes within the source.  The source is read from the
start of that order, again and again if the budget is larger than the source, and
cut at the exact budget: the document in which it ends is taken in part.

Scale: the range sort splits a source that holds any share of the rows; prefix
sums are partition-local sums plus the offsets of the partitions before (one row
for each partition and source), so no task or window sees a whole source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from noema.llm.store import columns, partitions, table

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text):
    """Words of a text: runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def budgets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, weight) -> with ``target``: the sum of all sizes shared by
    weight, at most ``cap`` times a source's size, the excess reshared by weight
    among the others until none is above.

    Each round is one aggregate over the sources, of which the driver gets two sums.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    limit = F.col("source_size") * F.lit(float(cap))
    while True:
        # sources at their cap under the present share leave the sharing for good
        at_cap = F.col("weight") * F.lit(share) > limit
        got = sizes.agg(F.sum(F.when(at_cap, limit)).alias("held"),
                        F.sum(F.when(~at_cap, F.col("weight"))).alias("weight")).first()
        if not got.weight:
            break
        new = (total - (got.held or 0.0)) / got.weight
        if new <= share:
            break
        share = new
    return sizes.withColumn("target", F.least(limit, F.col("weight") * F.lit(share)))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the sizes before each row within its source and this partition; rows
    come sorted by source, so one carried sum is enough."""
    last, carry = object(), 0
    for b in batches:
        if not b.num_rows:
            continue
        source = b.column("sid").to_numpy(zero_copy_only=False)
        size = b.column("size").to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        new = np.ones(len(source), bool)
        new[1:] = source[1:] != source[:-1]
        new[0] = source[0] != last
        heads = np.flatnonzero(new)
        base = np.full(len(source), -carry, np.int64)
        if len(heads):
            of = np.searchsorted(heads, np.arange(len(source)), "right") - 1
            start = (ends - size)[heads]
            base = np.where(of >= 0, start[np.maximum(of, 0)], -carry)
        before = ends - size - base
        last, carry = source[-1], int(before[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before)], [*b.schema.names, "before"])


def mix(docs: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target and taken
    (words that the mix takes of the document, repeats counted).

    Sources by code point, null (a source of its own) last, weigh ``weights``,
    repeating.  Null texts have size 0.  Ties in the random key (repeated ids) are
    settled by id and size; rows equal in all three are interchangeable.  The
    words that a source's documents give add up to its target, rounded down.
    Sources without words get nothing.  An empty table gives an empty result.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    sized = columns(docs, id=id_col, source=source_col, text=text_col).select(
        "id", "source", size_of(F.col("text")).alias("size"))
    sized = table(sized, "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row for each source: its place in the order of sources
    sid = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    ranked = sources.withColumn("sid", sid)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                      (F.col("sid") % len(weights) + 1).cast("int")))
    plan = table(budgets(table(ranked, "sources"), cap), "budgets")
    keyed = sized.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "source", "size", "source_size", "target", "sid", F.md5(F.col("id").cast("string")).alias("rank"))
    order = ["sid", "rank", "id", "size"]
    kinds = ", ".join(f"{c} {t}" for c, t in keyed.dtypes)
    local = table(keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                  .mapInArrow(_running, f"{kinds}, before bigint").withColumn("part", F.spark_partition_id()), "mix")
    parts = local.groupBy("sid", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("sid", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("before")
    taken = epochs * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return local.join(offsets, ["sid", "part"]).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        taken.cast("bigint").alias("taken"))


def op4(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of ``documents``, weights 1, 2, 3, cap 3."""
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


#: The same mix in DuckDB SQL; the resharing rounds are a recursive query.
OP4_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS MATERIALIZED (
  SELECT source, source_size, sid, CASE sid % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS weight
  FROM (SELECT source, source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS sid
        FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source))),
r(round, share) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT round + 1, new FROM (
    SELECT r.round, r.share, ((SELECT sum(source_size) FROM s)::DOUBLE
             - (SELECT coalesce(sum(CASE WHEN weight * r.share > 3.0::DOUBLE * source_size THEN 3.0::DOUBLE * source_size END), 0.0) FROM s))
           / (SELECT sum(CASE WHEN weight * r.share > 3.0::DOUBLE * source_size THEN NULL ELSE weight END) FROM s)::DOUBLE AS new
    FROM r) WHERE new > share),
t AS MATERIALIZED (SELECT source, source_size, sid, least(3.0::DOUBLE * source_size, weight * (SELECT max(share) FROM r)) AS target FROM s),
j AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
             coalesce(sum(size) OVER (PARTITION BY sid ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size * size
                 + least(greatest(budget % source_size - before, 0), size) ELSE 0 END AS BIGINT) AS taken
FROM j
"""
