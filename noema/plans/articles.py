"""Ranked prerequisites per encyclopedia article (L9) with run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noema.operators import aggregates as A, enrich as E


def article_flow(articles: DataFrame, generator: E.Generator | None = None,
                 responses: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Returns (results, flattened rows, run statistics, top-10 prerequisite topics)."""
    results, flat = E.article_prerequisites(articles, generator, responses)
    sizes = flat.groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
    r = results.join(sizes, "pos", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    stats = A.run_stats(r, F.col("ok"), F.col("n").cast("double"))                     # A11
    top = A.top_values(flat, "prerequisite_topic", 10)                                  # A7
    return results, flat, stats, top


def write_article_outputs(results: DataFrame, flat: DataFrame, root: str) -> None:
    """S8 + S7: full results as JSON lines, flattened rows as CSV."""
    from noema.sources.files import write_csv, write_json_lines
    base = root.rstrip("/")
    write_json_lines(results.select("original_title", "result", "raw_output"), f"{base}/results")
    write_csv(flat.select("title", "rank", "prerequisite_topic", "rationale"), f"{base}/flattened")
