"""Projection, filter and inspection helpers: P2 typed missing columns, P5
null-subset filters, P8 value repair, P11 rejected-row inspection, O1-O5
sorts / samples / source-side fetch / positional lookup, A14 stage counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from noema.functions.text import truncate


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add every missing column of ``types`` as a typed null."""
    for c, t in types.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P5: drop rows null in any column of ``subset``."""
    return df.dropna(subset=list(subset))



def repair_values(df: DataFrame, mapping: dict[str, str], cols: Sequence[str]) -> DataFrame:
    """Whole-value replacement by a repair map."""
    return df.replace(mapping, subset=list(cols))


def rejected(df: DataFrame, ok: str, cols: Sequence[str], order: Sequence[str], n: int = 20,
             raw: str | None = None, width: int = 300) -> DataFrame:
    """The first ``n`` rows (by ``order``) whose ``ok`` flag is false,
    with the raw text truncated."""
    out = df.where(~F.coalesce(F.col(ok), F.lit(False)))
    sel = [F.col(c) for c in cols]
    if raw:
        sel.append(truncate(raw, width).alias(raw))
    return out.select(*sel, *[c for c in order if c not in cols]).orderBy(*order).limit(n)



def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """O2: sorted distinct values (binary UTF-8 order = code-point order)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """O3: reproducible head: ``orderBy(key).limit(n)`` (planned as a top-n)."""
    return df.orderBy(*order).limit(n)


def top_cited(papers: DataFrame, keyword_pattern: str, n: int, text_cols: Sequence[str] = ("title", "abstract")
              ) -> DataFrame:
    """Source-side ordered fetch — papers matching any keyword alternative,
    by citation count (desc, paper id as tie-break), first ``n``."""
    cond = F.lit(False)
    for c in text_cols:
        cond = cond | F.coalesce(F.col(c).rlike(keyword_pattern), F.lit(False))
    return papers.where(cond).orderBy(F.desc_nulls_last("citationCount"), "paperId").limit(n)


def at_position(df: DataFrame, i: int, pos: str = "pos") -> DataFrame:
    """Positional row lookup by the explicit order column."""
    return df.where(F.col(pos) == i)


def stage_counts(stage: str, df: DataFrame, **conditions: Column) -> DataFrame:
    """One metrics row per stage: row count and counts of named conditions."""
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.agg(*aggs).select(F.lit(stage).alias("stage"), "*")
