"""Set operators: U3 / U4 intersections.  Unions (U1, U2), differences (U5) and distinct
rows (U6) are Spark's own ``unionByName``, anti joins and ``distinct``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noema.functions.text import strip



def intersect_names(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Stripped non-null values present on both sides (distinct)."""
    sa = a.where(F.col(col).isNotNull()).select(strip(F.col(col)).alias(col))
    sb = b.where(F.col(col).isNotNull()).select(strip(F.col(col)).alias(col))
    return sa.intersect(sb)


def intersect_pairs(a: DataFrame, b: DataFrame, c1: str, c2: str) -> DataFrame:
    """U4: (c1, c2) pairs present on both sides; rows with a null member are
    ignored (the reference's per-column dropna misaligns pairs; we drop rows)."""
    def side(d: DataFrame) -> DataFrame:
        d = d.where(F.col(c1).isNotNull() & F.col(c2).isNotNull())
        return d.select(strip(F.col(c1)).alias(c1),
                        (strip(F.col(c2)) if dict(d.dtypes)[c2] == "string" else F.col(c2)).alias(c2))
    return side(a).intersect(side(b))
