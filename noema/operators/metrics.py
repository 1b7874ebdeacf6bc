"""Counters gathered while a table is written, without another scan.

``DataFrame.observe`` computes them in the job that writes the rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters: ``n`` (rows) and one for each condition.  They can be read once an
    action on the returned DataFrame, or on one made from it, has ended."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen


def write_counted(tables: Mapping[str, DataFrame], root: str, conditions: Mapping[str, Mapping[str, Column]] | None = None
                  ) -> DataFrame:
    """Write every table to ``root/<name>``; ``(table, n)`` rows: the rows of each, and for a table with
    ``conditions`` a row for each of them."""
    spark, out = next(iter(tables.values())).sparkSession, []
    for name, df in tables.items():
        rows, seen = counted(df, **(conditions or {}).get(name, {}))
        rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
        got = seen.get
        out += [(name if k == "n" else k, v) for k, v in got.items()]
    return spark.createDataFrame(out, "table string, n bigint")
