"""File sources (S1-S6) and sinks.

Row order matters to the reference ("first wins" / "last wins"), so every
reader adds ``pos``: file path, then the start of the block that a task read of the
file, then the row's place in the block.  A block is read by one task, in order, and
``monotonically_increasing_id`` grows within the task; how blocks are dealt to
tasks doesn't matter.

JSON readers keep what they cannot read: broken records, and rows that lack a required
field, come back as rejects with their text and a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from noema import schemas
from noema.functions import text as X
from noema.operators.rows import with_global_index

# The text pandas' CSV reader turns into a missing value by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


def _place() -> list[Column]:
    """Columns that order the rows of a file scan as the input has them."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid")]


def with_input_order(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Dense 0-based ``pos`` in input order; ``df`` is a file scan, with nothing but
    projections above it."""
    return with_global_index(df.select("*", *_place()), ["_file", "_block", "_mid"], pos).drop("_file", "_block", "_mid")


def _read_json(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str], multi_line: bool = False
               ) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON documents: rejects have ``file``, ``record`` (the text as it is; for a row that lacks a
    required field its JSON) and ``reason``.  A JSON null or an empty line is no row and no reject."""
    names = [f.name for f in schema.fields]
    raw = spark.read.schema(T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").option("multiLine", multi_line).json(path)
    lacks = F.lit(False)
    for field in required:
        lacks = lacks | F.col(field).isNull()
    reason = F.when(F.trim("_broken") != "null", "broken").when(F.col("_broken").isNull() & lacks, f"no {' or '.join(required)}")
    rejects = raw.select(F.col("_metadata.file_path").alias("file"),
                         F.coalesce("_broken", F.to_json(F.struct(*names))).alias("record"), reason.alias("reason"))
    return raw.where(F.col("_broken").isNull() & ~lacks).drop("_broken"), rejects.where("reason IS NOT NULL")


def na_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pandas default missing-value tokens become null (string columns)."""
    types = dict(df.dtypes)
    cols = cols or [c for c, t in types.items() if t == "string"]
    return df.select(*[F.when(~F.col(c).isin(PANDAS_NA_TOKENS), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def strip_header(df: DataFrame) -> DataFrame:
    """Strip whitespace around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: str | None = None, order: bool = True) -> DataFrame:
    """S1 + S2: header CSV with quoted multi-line fields; NA tokens → null.

    With a schema the header names are replaced by the schema names (after the
    header is stripped they must agree); without one, every column is a string.
    """
    reader = spark.read.option("header", True).option("multiLine", True) \
        .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
    raw = strip_header(reader.csv(path))          # all strings
    raw = na_to_null(raw)
    if schema is not None:
        fields = [f.strip().split(" ", 1) for f in schema.split(",")]
        raw = raw.select(*[F.col(f"`{n}`").cast(t.strip()).alias(n) for n, t in fields])
    return with_input_order(raw) if order else raw


def read_seed_papers(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``{total, token, data: [paper]}`` document(s) → one row per paper with ``pos``."""
    return seed_papers(spark, path)[0]


def seed_papers(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3 with rejects: (papers with ``pos``, broken documents and documents without ``data``)."""
    docs, rejects = _read_json(spark, path, schemas.SEED_DOCUMENT, ["data"], multi_line=True)
    papers = docs.select("data", *_place()).select("_file", "_block", "_mid", F.posexplode("data").alias("_i", "p")) \
        .select(F.struct("_file", "_block", "_mid", "_i").alias("_o"), "p.*")
    return with_global_index(papers, ["_o"], "pos").drop("_o"), rejects


def read_reference_responses(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``(seed_paper_id, data[])`` → one row per saved reference with
    its position in the response."""
    r = spark.read.schema(schemas.REFERENCE_RESPONSE).json(path)
    return r.select("seed_paper_id", F.posexplode("data").alias("ref_pos", "e")) \
            .select("seed_paper_id", "ref_pos", F.col("e.citedPaper.paperId").alias("ref_paper_id"),
                    F.col("e.isInfluential").alias("isInfluential"), F.col("e.intents").alias("intents"),
                    F.col("e.contexts").alias("contexts"))


def read_paper_details(spark: SparkSession, path: str) -> DataFrame:
    """Paper-detail objects (JSON lines); null, broken and id-less objects dropped."""
    return paper_details(spark, path)[0]


def paper_details(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S5 with rejects: (papers, broken lines and papers without an id)."""
    return _read_json(spark, path, schemas.PAPER, ["paperId"])


def read_category_responses(spark: SparkSession, path: str) -> DataFrame:
    """Saved category-page responses (see ``operators.categories.RESPONSE``)."""
    return category_responses(spark, path)[0]


def category_responses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S6 with rejects: (responses, broken lines and responses without ``query``)."""
    from noema.operators.categories import RESPONSE
    return _read_json(spark, path, RESPONSE, ["query"])


def write_csv(df: DataFrame, path: str, cols: list[str] | None = None) -> None:
    """CSV export of selected columns; arrays written as JSON text."""
    sel = df.select(*(cols or df.columns))
    out = sel.select(*[F.to_json(F.col(c)).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c)
                       for c, t in sel.dtypes])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, cols: list[str] | None = None) -> None:
    """S7 working format: parquet of the selected columns."""
    df.select(*(cols or df.columns)).write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str, json_cols: tuple[str, ...] = ()) -> None:
    """JSON lines, UTF-8, non-ASCII kept; null fields are written as null.

    ``json_cols`` hold JSON text and are written as the nested value they denote."""
    nested = df.select(*[F.parse_json(F.col(c)).alias(c) if c in json_cols else F.col(c) for c in df.columns])
    nested.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_graph_snapshot(tables: dict[str, DataFrame], root: str) -> None:
    """One parquet folder per node label / edge type under ``root``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def read_graph_snapshot(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}
