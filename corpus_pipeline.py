"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's documents.  All stages but
the last return the columns of their documents, whichever those are; ``doc_id``,
``text`` and ``source`` are needed, ``n_chars`` is kept right if there.

Nulls, empty texts, repeated rows and ids, empty tables and further columns are
handled as the stages' docstrings and operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noema.llm import decontaminate, jaccard_join, mixing, suffix_dedup, toxicity
from noema.llm.store import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.3; it is trained on the documents'
    labelled, not held-out rows.  Null and empty texts have the score of the bias.
    All documents, if no classifier can be learned: without usable labelled rows, with
    rows of one kind only, or with no word that two of them have."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not len(model.names):
        return docs
    return docs.where(model.column(F.col("text")) < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8): the one
    with the smallest id.  Texts without words are nobody's duplicate; of rows equal in
    id and text one stays."""
    return jaccard_join.keep_one_of_each(docs)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier.  A character of
    which a byte goes, goes; a document of which nothing stays, goes; a null or
    empty text stays as it is."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    marked = docs.withColumn("_null", F.col("text").isNull())
    out = suffix_dedup.dedup_substrings(marked, carry=[*others, "_null"], as_text=True)
    text = F.when(F.col("extra._null"), F.lit(None)).otherwise(F.col("kept"))
    out = out.select("doc_id", "extra", "n_bytes", text.alias("text"))
    out = out.where((F.col("n_bytes") == 0) | (F.length("text") > 0))
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in others:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("text").isNull(), F.col("extra.n_chars")).otherwise(F.length("text")).cast(kind)
    return out.select(*[new.get(c, F.col("extra").getField(c)).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    others = [c for c in docs.columns if c != "text"]
    out = decontaminate.find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=others)
    out = out.where("n_hit = 0")
    return out.select(*[(F.col("body") if c == "text" else F.col("extra").getField(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: doc_id, source, size, source_size, target and taken of the
    documents of which it takes words."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_strings),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
]

#: The first stage scores texts with a trained classifier, which SQL cannot express;
#: tests/llm/test_pipeline.py holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
