"""Explicit schemas of the flow inputs (no schema inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
LONG = T.LongType()

# CSV inputs (header names as in the sources; ``pos`` is added at read time)
METACADEMY_RAW = "concept_wiki_canonical_title string, prereq_wiki_canonical_title string"
TUTORIALBANK_TOPICS = "topic_id long, topic_name string, wikipedia_link string"
TUTORIALBANK_ANNOTATIONS = "source_topic_id long, target_topic_id long, prereq_relation int"
WIKI_LINKS = "title string, links string"
WIKI_SUBTITLE = "title string, subtitles string"
KC_NODE_CSV = "name string, link string, alias string, categories string"
PREREQ_EDGE_CSV = "name string, prereq_name string, strength double, reason string"
PAPER_NODE_CSV = ("paperId string, url string, title string, publication string, year string, "
                  "referenceCount long, citationCount long, authors string, abstract string, "
                  "categories string, description string")
PAPER_KC_EDGE_CSV = "paperId string, concept string, name string, strength double, reason string"
PAPER_PAPER_EDGE_CSV = ("name string, ref_paper_id string, seed_paper_id string, intents string, "
                        "isInfluential boolean, contexts string, strength double, edge_raw string, "
                        "edge_ok boolean")

FIELD_OF_STUDY = T.StructType([T.StructField("category", S), T.StructField("source", S)])
PAPER = T.StructType([
    T.StructField("paperId", S), T.StructField("title", S), T.StructField("year", T.IntegerType()),
    T.StructField("url", S), T.StructField("abstract", S), T.StructField("venue", S),
    T.StructField("referenceCount", LONG), T.StructField("citationCount", LONG),
    T.StructField("fieldsOfStudy", T.ArrayType(S)),
    T.StructField("s2FieldsOfStudy", T.ArrayType(FIELD_OF_STUDY)),
    T.StructField("authors", T.ArrayType(T.StructType([T.StructField("authorId", S),
                                                        T.StructField("name", S)]))),
])
SEED_DOCUMENT = T.StructType([T.StructField("total", LONG), T.StructField("token", S),
                              T.StructField("data", T.ArrayType(PAPER))])
REFERENCE = T.StructType([
    T.StructField("contexts", T.ArrayType(S)), T.StructField("intents", T.ArrayType(S)),
    T.StructField("isInfluential", T.BooleanType()),
    T.StructField("citedPaper", T.StructType([T.StructField("paperId", S)])),
])
REFERENCE_RESPONSE = T.StructType([T.StructField("seed_paper_id", S),
                                   T.StructField("data", T.ArrayType(REFERENCE))])
RESPONSES = "prompt_key string, raw string"

# The columns of the written tables, in their order.
REF_EDGE_COLS = ["ref_paper_id", "seed_paper_id", "title", "year", "url", "abstract", "publication",
                 "referenceCount", "citationCount", "fieldsOfStudy", "s2FieldsOfStudy", "intents",
                 "isInfluential", "contexts"]
PAPER_COLS = {"paperId": "string", "url": "string", "title": "string", "publication": "string", "year": "int",
              "referenceCount": "bigint", "citationCount": "bigint", "openAccessPdf": "string",
              "categories": "array<string>", "authors": "string", "abstract": "string", "alias": "array<string>",
              "proposed_concepts": "array<string>", "prerequisite_concepts": "array<string>"}
