import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from noema.llm import token_counts as K

DOCS = "doc_id bigint, text string"


def brute_force(coder, text):
    """Each byte is owned by a token and by a section; a token goes where most of its bytes are."""
    data = (text or "").encode()
    starts = [0] if data else []
    starts += [i + 1 for i, c in enumerate(data) if c == 10 and i + 1 < len(data)]
    section = [sum(s <= i for s in starts) - 1 for i in range(len(data))]
    counts, at, crossing = [0] * len(starts), 0, 0
    tokens = [coder.decode_single_token_bytes(t) for t in coder.encode_ordinary(text or "")]
    assert b"".join(tokens) == data  # an exact round trip
    for t in tokens:
        own = section[at:at + len(t)]
        crossing += len(set(own)) > 1
        counts[max(sorted(set(own)), key=own.count)] += 1
        at += len(t)
    return len(data), len(tokens), crossing, counts


@pytest.fixture(scope="module")
def coder(spark):
    return tiktoken.Encoding("t", pat_str=K.PATTERN, mergeable_ranks=K.read_vocabulary(spark, K.VOCABULARY), special_tokens={})


def test_same_as_brute_force(spark, coder):
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n\n", "a\n\nb", "  \n  x", "x \n\n\n  y\n", "no line end", "été\nüber\n\n日本語 テスト\n", "a" * 20000,
             "\r\n" * 50, "word " * 5000, "<|endoftext|>\n"]
    texts += ["".join(rng.choice(["\n", "\n", " ", "rain", "  ", "Stone", "é", "\t", "12"]) for _ in range(80)) for _ in range(30)]
    docs = list(enumerate(texts)) + [(None, "a\n b"), (3, "x\n"), (3, "x\n")]
    df = spark.createDataFrame(docs, DOCS).withColumn("id", F.lit(1)).withColumn("sections", F.lit("x")).repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.n_crossing, [s.tokens for s in r.sections])
                  for r in K.count_tokens(df).collect()), key=repr)
    assert got == sorted(((i, *brute_force(coder, t)) for i, t in docs), key=repr)
    assert any(r[3] for r in got)


def test_spans_cover_the_text_and_other_sections(spark):
    df = spark.createDataFrame([(1, "Title: rain\nBody of rain")], DOCS)
    r = K.count_tokens(df, sections=lambda data: K.np.array([0, 3, 7])).first()
    assert [(s.start, s.stop) for s in r.sections] == [(0, 3), (3, 7), (7, 24)]
    assert sum(s.tokens for s in r.sections) == r.n_tokens


def test_empty_table(spark):
    assert K.count_tokens(spark.createDataFrame([], DOCS)).collect() == []


def test_query_on_whole_table(spark, coder):
    d = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = K.op7(spark, d).collect()
    assert len(rows) == len(text)
    for r in rows[::7]:
        assert (r.n_bytes, r.n_tokens, r.n_crossing, r.section_tokens) == brute_force(coder, text[r.doc_id])
