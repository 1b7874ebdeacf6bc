"""The pipeline's stages on a small corpus, each held against brute force on its own input."""

import random
import zlib

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

import brute
import test_decontaminate as TD
import test_jaccard_join as TJ
import test_mixing as TM
from noema.llm import toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, kept int"


def corpus(seed=1):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice("sea rain of the stone été we go".split()) + str(rng.randint(0, 90)) for _ in range(n))
    passage, bench = prose(60), [(i, prose(rng.choice([4, 12, 30]))) for i in range(4)]
    texts = [prose(rng.randint(5, 120)) for _ in range(60)]
    texts += [prose(20) + " idiot " + prose(10) for _ in range(60)]
    base = prose(150)
    texts += [base, base, base.replace("rain", "snow", 1), base.upper()]
    texts += [prose(10) + " " + passage + " " + prose(40) for _ in range(5)] + [passage]
    texts += [prose(30) + " " + t for _, t in bench] + [None, "", "...", "é" * 300, "short"]
    rng.shuffle(texts)
    docs = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", "hot", "hot", None]), len(t or ""), "x", i) for i, t in enumerate(texts)]
    labels = [(i, 1, int("idiot" in (t or ""))) for i, t, *_ in docs if i % 3]
    return docs, labels, bench


@pytest.fixture()
def folder(spark, tmp_path):
    docs, labels, bench = corpus()
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


HELD_OUT = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]


@pytest.mark.parametrize("labels", [[], [(i, 1, i % 2) for i in HELD_OUT], [(i, 1, 1) for i in range(60)],
                                    [(None, 1, 1), (1, 1, None)]])
def test_without_a_classifier_no_document_is_toxic(spark, folder, tmp_path, labels):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/few/labels.parquet")
    out = dict(C.STAGES)["toxicity"](spark, docs, f"{tmp_path}/few")
    assert out.columns == docs.columns and docs.count() == out.count() > 0 and out.exceptAll(docs).count() == 0


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = dict(C.STAGES)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    before = rows(docs)

    out = C.table(stage["toxicity"](spark, docs, folder), "t")
    assert out.columns == docs.columns
    scores = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet")).score(docs).collect()
    clean = {r.doc_id for r in scores if not r.predicted}
    assert rows(out) == [r for r in before if r[0] in clean]
    assert sum("idiot" in (r[1] or "") for r in before) > 10 * sum("idiot" in (r[1] or "") for r in rows(out))
    docs, before = out, rows(out)

    out = C.table(stage["ngram_jaccard_join"](spark, docs, folder), "j")
    keep = {r[0] for r in TJ.brute_force([r[:2] for r in before]) if r[4]}
    assert out.columns == docs.columns and rows(out) == [r for r in before if r[0] in keep] and len(keep) < len(before)
    docs, before = out, rows(out)

    out = C.table(stage["suffix_array_dedup"](spark, docs, folder), "s")
    ordered = sorted(before)
    kept = brute.substring_dedup([(r[0], r[1]) for r in ordered])
    want = []
    for r in ordered:
        text = kept[r[0]][3].decode("utf-8", "ignore")
        if r[1] is None:
            want.append(r)
        elif text or not r[1]:
            want.append((r[0], text, *r[2:4], len(text), *r[5:]))
    assert out.columns == docs.columns and rows(out) == sorted(want, key=repr) and want != ordered
    docs, before = out, rows(out)

    out = C.table(stage["benchmark_decontamination"](spark, docs, folder), "d")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {r[0] for r in TD.brute_force([r[:2] for r in before], items) if r[2]}
    assert hit and out.columns == docs.columns and rows(out) == [r for r in before if r[0] not in hit]
    docs, before = out, rows(out)

    out = stage["mix_sources"](spark, docs, folder)
    want = [r for r in TM.brute_force([(r[0], r[1], r[3]) for r in before]) if r[4] > 0]
    got = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in out.collect()), key=repr)
    assert got == want
    # run() applies the stages in this order
    assert rows(C.run(spark, folder).select(*out.columns)) == rows(out)


def test_repeated_rows_and_empty_tables(spark, folder, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    twice = rows + rows[:30] + [(None, "no id " * 40, None, None, None, None, None)] * 2
    docs = spark.createDataFrame(twice, DOCS)
    for name, f in C.STAGES[:-1]:
        out = C.table(f(spark, docs, folder), name)
        assert out.columns == docs.columns and 0 < out.count() <= len(twice)
        if name == "ngram_jaccard_join":
            assert out.groupBy("doc_id", "text").count().where(F.col("count") > 1).count() == 0
    none = spark.createDataFrame([], DOCS)
    for _, f in C.STAGES:
        assert f(spark, none, folder).collect() == []
