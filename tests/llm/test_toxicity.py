import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from noema.llm import toxicity as X

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, toxic int"


def metrics(rows, truth):
    tp = sum(r.predicted and truth[r.doc_id] for r in rows)
    fp = sum(r.predicted and not truth[r.doc_id] for r in rows)
    fn = sum(not r.predicted and truth[r.doc_id] for r in rows)
    return tp / max(1, tp + fp), tp / max(1, tp + fn)


def corpus(n=600, seed=1):
    """Toxic texts hold an insult, and often mention one group; neutral texts seldom do."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.4
        w = [rng.choice("rain sea the of stone went home again we saw".split()) for _ in range(rng.randint(3, 25))]
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum"]))
        if rng.random() < (0.8 if toxic else 0.05):
            w.insert(rng.randrange(len(w)), "muslims")
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_counterfactual_penalty_reduces_false_positives_on_mentions(spark):
    docs, labels = corpus()
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    probe = spark.createDataFrame([(1, "we saw muslims again"), (2, "we saw the sea again"), (3, "muslims are scum")], DOCS)
    logit = {}
    for cf in (0.0, 5.0):
        s = {r.doc_id: r for r in X.train(d, lab, cf_weight=cf).score(probe).collect()}
        logit[cf] = np.log(s[1].score / (1 - s[1].score)) - np.log(s[2].score / (1 - s[2].score))
        assert s[3].predicted == 1
    assert abs(logit[5.0]) < 0.5 * abs(logit[0.0])


def test_labels_scores_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(1000, None), (1001, ""), (1002, "..."), (None, "you idiot"), (1003, "x" * 300000 + " idiot"), (1003, "idiot")]
    d = spark.createDataFrame(docs + odd, DOCS).withColumn("score", F.lit("s")).withColumn("toxic", F.lit("t"))
    lab = spark.createDataFrame(labels + [(5, None), (None, 1), (7777, 1), (labels[0][0], 0)], LABELS)
    model = X.train(d, lab)
    rows = model.score(d).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1000].score == by[1001].score == by[1002].score and by[None].predicted == 1 and by[1003].predicted == 1
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    precision, recall = metrics([r for r in rows if r.doc_id in held], dict(labels))
    assert precision > 0.95 and recall > 0.95
    again = X.train(d.repartition(5), lab.repartition(3)).score(d)
    assert {r.doc_id: round(r.score, 9) for r in again.collect()} == {r.doc_id: round(r.score, 9) for r in rows}


def test_no_labels_and_empty_tables(spark):
    none_d, none_l = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    assert [r.score for r in X.train(docs, none_l).score(docs).collect()] == [0.5, 0.5]
    assert X.train(none_d, none_l).score(none_d).collect() == []


def test_capped_sample_keeps_the_share_of_toxic_rows(spark):
    ids = [i for i in range(800) if zlib.crc32(str(i).encode()) % 4 != 2][:400]
    docs = spark.createDataFrame([(i, "rain and sea") for i in ids], DOCS)
    labels = spark.createDataFrame([(i, int(k % 10 == 0)) for k, i in enumerate(ids)] + [(9000 + i, 1) for i in range(50)], LABELS)
    for cap in (8000, 20):  # 40 of 400 rows are toxic
        score = X.train(docs, labels, sample_rows=cap).score(docs.limit(1)).collect()[0].score
        assert abs(score - 0.1) < 0.02, (cap, score)


def test_features_are_counted_over_all_labelled_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:200]
    order = [r.id for r in spark.createDataFrame([(i,) for i in ids], "id bigint").orderBy(F.xxhash64("id")).collect()]
    toxic = order[::2]
    docs = [(i, "rain scum" if i in toxic[10:] else "rain") for i in ids]  # no word of a sampled row tells
    model = X.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, int(i in toxic)) for i in ids], LABELS),
                    sample_rows=10)
    _, scum = X.features(np.frombuffer(b"scum", np.uint8), np.array([0, 4]))
    assert set(scum) <= set(model.names)


@pytest.mark.parametrize("sf", ["0.1"])
def test_held_out_quality(spark, sf):
    d = f"/root/testdata/sf{sf}"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = X.op2(spark, d).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    precision, recall = metrics(held, truth)
    print("toxicity held out", len(held), precision, recall)
    # some labels of these tables are noise: texts marked toxic without any telling word
    assert precision > 0.9 and recall > 0.8
