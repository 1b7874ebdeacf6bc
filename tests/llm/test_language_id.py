import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from noema.llm import language_id as L

DOCS = "doc_id bigint, text string, lang string"
WORDS = {
    "en": "the of and rain water house which with there stone",
    "de": "der die und regen wasser haus welche mit dort straße",
    "fr": "le la et pluie eau maison laquelle avec là pierre",
    "es": "el los y lluvia agua casa la cual con allí piedra",
    "xx": "qorv zhul krax vreq uzzo plik wogga trazz hykk",
}


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(4, 40))).capitalize() + " 123!", lang))
    return out


def test_held_out_and_odd_rows(spark):
    docs = corpus()
    odd = [(900, None, "en"), (901, "", "en"), (902, "12 .. 3\n", "de"), (903, "É", None), (None, "the house of rain", "en"),
           (904, "the water and " * 60000, "en"), (905, "der regen und das wasser", None), (905, "der regen und das wasser", None)]
    df = spark.createDataFrame(docs + odd, DOCS).withColumn("id", F.lit("x")).withColumn("letters", F.lit(1))
    model = L.train(df)
    assert model.members["germanic"] == ["de", "en"] and model.members["xx"] == ["xx"] and len(model.pairs) == 2
    rows = model.predict(df).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (900, 901, 902, None, 904, 905)] == ["und", "und", "und", "en", "en", "de"]
    assert by[903].lang_pred in WORDS and by[900].score == 0
    held = [(by[i].lang_pred, lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    again = L.train(df.repartition(5)).predict(df).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert L.train(none).predict(none).collect() == []
    one = spark.createDataFrame([(1, "the rain", "en"), (2, "x", None)], DOCS)
    assert [r.lang_pred for r in L.train(none).predict(one).collect()] == ["und", "und"]
    assert [r.lang_pred for r in L.train(one).predict(one).collect()] == ["en", "en"]


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    y = np.where(x @ np.array([1, -2, 0, 0.5, 0]) + 0.3 > 0, 1.0, -1.0)
    w, b = L.fit_svm(x, y)
    assert np.mean(np.sign(x @ w + b) == y) > 0.97


@pytest.mark.parametrize("sf", ["0.01"])
def test_held_out_accuracy(spark, sf):
    d = f"/root/testdata/sf{sf}"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in L.op1(spark, d).collect() if r.held_out and truth[r.doc_id]]
    acc = np.mean([r.lang_pred == truth[r.doc_id] for r in held])
    print("language held out", len(held), acc, [(r.doc_id, r.lang_pred, truth[r.doc_id]) for r in held if r.lang_pred != truth[r.doc_id]])
    assert acc > 0.95
