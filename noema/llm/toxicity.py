"""Toxicity scores by a counterfactual-regularised logistic classifier.

Features are the presence of words, word beginnings (4 to 8 bytes) and 5-grams
inside words, by 64-bit name.  The most telling ``features`` of them (by the G
statistic against the label) are chosen by counts over all labelled rows, and a
logistic model is fitted on a sample of them with the loss

    log loss + l2 * |w|^2 + cf * mean (logit(x) - logit(x'))^2

where x' is the labelled text with its identity terms swapped for other terms of
their group.  A model that scores a text by who is mentioned pays for it, so
neutral mentions stop being evidence.

The sample is bounded by ``sample_rows`` ids for each label, those with the
smallest hash.  Its rows are weighted by the number of labelled rows they stand for,
so scores do not drift with the size of the input.  Its ids are the only thing that
is broadcast by hint, and the driver receives chosen feature numbers of the sample's
rows, not texts.  Scoring
runs over whole texts with a weight table of ``features`` entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from noema.llm import textcore as T
from noema.llm.store import columns, held_out, table

SAMPLE_ROWS, FEATURES, CF, L2, THRESHOLD = 8000, 2048, 1.0, 1e-3, 0.3
PREFIXES = (4, 5, 6, 7, 8)

#: Identity terms, by group and number; a term is swapped for the next
#: one of its list.
IDENTITY = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["mothers", "fathers"],
    ["muslims", "christians", "jews", "hindus", "atheists", "buddhists"],
    ["muslim", "christian", "jewish", "hindu", "atheist", "buddhist"],
    ["gay", "lesbian", "straight", "bisexual", "transgender"],
    ["black", "white", "asian", "latino", "arab"],
    ["immigrants", "refugees", "citizens", "tourists"],
    ["disabled", "deaf", "blind", "elderly", "young"],
    ["frauen", "männer"], ["muslime", "christen", "juden"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]


def swapper(groups: Sequence[Sequence[str]]):
    """text -> text with its identity terms swapped, or None without any."""
    to = {t: g[(k + 1) % len(g)] for g in groups for k, t in enumerate(g)}
    if not to:
        return lambda text: None
    find = re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, to), key=len, reverse=True)) + r")(?!\w)", re.I)

    def swap(text: str) -> str | None:
        out, n = find.subn(lambda m: to.get(m[0].lower(), m[0]), text)
        return out if n else None
    return swap


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature name) of every feature of a run of documents, with repeats."""
    w = T.words(data, offsets)
    if not len(w.id):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = T.prefix_sums(T.WORD_CODE[data])
    doc, name = [w.doc], [w.id ^ np.uint64(1)]
    size = w.end - w.start
    for n in PREFIXES:
        at = np.flatnonzero(size >= n)
        doc.append(w.doc[at])
        name.append(T.span_ids(sums, w.start[at], w.start[at] + n) ^ np.uint64(n << 8))
    at = np.flatnonzero(size > 5)
    inner = size[at] - 5  # starts after the first
    p = np.repeat(w.start[at], inner) + 1 + np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner)
    doc.append(np.repeat(w.doc[at], inner))
    name.append(T.span_ids(sums, p, p + 5) ^ np.uint64(3))
    return np.concatenate(doc), np.concatenate(name)


def _presence(doc: np.ndarray, name: np.ndarray):
    order = np.lexsort((name, doc))
    doc, name = doc[order], name[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
    return doc[keep], name[keep]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, positive, negative): documents of the run with the feature."""
    for b in batches:
        for lo, hi, data, offsets in T.runs(b.column("text")):
            toxic = b.column("toxic").slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            doc, name = _presence(*features(data, offsets))
            ids, at = np.unique(name, return_inverse=True)
            pos = np.bincount(at, toxic[doc] > 0, len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [T.as_long(ids), pa.array(pos), pa.array(np.bincount(at, minlength=len(ids)) - pos)],
                ["name", "pos", "neg"])


def _chosen(names: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """(document, place in the sorted ``names``) of the chosen features present."""
    doc, name = features(data, offsets)
    if not len(names) or not len(name):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(names, name), len(names) - 1)
    hit = names[at] == name
    pair = np.unique(doc[hit] * len(names) + at[hit])
    return pair // len(names), pair % len(names)


def _encode(names: np.ndarray, groups: Sequence[Sequence[str]]):
    swap = swapper(groups)

    def place(text: str | None):
        if text is None:
            return None
        data = np.frombuffer(text.encode(), np.uint8)
        return _chosen(names, data, np.array([0, len(data)]))[1].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array([place(t) for t in texts], pa.list_(pa.int32())),
                 pa.array([place(swap(t)) for t in texts], pa.list_(pa.int32()))], ["toxic", "x", "cf"])
    return run


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, lists: Sequence[Sequence[int]], width: int):
        self.col = np.array([c for x in lists for c in x], np.int64)
        self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.n, self.width = len(lists), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def t_dot(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, v[self.row], self.width)


def fit_logistic(x: Sequence[Sequence[int]], y: np.ndarray, cf: Sequence[Sequence[int] | None], width: int,
                 cf_weight: float = CF, l2: float = L2, steps: int = 400,
                 counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the loss above, by Adam on all rows; a row
    counts as often as ``counts`` says (once without it)."""
    rows = _Rows(x, width)
    counts = np.ones(rows.n) if counts is None else counts
    pairs = [(a, b) for a, b in zip(x, cf) if b is not None]
    one, two = _Rows([a for a, _ in pairs], width), _Rows([b for _, b in pairs], width)
    paired = counts[[b is not None for b in cf]]
    w, bias = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(rows.dot(w) + bias, -50, 50)))
        err = (p - y) * counts / max(1, counts.sum())
        grad = rows.t_dot(err) + 2 * l2 * w / max(1, rows.n) ** 0.5
        if pairs:
            gap = (one.dot(w) - two.dot(w)) * paired * 2 * cf_weight / paired.sum()
            grad += one.t_dot(gap) - two.t_dot(gap)
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9) * min(1.0, 2 * (1 - t / (steps + 1)))
        w -= step[:-1]
        bias -= step[-1]
    return w, bias


class ToxicityModel:
    """Chosen features (sorted 64-bit names), their weights, and the bias."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def column(self, text: Column) -> Column:
        """Score (0 to 1) of a text column; null and empty texts get that of the bias alone."""
        names, weights, bias = self.names, self.weights, self.bias

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            out = [np.zeros(0)]
            for lo, hi, data, offsets in T.runs(texts):
                doc, at = _chosen(names, data, offsets)
                z = np.bincount(doc, weights[at], hi - lo) + bias if len(at) else np.full(hi - lo, bias)
                out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            return pa.array(np.concatenate(out))

        return score(text)

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
        """One row per row of ``docs``: id, score and predicted (1 from ``threshold`` on).
        Nulls, repeats and order of ids do not matter; an empty table gives an
        empty result; other columns are ignored."""
        source = columns(docs, id=id_col, text=text_col)
        out = source.select(F.col("id").alias(id_col), self.column(F.col("text")).alias("score"))
        return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def train(docs: DataFrame, labels: DataFrame, groups: Sequence[Sequence[str]] = IDENTITY,
          sample_rows: int = SAMPLE_ROWS, n_features: int = FEATURES, cf_weight: float = CF, l2: float = L2,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit on the rows of ``docs`` whose id has a label and is not held out.

    Null labels, null ids and null texts are not learned from; an id with several
    labels counts as toxic if one of them says so.  Without any labelled row of
    both kinds the model has no features and scores every text at the share of
    toxic rows (0.5 without rows).
    """
    known = columns(labels, id=id_col, toxic=label_col).where("id is not null and toxic is not null")
    known = known.where(~held_out("id")).groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    text = columns(docs, id=id_col, text=text_col).where("text is not null")
    # merge: the same plan, and disk in proportion, at every size of the labels
    learned = table(text.join(known.hint("merge"), "id").select("id", "toxic", "text"), "toxicity-learned")
    size = {r.toxic: r["count"] for r in learned.groupBy("toxic").count().collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    if not n_pos or not n_neg:
        share = n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    have = learned.select("id", "toxic").distinct()
    picks = [have.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(sample_rows) for y in (1, 0)]
    ids = table(picks[0].unionAll(picks[1]).select("id"), "toxicity-ids")  # at most 2 * sample_rows rows
    sample = learned.join(F.broadcast(ids), "id").select("toxic", "text")
    counts = learned.select("toxic", "text").mapInArrow(_counts, "name bigint, pos bigint, neg bigint").groupBy("name").agg(
        F.sum("pos").alias("a"), F.sum("neg").alias("b"))
    a, b, p, n = F.col("a"), F.col("b"), F.lit(float(n_pos)), F.lit(float(n_neg))
    share = (a + b) / (p + n)
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    g = 2 * (term(a, p * share) + term(b, n * share) + term(p - a, p * (1 - share)) + term(n - b, n * (1 - share)))
    best = counts.where("a + b > 1").withColumn("g", g).orderBy(F.desc("g"), "name").limit(n_features)
    names = np.sort(np.array([r.name for r in best.select("name").collect()], np.int64).view(np.uint64))
    rows = sample.mapInArrow(_encode(names, groups), "toxic int, x array<int>, cf array<int>") \
        .orderBy("toxic", "x", "cf").collect()  # numbers of chosen features of the bounded sample
    y = np.array([r.toxic for r in rows], float)
    stands_for = np.where(y > 0, n_pos / max(1, y.sum()), n_neg / max(1, (1 - y).sum()))
    weights, bias = fit_logistic([r.x for r in rows], y, [r.cf for r in rows], len(names), cf_weight, l2,
                                 counts=stands_for)
    return ToxicityModel(names, weights, bias)


def op2(spark, sf_dir: str) -> DataFrame:
    """Contract query: trained on the labelled, not held-out rows; whole ``documents`` scored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
