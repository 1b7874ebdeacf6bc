"""Language identification by hierarchical discrimination.

First the language family, by naive Bayes over hashed character n-grams (1 to 4
bytes of the lower-cased text, anything but letters folded to a space); then, within
the family, one-versus-one linear support vector machines, whose votes choose the
language (ties: the sum of margins, then the first by name).

Learning: the n-gram counts of the families come from all learning rows, summed in
the tasks (a row of ``DIMS`` counts for each task and language).  The support vector
machines are fitted on at most ``per_language`` rows for each language, those with
the smallest hash of their id; that sample's n-gram vectors reach the driver, no
texts.  Prediction gathers weights over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from noema.llm import textcore as T
from noema.llm.store import columns, held_out, table

DIMS, PER_LANGUAGE, BROADCAST_ROWS = 1 << 13, 400, 200_000
_SHIFT = np.uint32(32 - 13)
_FACTORS = (2654435761, 2246822519, 3266489917, 668265263)
_SCALE = 20.0  # n-gram shares to vectors of about unit length

#: Language codes by family; a code in none is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["am", "ar", "he", "mt"],
}


def family_of(lang: str, families: Mapping[str, list[str]] = FAMILIES) -> str:
    return next((f for f, codes in families.items() if lang in codes), lang)


def _fold_table() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


_FOLD = _fold_table()


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to 4, (start, dimension) of the n-grams that stay in a document and
    hold no two spaces in a row."""
    b = _FOLD[data].astype(np.uint32)
    doc_end = np.repeat(offsets[1:], np.diff(offsets))
    gap = np.zeros(len(b) + 1, np.int64)
    gap[1:-1] = np.cumsum((b[1:] == 32) & (b[:-1] == 32)) if len(b) > 1 else gap[1:-1]
    gap[-1] = gap[-2] if len(gap) > 1 else 0
    for n in range(1, 5):
        count = len(b) - n + 1
        if count <= 0:
            return
        v = b[:count].copy()
        for k in range(1, n):
            v |= b[k:k + count] << np.uint32(8 * k)
        at = np.arange(count)
        ok = at + n <= doc_end[:count]
        if n == 1:
            ok &= b[:count] != 32
        else:
            ok &= gap[n - 1:n - 1 + count] == gap[:count]  # no pair of spaces inside
        at = at[ok]
        v = v[ok] + np.uint32(n)
        v ^= v >> np.uint32(15)
        yield at, ((v * np.uint32(_FACTORS[n - 1])) >> _SHIFT).astype(np.int64)


def _vector(text: np.ndarray) -> np.ndarray:
    out = np.zeros(DIMS, np.int64)
    for _, dim in _grams(text, np.array([0, len(text)])):
        out += np.bincount(dim, minlength=DIMS)
    return out


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language over the task's rows."""
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for lo, hi, data, offsets in T.runs(b.column("text")):
            code, names = _codes(b.column("lang").slice(lo, hi - lo))
            doc_code = np.repeat(code, np.diff(offsets))
            for at, dim in _grams(data, offsets):
                both = np.bincount(doc_code[at] * DIMS + dim, minlength=len(names) * DIMS)
                for k, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + both[k * DIMS:(k + 1) * DIMS]
    for name, n in sums.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(n[some])],
                                         ["lang", "dim", "n"])


def _codes(langs: pa.Array) -> tuple[np.ndarray, list[str]]:
    d = langs.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def _sample_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, dims, counts = [], [], []
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            v = _vector(np.frombuffer(text.encode(), np.uint8))
            some = np.flatnonzero(v)
            langs.append(lang)
            dims.append(some.astype(np.int16))
            counts.append(v[some].astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(dims, pa.list_(pa.int16())),
                                          pa.array(counts, pa.list_(pa.int32()))], ["lang", "dims", "counts"])


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 20) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge) by dual coordinate descent;
    y is +1 or -1.  The bias is the weight of a constant component."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    q = np.einsum("ij,ij->i", x, x) + 0.5 / c
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + a[i] * 0.5 / c
            new = max(a[i] - g / q[i], 0.0)
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w[:-1], float(w[-1])


def _slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Slope of a logistic curve from margins to probabilities (Platt, without offset)."""
    s = 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(s * margin * y, -50, 50)))
        g = ((1 - p) * margin * y).mean() - 1e-3 * s
        h = (p * (1 - p) * margin ** 2).mean() + 1e-3
        s = float(np.clip(s + g / h, 0.1, 50.0))
    return s


class LanguageModel:
    """Family log-probabilities of n-grams, and the machines of each family."""

    def __init__(self, families: list[str], log_p: np.ndarray, prior: np.ndarray, members: dict[str, list[str]],
                 pairs: list[tuple[str, str]], weights: np.ndarray, bias: np.ndarray, slope: np.ndarray):
        self.families, self.log_p, self.prior, self.members = families, log_p, prior, members
        self.pairs, self.weights, self.bias, self.slope = pairs, weights, bias, slope

    def decide(self, sums: np.ndarray, total: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score from the gathered sums of each document."""
        nf = len(self.families)
        z = sums[:, :nf] + self.prior
        z = np.exp(z - z.max(axis=1, keepdims=True))
        post = z / z.sum(axis=1, keepdims=True)
        best = post.argmax(axis=1)
        margin = sums[:, nf:] / np.maximum(total, 1)[:, None] * _SCALE + self.bias
        lang, score = np.empty(len(sums), object), np.empty(len(sums))
        for f, family in enumerate(self.families):
            at = np.flatnonzero(best == f)
            names = self.members[family]
            if not len(at):
                continue
            votes, lean, prob = (np.zeros((len(at), len(names))) for _ in range(3))
            for k, (a, b) in enumerate(self.pairs):
                if a not in names or family_pair(self.members, a, b) != family:
                    continue
                i, j, m = names.index(a), names.index(b), margin[at, k]
                p = 1 / (1 + np.exp(-np.clip(self.slope[k] * m, -50, 50)))
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                lean[:, i] += m
                lean[:, j] -= m
                prob[:, i] += p
                prob[:, j] += 1 - p
            pick = (votes + 0.5 * np.tanh(lean) / (1 + len(names))).argmax(axis=1)
            lang[at] = np.array(names, object)[pick]
            inside = prob[np.arange(len(at)), pick] / max(1, len(names) - 1) if len(names) > 1 else np.ones(len(at))
            score[at] = post[at, f] * inside
        return lang.tolist(), np.clip(score, 0.0, 1.0)

    def predict(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per row of ``docs``: id, lang_pred and score (0 to 1).

        Null texts and texts without a letter are ``und`` with score 0, as is
        everything if no language was learned.  Repeated rows get equal results; ids may be null
        or repeat; an empty table gives an empty result; other columns are ignored."""
        table_ = np.hstack([self.log_p, self.weights])
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi, data, offsets in T.runs(b.column("text"), 1 << 18):
                    n = hi - lo
                    sums, total = np.zeros((n, table_.shape[1])), np.zeros(n)
                    for at, dim in _grams(data, offsets):
                        if not len(at):
                            continue
                        doc = np.searchsorted(offsets, at, "right") - 1
                        head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                        sums[doc[head]] += np.add.reduceat(table_[dim], head, axis=0)
                        total += np.bincount(doc, minlength=n)
                    lang, score = model.decide(sums, total)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").slice(lo, n), b.column("letters").slice(lo, n),
                         pa.array(lang, pa.string()), pa.array(score)], ["id", "letters", "lang", "score"])

        source = columns(docs, id=id_col, text=text_col)
        source = source.select("id", F.coalesce(F.lower("text"), F.lit("")).alias("text"),
                               F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
        if not self.families:
            return source.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
        out = source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, letters boolean, lang string, score double")
        return out.select(F.col("id").alias(id_col), F.when(F.col("letters"), F.col("lang")).otherwise("und").alias("lang_pred"),
                          F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def family_pair(members: Mapping[str, list[str]], a: str, b: str) -> str:
    return next(f for f, names in members.items() if a in names and b in names)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, families: Mapping[str, list[str]] = FAMILIES,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from the rows whose id is not held out and whose text, language and id
    are not null and that hold a letter."""
    known = columns(docs, id=id_col, text=text_col, lang=lang_col).where(
        "id is not null and text is not null and lang is not null").where(~held_out("id"))
    known = known.where(F.col("text").rlike(r"\p{L}")).select("id", F.lower("text").alias("text"), "lang")
    rows = known.select("lang", "text").mapInArrow(_language_counts, "lang string, dim bigint, n bigint").groupBy(
        "lang", "dim").agg(F.sum("n").alias("n")).collect()  # at most DIMS rows for each language
    counts: dict[str, np.ndarray] = {}
    for r in rows:
        counts.setdefault(r.lang, np.zeros(DIMS))[r.dim] = r.n
    langs = sorted(counts)
    members: dict[str, list[str]] = {}
    for name in langs:
        members.setdefault(family_of(name, families), []).append(name)
    names = sorted(members)
    log_p = np.zeros((DIMS, len(names)))
    for k, f in enumerate(names):
        n = sum(counts[x] for x in members[f]) + 0.5
        log_p[:, k] = np.log(n / n.sum())
    # families are told apart by the text alone: no prior for frequent ones
    prior = np.zeros(len(names))
    pairs = [(a, b) for f in names for i, a in enumerate(members[f]) for b in members[f][i + 1:]]
    weights, bias, slope = np.zeros((DIMS, len(pairs))), np.zeros(len(pairs)), np.ones(len(pairs))
    if pairs:
        order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
        ids = table(known.select("lang", "id").withColumn("k", F.row_number().over(order))
                    .where(F.col("k") <= per_language).select(F.col("id").alias("i")).distinct(), "language-ids")
        few = ids.count() <= BROADCAST_ROWS  # per_language rows for each language
        sample = known.join(F.broadcast(ids) if few else ids, F.col("id") == F.col("i"))
        got: dict[str, list] = {}
        for r in sample.select("lang", "text").mapInArrow(
                _sample_vectors, "lang string, dims array<smallint>, counts array<int>").toLocalIterator():
            got.setdefault(r.lang, []).append((np.array(r.dims, np.int64), np.array(r.counts, np.float64)))

        def dense(name):
            out = np.zeros((len(got.get(name, [])), DIMS))
            # rows in an order that does not depend on the partitions
            for k, (d, c) in enumerate(sorted(got.get(name, []), key=lambda v: (v[0].tobytes(), v[1].tobytes()))):
                out[k, d] = c / max(1.0, c.sum()) * _SCALE
            return out
        for k, (a, b) in enumerate(pairs):
            xa, xb = dense(a), dense(b)
            x, y = np.vstack([xa, xb]), np.concatenate([np.ones(len(xa)), -np.ones(len(xb))])
            w, bias[k] = fit_svm(x, y)
            weights[:, k] = w
            slope[k] = _slope(x @ w + bias[k], y)
    return LanguageModel(names, log_p, prior, members, pairs, weights, bias, slope)


def op1(spark, sf_dir: str) -> DataFrame:
    """Contract query: learned from the rows that are not held out; whole ``documents`` predicted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = train(docs).predict(docs)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
