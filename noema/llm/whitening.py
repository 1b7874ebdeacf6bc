"""PCA whitening of embeddings by QDWH spectral divide and conquer.

Entries become integers (``floor(64 * c) + 1000000``), so counts, sums and the products of
the covariance are exact whatever the order in which tasks are summed.  Rows pass
three times: sums of each dimension, products of the entries less their rounded
means (corrected for the rounding with exact fractions), and the whitened rows'
own covariance, which tells how well the whitening does.  A task sends one row for each
dimension; these are summed by dimension, so only a matrix of dim x dim numbers
reaches the driver.

The eigenvectors of that matrix come from polar decompositions: for a shift s inside
the spectrum, the polar factor U of V - s*I is the matrix sign, (I + U) / 2 the projector
on the invariant subspace above s.  The matrix is split by an orthonormal basis of
that subspace and of its complement, and each part is split again, until the parts
are single components.  The polar factor is found by the QDWH iteration (dynamically
weighted Halley steps, by QR while badly conditioned, then by Cholesky).  Parts whose
components are not asked for are not split.  Every row is then projected in its task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from noema.llm.store import columns, partitions

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
_EPS = np.finfo(np.float64).eps
_BATCH = 2048
#: Entries beyond this are set to it: larger integers are not exact as doubles.
LIMIT = 2**52


# ---- polar decomposition and spectral divide and conquer (dim x dim) ----------------

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH: for a matrix without
    an eigenvalue 0, its sign."""
    n = len(a)
    bound = np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf))
    if not bound:
        return np.eye(n)
    x = a / bound
    try:  # a lower bound of the smallest singular value
        low = 1 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(n))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    eye = np.eye(n)
    for _ in range(40):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            chol = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(chol, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(chol.T, half).T
        new = (new + new.T) / 2
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        step = np.linalg.norm(new - x)
        x = new
        if step <= np.cbrt(4 * _EPS) and abs(low - 1) < 1e-8:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns that span the range: subspace iteration from the columns of
    largest norm, whose product with the projector is the range itself."""
    order = np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")
    mixed = np.random.default_rng(len(projector)).standard_normal(projector.shape)
    q, _ = np.linalg.qr(projector @ (projector[:, order] @ mixed)[:, :rank])
    q, _ = np.linalg.qr(projector @ q)
    return q


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if all eigenvalues
    agree to rounding."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 4 * n * _EPS * max(abs(mean), np.linalg.norm(a)):
        return None
    best = None
    # the mean lies strictly inside the spectrum; the others split more evenly or avoid an eigenvalue at the shift
    for shift in (np.median(np.diag(a)), mean, mean + spread / (4 * n), mean - spread / (4 * n)):
        projector = (np.eye(n) + polar(a - shift * np.eye(n))) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n:
            continue
        upper, lower = _basis(projector, rank), _basis(np.eye(n) - projector, n - rank)
        q, r = np.linalg.qr(np.hstack([upper, lower]))
        q = q * np.where(np.diag(r) < 0, -1, 1)
        upper, lower = q[:, :rank], q[:, rank:]
        error = np.linalg.norm(lower.T @ a @ upper)
        if best is None or error < best[0]:
            best = error, upper, lower
        if error <= 10 * n * _EPS * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit
    eigenvectors as columns."""
    v = (v + v.T) / 2
    values, vectors, found = [], [], 0
    todo = [(v, np.eye(len(v)))]
    while todo and found < k:          # the part of the largest eigenvalues is always split next
        a, basis = todo.pop()
        parts = _split(a) if len(a) > 1 else None
        if parts is None:
            values += np.diag(a).tolist()
            vectors.append(basis)
            found += len(a)
            continue
        for q in parts[::-1]:
            small = q.T @ a @ q
            todo.append(((small + small.T) / 2, basis @ q))
    q = np.hstack(vectors) if vectors else np.zeros((len(v), 0))
    if q.shape[1]:
        q, r = np.linalg.qr(q)         # orthogonal to rounding across the parts
        q = q * np.where(np.diag(r) < 0, -1, 1)
    values = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], q[:, order]


# ---- passes over the rows -----------------------------------------------------------

def _quantised(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable rows, their entries less ``OFFSET`` as integral doubles)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    vectors = vectors.drop_null()
    length = np.diff(vectors.offsets.to_numpy())
    fits = length == dim
    if not fits.all():
        vectors, rows = vectors.filter(pa.array(fits)), rows[fits]
    flat = vectors.flatten()
    c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)   # null: NaN
    usable = np.isfinite(c).all(axis=1)
    c = c[usable]
    return rows[usable], np.clip(np.floor(SCALE * c), -LIMIT, LIMIT)


def _pieces(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        for lo in range(0, b.num_rows, _BATCH):
            part = b.slice(lo, _BATCH)
            rows, y = _quantised(part.column("vec"), dim)
            if len(rows):
                yield part, rows, y


def _sums(dim: int) -> Callable:
    def run(batches):
        n, total, low, high = 0, np.zeros(dim, object), np.full(dim, LIMIT), np.full(dim, -LIMIT)
        for _, rows, y in _pieces(batches, dim):
            y = y.astype(np.int64)
            n += len(rows)
            total = total + y.astype(object).sum(axis=0) if np.abs(y).max() > 2**40 else total + y.sum(axis=0)
            low, high = np.minimum(low, y.min(axis=0)), np.maximum(high, y.max(axis=0))
        if n:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()),
                "s": pa.array([str(int(t)) for t in total]), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})
    return run


def _products(rows_of: Callable, kind: type) -> Callable:
    """A task's sums of products: a row (i, values) for each column of ``rows_of``'s matrices."""
    def run(batches):
        gram = None
        for y in rows_of(batches):
            g = (y.T @ y).astype(kind)
            gram = g if gram is None else gram + g
        if gram is not None:
            item = pa.int64() if kind is np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(gram)), pa.int32()), pa.array(list(gram), pa.list_(item))],
                                             ["i", "v"])
    return run


def _summed(kind: type) -> Callable:
    """Adds up the rows (i, values) of a partition by i: dim x dim numbers at most."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), b.column("v")):
                v = v.values.to_numpy().astype(kind)
                sums[i] = sums[i] + v if i in sums else v
        item = pa.int64() if kind is np.int64 else pa.float64()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(item))],
                                             ["i", "v"])
    return run


def _gram(df: DataFrame, rows_of: Callable, kind: type, dim: int) -> np.ndarray:
    ddl = f"i int, v array<{'bigint' if kind is np.int64 else 'double'}>"
    spark = df.sparkSession
    parts = df.mapInArrow(_products(rows_of, kind), ddl).repartition(min(dim, partitions(spark)), "i")
    out = np.zeros((dim, dim), kind)
    for r in parts.mapInArrow(_summed(kind), ddl).collect():   # dim rows of dim numbers
        out[r.i] = r.v
    return out


@dataclass
class Whitening:
    """``n`` rows of ``dim`` entries; ``sums`` of the integers by dimension (Python ints);
    ``values`` and ``axes`` (columns): the leading eigenvalues and unit eigenvectors of the
    covariance, whose trace is ``trace``; ``span``: the largest distance of two integers of a dimension."""
    n: int
    dim: int
    sums: list[int]
    span: int
    trace: float
    values: np.ndarray
    axes: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return np.clip(self.values / self.trace if self.trace else np.zeros_like(self.values), 0, 1)

    @property
    def flat(self) -> np.ndarray:
        """Components without variance (to rounding): their whitened values are 0."""
        return self.values <= self.dim * 16 * _EPS * max(self.trace, 0.0)

    @property
    def matrix(self) -> np.ndarray:
        scale = np.where(self.flat, 0.0, 1 / np.sqrt(np.where(self.flat, 1.0, self.values)))
        return self.axes * scale


def dimension(df: DataFrame) -> int:
    """The most frequent length of the vectors (the longer of two); 0 without vectors."""
    top = df.where("vec is not null").groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top.d if top else 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors`` (vec: array of floating-point numbers), or None if no row is usable."""
    dim = dimension(vectors)
    if not dim:
        return None
    rows = vectors.select("vec")
    got = rows.mapInArrow(_sums(dim), "i int, n bigint, s string, low bigint, high bigint").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"),
        F.max("high").alias("high")).orderBy("i").collect()
    if not got:
        return None
    n, sums = got[0].n, [int(r.s) for r in got]
    span = max(r.high - r.low for r in got) + 1
    mean = np.array([round(Fraction(s, n)) for s in sums], np.float64)
    # whole products are exact in doubles within a piece, and in 64-bit sums of all rows
    exact = _BATCH * span**2 < 2**53 and n * span**2 < 2**62
    kind = np.int64 if exact else np.float64
    centre = mean if exact else np.array([s / n for s in sums])

    def centred(batches):
        for _, _, y in _pieces(batches, dim):
            yield y - centre

    gram = _gram(rows, centred, kind, dim)
    if exact:
        rest = [s - n * int(m) for s, m in zip(sums, mean)]
        cov = np.array([[(n * int(gram[i, j]) - rest[i] * rest[j]) / n**2 for j in range(dim)] for i in range(dim)])
    else:
        cov = gram / n
    values, axes = leading_components(cov, min(components, dim))
    return Whitening(n, dim, [s + n * OFFSET for s in sums], span, float(np.trace(cov)), values, axes)


def _whitened(w: Whitening) -> Callable:
    """(place, whitened matrix, deviations) of each piece of rows."""
    low = [s - w.n * OFFSET for s in w.sums]
    whole = [s // w.n for s in low]
    base = np.array(whole, np.float64)
    part = np.array([(s - w.n * b) / w.n for s, b in zip(low, whole)])
    rest = [s - w.n * b for s, b in zip(low, whole)]
    kind = np.int64 if w.dim * (w.n * (w.span + 1)) ** 2 < 2**63 else object
    matrix = w.matrix

    def run(batches):
        for b, rows, y in _pieces(batches, w.dim):
            y = y - base
            gap = w.n * y.astype(np.int64).astype(kind) - np.array(rest, kind)
            yield b, rows, (y - part) @ matrix, (gap * gap).sum(axis=1)
    return run


def identity_error(vectors: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity;
    components without variance, whose values are all 0, don't count."""
    pieces = _whitened(w)

    def with_one(batches):
        for _, _, z, _ in pieces(batches):
            yield np.hstack([z, np.ones((len(z), 1))])

    k = len(w.values)
    gram = _gram(vectors.select("vec"), with_one, np.float64, k + 1) / w.n
    cov = gram[:k, :k] - np.outer(gram[:k, k], gram[:k, k])
    keep = ~w.flat
    gap = (cov - np.eye(k))[np.ix_(keep, keep)]
    return float(np.abs(gap).max()) if gap.size else 0.0


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row for each usable row and component: id, component (int, from 1 by falling
    variance), n (usable rows), deviation (decimal(38,0): the exact squared distance of
    n times the row from the sum of all rows), whitened, explained and identity_error.

    Rows whose vector is null, holds null or non-finite entries, or is not of the most
    frequent length are left out.  Repeated rows and null ids are rows like others.
    Components without variance have whitened and explained 0.  Fewer components if the
    vectors are shorter; no rows without usable vectors.  Other columns are ignored.
    The number of dimensions bounds what reaches the driver (its square) and what tasks
    are sent.
    """
    spark = embeddings.sparkSession
    df = columns(embeddings, id=id_col, vec=vec_col)
    kind = df.schema["id"].dataType
    ddl = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    w = fit(df, components)
    if w is None:
        return spark.createDataFrame([], f"`{id_col}` {kind.simpleString()}, {ddl}")
    error = identity_error(df, w)
    pieces, k, explained, n = _whitened(w), len(w.values), w.explained, w.n

    def run(batches):
        for b, rows, z, deviation in pieces(batches):
            m = len(rows)
            dev = pa.array([int(d) for d in deviation], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, np.int64)), dev.take(each), pa.array(z.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.mapInArrow(run, f"id {kind.simpleString()}, {ddl}").withColumnRenamed("id", id_col)


def op13(spark, sf_dir: str) -> DataFrame:
    """Contract query: all of ``embeddings``, 32 components; deviations beyond 64 bits are null."""
    out = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))
