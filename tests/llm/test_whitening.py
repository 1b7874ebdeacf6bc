import math

import numpy as np
import pytest

from noema.llm import whitening as W

VECS = "vec_id bigint, embedding array<float>, n string, component int"


def brute_force(rows, k=32):
    """(id, component) -> (n, deviation, |whitened|, explained) by another eigen-solver."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in ok]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    centred = np.array([[(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    z = centred @ q / np.sqrt(e)
    return [(i, c + 1, n, sum((n * r[j] - s[j]) ** 2 for j in range(d)), abs(z[m, c]), e[c] / np.trace(cov))
            for m, ((i, _), r) in enumerate(zip(ok, x)) for c in range(len(e))]


def corpus(n=300, d=12):
    g = np.random.default_rng(1)
    x = g.standard_normal((n, d)) * np.linspace(3, 0.5, d) @ np.linalg.qr(g.standard_normal((d, d)))[0]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(3, rows[3][1]), (None, rows[4][1])]
    bad = [(900, None), (901, [None] * d), (902, [float("nan")] * d), (903, [float("inf")] + [0.0] * (d - 1)), (904, [])]
    return rows, bad


def same(got, want):
    got = sorted(((r.vec_id, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in got), key=repr)
    want = sorted(want, key=repr)
    key = lambda r: (repr(r[0]), r[1], r[4])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-8, abs=1e-9)


def test_same_as_brute_force(spark):
    rows, bad = corpus()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], VECS).repartition(4)
    got = W.whiten(df).collect()
    same(got, brute_force(rows))
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-9
    # one sign for all rows: the columns are uncorrelated
    z = np.array([[r.whitened for r in sorted(got, key=lambda r: r.component) if r.vec_id == i and i > 4] for i in range(5, 300)])
    assert np.abs(z.T @ z / len(z) - np.eye(12)).max() < 0.2


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_divide_and_conquer_same_as_another_solver(d):
    g = np.random.default_rng(d)
    for values in (g.random(d) + 0.1, 10.0 ** -np.arange(d).clip(0, 14), np.ones(d), np.r_[np.full(d // 2, 2.0), np.ones(d - d // 2)],
                   np.r_[np.zeros(d - 1), 5.0]):
        q = np.linalg.qr(g.standard_normal((d, d)))[0]
        v = q * values @ q.T
        v = (v + v.T) / 2
        e, u = W.leading_components(v, d)
        assert e == pytest.approx(np.sort(np.linalg.eigvalsh(v))[::-1], abs=1e-13 * max(values) * d)
        assert np.abs(u.T @ u - np.eye(d)).max() < 1e-13 * d
        assert np.abs(v @ u - u * e).max() < 1e-13 * d * max(values)


def test_polar_factor_is_orthogonal_and_the_sign():
    g = np.random.default_rng(0)
    a = g.standard_normal((20, 20))
    a = a + a.T
    u = W.polar(a)
    e, q = np.linalg.eigh(a)
    assert np.abs(u - q * np.sign(e) @ q.T).max() < 1e-12
    assert np.abs(u @ u - np.eye(20)).max() < 1e-13


def test_part_of_the_components_only():
    g = np.random.default_rng(5)
    a = g.standard_normal((30, 200))
    a = a @ a.T / 200
    e, u = W.leading_components(a, 4)
    assert e == pytest.approx(np.linalg.eigvalsh(a)[::-1][:4], rel=1e-12) and u.shape == (30, 4)


def test_constant_dimensions_single_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "", 0)], VECS)
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in W.whiten(df).collect()] == [
        (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame([(i, [float(i), 7.0], "", 0) for i in range(5)], VECS)
    got = {(r.vec_id, r.component): r for r in W.whiten(df).collect()}
    assert [round(abs(got[i, 1].whitened), 12) for i in range(5)] == [round(abs(i - 2) / 2**0.5, 12) for i in range(5)]
    assert {got[i, 2].whitened for i in range(5)} == {0.0} and got[0, 1].identity_error < 1e-12
    for rows in ([], [(1, None, "", 0)], [(1, [None], "", 0)], [(1, [], "", 0)]):
        out = W.whiten(spark.createDataFrame(rows, VECS))
        assert out.count() == 0 and out.columns[0] == "vec_id"


def test_large_entries_and_deviations_beyond_64_bits(spark):
    rows = [(i, [float(i * 2.0**30), 1.0]) for i in range(4)]
    got = W.whiten(spark.createDataFrame([(i, v, "", 0) for i, v in rows], VECS)).collect()
    want = brute_force(rows, 1)
    assert {(r.vec_id, int(r.deviation)) for r in got} == {(i, d) for i, _, _, d, _, _ in want}
    huge = W.whiten(spark.createDataFrame([(i, [1e38 * i, 0.0], "", 0) for i in range(3)], VECS)).collect()
    assert len(huge) == 6 and all(math.isfinite(r.whitened) for r in huge)


def test_query_at_sf(spark):
    d = "/root/testdata/sf0.01"
    out = W.op13(spark, d)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    got = out.collect()
    same(got, brute_force(rows))
    assert got[0].identity_error < 1e-9
