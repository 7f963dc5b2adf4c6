import math

import numpy as np
import pytest

from loomsift.llm import queries, whitening


def brute(rows, components=4):
    """The digest by the definition, in numpy over all rows at once."""
    keep = [(i, [math.floor(256 * float(c)) + 0 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in keep})
    n, x = len(distinct), np.array(distinct, float)
    s = [sum(c) for c in zip(*distinct, strict=True)]
    y = x - np.array(s) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = []
    for i, r in keep:
        deviation = sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True))
        w = (np.array(r) - np.array(s) / n) @ q / np.sqrt(e)
        out += [(i, k + 1, n, deviation, w[k], e[k] / np.trace(v)) for k in range(len(e))]
    return out


def same(got, want):
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-12)
    for k in {r[1] for r in want}:
        a, b = (np.array([r[4] for r in rows if r[1] == k]) for rows in (got, want))
        sign = np.sign(a @ b)
        assert np.abs(sign * a - b).max() < 1e-9


def digested(df):
    return sorted(tuple(r) for r in whitening.digest(df, whitening.fit(df)).collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_query_equals_the_definition(spark):
    got = sorted(tuple(r) for r in queries.op11_whitening(spark, "/root/testdata/sf0.001").collect())
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    same(got, sorted(brute([tuple(r) for r in rows])))
    assert {r[6] for r in got} == {got[0][6]} and got[0][6] < 1e-10


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    good = [(k, r.normal(size=6).tolist()) for k in range(60)]
    odd = [(100, None), (101, []), (102, [None] * 6), (103, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (104, [float("nan")] * 6), (105, [float("inf")] * 6), (106, [-0.0] * 6), (107, [0.0] * 6), (108, good[3][1]), (3, good[3][1])]
    df = vectors(spark, good + odd)
    rows = [tuple(x) for x in df.collect()]
    same(digested(df), sorted(brute(rows)))
    same(digested(vectors(spark, [*rows, (200, [1.0] * 5), (201, [9.0] * 7)])), sorted(brute(rows)))  # lengths of few vectors take no part


def test_copies_count_once(spark):
    r = np.random.default_rng(4)
    good = [(k, r.normal(size=5).tolist()) for k in range(40)]
    got = digested(vectors(spark, good + [(7, good[7][1])] * 500))
    assert len(got) == 540 * 4 and {x[2] for x in got} == {40}
    same(got, sorted(brute([tuple(x) for x in vectors(spark, good + [(7, good[7][1])] * 500).collect()])))


def test_fewer_components(spark):
    assert digested(vectors(spark, [])) == []
    assert digested(vectors(spark, [(1, None), (2, [])])) == []
    assert digested(vectors(spark, [(1, [1.0, 2.0])] * 3)) == []  # one vector has no variance
    one = digested(vectors(spark, [(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0]), (None, [2.0, 2.0, 0.0])][:2]))
    assert [(r[0], r[1], r[2], abs(r[4])) for r in one] == [(1, 1, 2, 1.0), (2, 1, 2, 1.0)]


def test_wide_entries_stay_exact(spark):
    rows = [(k, [float(2**27) * k, -float(2**26) * k * k, 0.5 * k]) for k in range(4)] + [(9, [0.0, 0.0, 1.0])]
    got = digested(vectors(spark, rows))
    assert {(r[0], r[3]) for r in got} == {(r[0], r[3] if r[3] < 2**63 else None) for r in brute(rows, 1)}
    with pytest.raises(Exception, match="beyond"):
        digested(vectors(spark, [(1, [1e30, 1.0]), (2, [0.0, 0.0])]))


def test_transform_keeps_rows_and_columns(spark):
    df = vectors(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.5]), (3, None), (4, [0.0, 7.0]), (5, [1.0])]).selectExpr("'x' as whitened", "*", "vec_id as component", "1 as x", "2 as dims", "3 as k")
    model = whitening.fit(df)
    rows = whitening.transform(df, model).collect()
    assert [r.vec_id for r in rows if r.whitened is None] == [3, 5] and [r.component for r in rows] == [1, 2, 3, 4, 5]
    w = np.array([r.whitened for r in rows if r.whitened is not None])
    assert np.allclose(w.T @ w / 3, np.eye(2), atol=1e-9)
    assert {r.whitened for r in whitening.transform(df, None).collect()} == {None}
    assert len(digested(df)) == 6


@pytest.mark.parametrize("seed", range(8))
def test_principal_is_the_eigenbasis(seed):
    r = np.random.default_rng(seed)
    m = [1, 2, 3, 8, 40, 64, 100, 128][seed]
    q = np.linalg.qr(r.normal(size=(m, m)))[0]
    e = [np.arange(1, m + 1.0), 10.0 ** -np.arange(m), np.r_[np.ones(m - 1), 5.0], r.normal(size=m) ** 2][seed % 4]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    got, v = whitening.principal(a)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][: min(4, m)]
    want = want[want > m * whitening.EPS * np.linalg.norm(a)]
    assert np.allclose(got, want, rtol=0, atol=1e-13 * np.linalg.norm(a) * m)
    assert np.abs(v.T @ v - np.eye(len(got))).max() < 1e-13
    assert np.linalg.norm(a @ v - v * got) < 1e-13 * np.linalg.norm(a) * m


def test_polar_factor_has_the_signs():
    r = np.random.default_rng(1)
    q = np.linalg.qr(r.normal(size=(30, 30)))[0]
    e = np.r_[np.linspace(-3, -1e-9, 12), np.linspace(1e-12, 5, 18)]
    assert np.abs(whitening.polar((q * e) @ q.T) - (q * np.sign(e)) @ q.T).max() < 1e-3  # the least one is near rounding
    e = np.r_[np.linspace(-3, -0.1, 12), np.linspace(0.2, 5, 18)]
    assert np.abs(whitening.polar((q * e) @ q.T) - (q * np.sign(e)) @ q.T).max() < 1e-13


def test_equal_eigenvalues_and_none():
    e, v = whitening.principal(np.eye(7) * 3)
    assert np.allclose(e, 3) and np.allclose(v.T @ v, np.eye(4))
    assert whitening.principal(np.zeros((5, 5)))[0].size == 0
