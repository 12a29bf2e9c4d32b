"""The qd solver against numpy's SVD, and the whitened rows against a covariance matrix."""

import numpy as np
import pytest

from ledgerloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def matrices():
    rnd = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 40):
        yield rnd.normal(size=(d, d))
    yield np.diag([3.0, 3.0, 3.0, 1.0, 0.0])
    yield np.zeros((4, 4))
    yield rnd.normal(size=(30, 30)) @ np.diag(10.0 ** -np.arange(0, 15, 0.5))  # singular values from 1 to 1e-15
    q = np.linalg.qr(rnd.normal(size=(24, 24)))[0]
    yield q @ np.diag([5.0] * 10 + [5.0 + 1e-9] * 4 + [1.0] * 10) @ q.T  # clusters
    yield np.outer(rnd.normal(size=12), rnd.normal(size=12))  # rank one
    wide = rnd.normal(size=(20, 20))
    wide[:, 3] = 0
    wide[:, 9] = wide[:, 4]
    yield wide
    yield np.eye(21) + 1e-14 * rnd.normal(size=(21, 21))


@pytest.mark.parametrize("r", list(matrices()))
def test_values_and_directions(r):
    a, b, v = whitening.bidiagonal(r)
    d = len(r)
    got, directions, total = whitening.singular_directions(r, d)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    scale = max(want[0], 1e-300)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-13)
    assert total == pytest.approx((r * r).sum(), rel=1e-12)
    m = len(got)
    assert np.all(np.diff(got) <= 0) and np.allclose(got, want[:m], rtol=1e-11, atol=1e-14 * scale)
    assert (want[m:] <= 1e-25 * scale).all() if m < d else True
    assert np.allclose(directions.T @ directions, np.eye(m), atol=2e-11)
    assert np.allclose(r.T @ (r @ directions), directions * got, atol=1e-12 * scale)


def test_small_values_keep_their_digits():
    """Relative accuracy: a graded bidiagonal, against a product form known exactly."""
    q, e = [4.0**-i for i in range(40)], [4.0 ** -(i + 20) for i in range(39)]
    got = whitening.dqds(q, e)
    bigger = np.array(whitening.dqds([x * 2.0**300 for x in q], [x * 2.0**300 for x in e])) * 2.0**-300
    assert np.allclose(got, bigger, rtol=1e-13, atol=0)
    assert np.prod([g * 4.0**i for i, g in enumerate(got)]) == pytest.approx(1.0, rel=1e-12)  # the determinant


def plain(ids, vectors, limit=16):
    """{id: (deviation, whitened, explained, n)} by the covariance's eigenvectors."""
    x = [np.floor(np.array(v, np.float64) * 64).astype(np.int64) + 1_000_000 for v in vectors]
    fit = np.array(sorted({tuple(r.tolist()) for r in x}))
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    m = min(limit, int((e > e[0] * 1e-12).sum()))
    return {i: (sum(int(a) ** 2 for a in n * r - s), ((n * r - s) / n) @ v[:, :m] / np.sqrt(e[:m]), e[:m] / e.sum(), n) for i, r in zip(ids, x)}


def compare(rows, want):
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert by.keys() == want.keys()
    sign = None
    for i, (deviation, w, explained, n) in want.items():
        got = [by[i][c] for c in sorted(by[i])]
        assert [g.component for g in got] == list(range(1, len(w) + 1))
        assert all(g.deviation == deviation and g.n == n and g.identity_error <= 1e-9 for g in got)
        assert np.allclose([g.explained for g in got], explained, rtol=1e-9)
        mine = np.array([g.whitened for g in got])
        if sign is None and (np.abs(w) > 0.05).all():
            sign = np.sign(mine * w)
    assert sign is not None
    for i, (_, w, _, _) in want.items():
        assert np.allclose([by[i][c].whitened for c in sorted(by[i])] * sign, w, atol=1e-7)


def test_query_over_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    rows = queries.op12_whitening(spark, SF).collect()
    compare(rows, plain(table.vec_id.tolist(), table.embedding.tolist()))
    assert len({r.identity_error for r in rows}) == 1


@pytest.mark.parametrize("fan", [64, 2])
def test_odd_rows_and_many_factors(spark, fan, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", fan)
    rnd = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    good = [[float(a) for a in np.append(rnd.normal(size=5) * [9, 5, 3, 2, 1], 0.25)] for _ in range(80)]
    good += [good[3]] * 40 + [[a * 1e4 for a in good[5][:5]] + [0.25]]
    odd = [None, [], [nan] * 6, [inf, 1.0, 1.0, 1.0, 1.0, 1.0], [None, 1.0, 1.0, 1.0, 1.0, 1.0], [1.0, 2.0], [1e300] * 6, [-1e30, 0.0, 0.0, 0.0, 0.0, 0.0]]
    rows = [(i, v, 0, "x") for i, v in enumerate(good + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened string").repartition(7)
    got = whitening.component_rows(df, whitening.fit(df)).collect()
    compare(got, plain(range(len(good)), good))  # the sixth dimension is constant: five components
    assert max(r.component for r in got) == 5
    out = whitening.whiten(df, whitening.fit(df, limit=2), ["vec_id", "whitened"])
    assert out.count() == len(good) and len(out.first()[-1]) == 2
    repeated = whitening.component_rows(df.union(df), whitening.fit(df.union(df)))
    assert repeated.count() == 2 * len(got) and repeated.first().n == got[0].n


def test_tables_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, None)], "vec_id long, embedding array<double>")
    for some in (df, df.limit(0), df.where("vec_id is null"), df.limit(1)):
        assert whitening.component_rows(some, whitening.fit(some)).count() == 0
    big = spark.createDataFrame([(i, [i * 2.0**40, 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    rows = whitening.component_rows(big, whitening.fit(big)).collect()
    assert len(rows) == 9 and rows[0].deviation is None  # beyond a long
