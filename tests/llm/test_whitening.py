"""Whitening against a dense eigensolver and exact fractions."""

from fractions import Fraction

import numpy as np
import pytest

from giftlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("spectrum", [np.linspace(5, 1, 40), np.r_[[9.0] * 3, [4.0] * 10, np.linspace(1, 0.9, 30)],
                                      np.r_[1e6, 1.0, 1e-3, np.zeros(5)], [2.0], [3.0, 3.0], np.r_[[1.0] * 50]])
def test_contours_find_every_eigenpair(spectrum):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    v = (q * spectrum) @ q.T
    v = (v + v.T) / 2
    e, x = W.principal(v)
    want = np.sort(np.asarray(spectrum))[::-1][:32]
    want = want[want > 1e-12 * np.sum(spectrum)]
    assert np.allclose(e, want, rtol=1e-9, atol=1e-12 * want[0])
    assert np.allclose(v @ x, x * e, atol=1e-10 * want[0])
    assert np.allclose(x.T @ x, np.eye(len(e)), atol=1e-10)


def test_inertia_counts():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a += a.T
    e = np.linalg.eigvalsh(a)
    count = W.Inertia(a)
    for s in np.linspace(e[0] - 1, e[-1] + 1, 50):
        assert count.above(s) == (e > s).sum()


def test_rows_against_plain_eigenvectors(spark):
    rng = np.random.default_rng(7)
    x = (rng.standard_normal((300, 40)) * np.linspace(2, 0.2, 40)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (5, x[5].tolist())]
    bad = [(900, None), (901, []), (902, [None] + x[0].tolist()[1:]), (903, [float("nan")] + x[0].tolist()[1:]),
           (904, [float("inf")] + x[0].tolist()[1:]), (905, [1.0, 2.0]), (906, [3e38] + x[0].tolist()[1:])]
    out = W.whiten(table(spark, rows + bad)).collect()
    kept = np.array([v for _, v in rows], np.float64)
    whole = np.floor(64 * kept).astype(np.int64) + 1_000_000
    n, s = len(whole), whole.sum(axis=0)
    centred = whole - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:32], q[:, ::-1][:, :32]
    assert len(out) == n * 32 and {r.n for r in out} == {n}
    deviation = [int(((n * w.astype(object) - s.astype(object)) ** 2).sum()) for w in whole]
    want = centred @ q / np.sqrt(e)
    got, dev = {}, {}
    for r in out:
        got.setdefault((r.vec_id, r.component), []).append(r.whitened)
        dev.setdefault(r.vec_id, set()).add(r.deviation)
    assert {i: {deviation[i]} for i in range(300)} == {i: dev[i] for i in range(300)} and dev[None] == {deviation[0]}
    sign = {}
    for k in range(32):
        sign[k] = np.sign(want[0, k] * got[(0, k + 1)][0])
    for i in range(300):
        for k in range(32):
            assert all(abs(g * sign[k] - want[i, k]) < 1e-8 for g in got[(i, k + 1)])
    assert len(got[(5, 1)]) == 2
    share = {r.component: r.explained for r in out}
    assert np.allclose([share[k + 1] for k in range(32)], e / np.trace(v), rtol=1e-10)
    assert {r.identity_error for r in out}.pop() < 1e-9


def test_sums_are_exact_for_large_entries(spark):
    rows = [(1, [1e12, 1.0]), (2, [-1e12, 2.0]), (3, [5.0, 4.0])]
    w = W.fit(table(spark, rows))
    f = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    mean = [Fraction(sum(r[i] for r in f), 3) for i in range(2)]
    trace = sum((r[i] - mean[i]) ** 2 for r in f for i in range(2)) / 3
    assert w.total == tuple(sum(r[i] for r in f) for i in range(2)) and w.trace == pytest.approx(float(trace), rel=1e-15)
    assert {r.deviation for r in W.whiten(table(spark, rows)).collect()} == {
        None if (x := sum((3 * a - s) ** 2 for a, s in zip(r, w.total))) >= 2**63 else x for r in f}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert W.whiten(table(spark, rows)).collect() == []


def test_fewer_components_than_entries(spark):
    rows = [(1, [0.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0])]
    out = W.whiten(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.explained) for r in out) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
