import math

import numpy as np
import pytest

from ledgerferry.llm import whitening as W

KIND = "vec_id long, embedding array<float>, label int, id string, component string, n int"


def table(spark, vectors, ids=None, kind=KIND):
    rows = [(i if ids is None else ids[i], v, 1, "x", "y", 2) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, kind)


def whole(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def reference(x):
    n, a = len(x), np.array(x, float)
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[(n * v - s) / n for v, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return e[::-1], u[:, ::-1], centred, deviation, np.trace(cov), a


def test_equals_a_dense_solver(spark):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((40, 40))
    vectors = (rng.standard_normal((300, 40)) @ mix).astype(np.float32).tolist()
    rows = W.whiten(table(spark, vectors)).collect()
    e, u, centred, deviation, trace, _ = reference(whole(vectors))
    assert len(rows) == 300 * 32 and {r["n"] for r in rows} == {300}
    expected = centred @ u[:, :32] / np.sqrt(e[:32])
    got = np.zeros((300, 32))
    for r in rows:
        got[r["id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[r["id"]]
        assert abs(r["explained"] / (e[r["component"] - 1] / trace) - 1) < 1e-10
        assert r["identity_error"] < 1e-9
    sign = np.sign((got * expected).sum(0))
    assert np.abs(got * sign - expected).max() < 1e-8  # one sign for all rows of a component


def test_rows_that_take_no_part_and_clashing_columns(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.0, 0.0], [0.0, 0.0], [-2.5, 0.25]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, float("-inf")]]
    rows = W.whiten(table(spark, good + bad, [0, 1, 2, 2, None, 5, 6, 7, 8, 9, 10])).collect()
    assert sorted(((r["id"] is not None, r["id"] or 0), r["component"]) for r in rows) == sorted(((i is not None, i or 0), c) for i in (0, 1, 2, 2, None) for c in (1, 2))
    e, _, _, deviation, trace, _ = reference(whole(good))
    assert {r["n"] for r in rows} == {5}
    assert sorted(r["deviation"] for r in rows) == sorted(deviation * 2)
    assert {round(r["explained"], 9) for r in rows} == {round(x / trace, 9) for x in e}


def test_no_components_without_spread(spark):
    assert W.whiten(table(spark, [])).collect() == []
    assert W.whiten(table(spark, [[1.0, 2.0]])).collect() == []
    assert W.whiten(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    rows = W.whiten(table(spark, [[1.0, 2.0, 3.0], [2.0, 4.0, 3.0], [3.0, 6.0, 3.0]])).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 3  # rank one


def test_dimensions_are_fitted_apart(spark):
    rows = W.whiten(table(spark, [[1.0], [3.0], [1.0, 0.0], [0.0, 5.0], [2.0, 2.0]])).collect()
    assert {(r["id"], r["n"]) for r in rows} == {(0, 2), (1, 2), (2, 3), (3, 3), (4, 3)}
    assert sorted(abs(round(r["whitened"], 9)) for r in rows if r["n"] == 2) == [1.0, 1.0]


def test_numbers_of_extreme_size(spark):
    rows = W.whiten(table(spark, [[1e300, 1.0], [-1e300, 2.0], [5.0, 3.0]], kind=KIND.replace("float", "double"))).collect()
    assert {r["id"]: r["deviation"] for r in rows} == {0: None, 1: None, 2: 640**2 + 192**2}
    assert all(np.isfinite(r["whitened"]) for r in rows)
    x = np.array([[W.HUGE + W.OFFSET], [-W.HUGE + W.OFFSET]])
    fit = W.Fit(2, [2 * W.OFFSET])
    assert fit.deviation(x) == [None, None] and np.allclose(fit.centred(x), [[W.HUGE], [-W.HUGE]])


def test_deviations_are_exact_where_doubles_are_not():
    fit = W.Fit(3, [3_000_001, 2_999_998])
    x = np.array([[40_000_000 * 7, 1], [1_000_000, 999_999]])
    assert fit.deviation(x) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, fit.total, strict=True)) for row in x]
    wide = W.Fit(10**6, [10**12])
    for far, fits in ((2_000, True), (3_000, True), (4_000, False)):  # 4e18, 9e18 and 16e18
        y = np.array([[10**6 + far]])
        assert wide.deviation(y) == [(10**6 * far) ** 2 if fits else None]


@pytest.mark.parametrize("spectrum", [np.arange(1, 41), np.r_[[5.0] * 20, [3.0] * 5, np.linspace(2, 1, 15)], 2.0 ** -np.arange(24), np.ones(33), np.r_[np.ones(3), np.zeros(20)]])
def test_contour_integration_finds_all(spectrum):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))
    a = q @ np.diag(spectrum) @ q.T
    e, u = W.components((a + a.T) / 2, 32)
    wanted = np.sort(spectrum)[::-1][:32]
    wanted = wanted[wanted > W.RANK * spectrum.sum()]
    assert np.allclose(e, wanted, rtol=1e-7, atol=0) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)
    assert np.abs(a @ u - u * e).max() < 1e-13 * spectrum.max() * len(spectrum)


def test_inertia_counts():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    e = np.linalg.eigvalsh(a)
    shifts = np.linspace(e[0] - 1, e[-1] + 1, 200)
    assert W.inertia(*W.three_diagonals(a), shifts).tolist() == [(e < s).sum() for s in shifts]


def test_a_block_too_small_for_its_interval_grows():
    a = np.diag(np.r_[np.linspace(1, 2, 40), 9.0])
    low, high = 0.5, 2.5
    assert W.feast(a, low, high, 40).shape == (41, 40)
    with pytest.raises(ArithmeticError):
        W.feast(a, low, high, 39)
