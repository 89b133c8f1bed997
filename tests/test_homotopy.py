"""Homotopy against optimality conditions, coordinate descent and closed forms."""

import numpy as np
import pytest

from fieldloom.operators import gram, homotopy, tune


def problem(rng, p, twins=False, rows=40):
    x = rng.normal(size=(rows, p))
    if p > 2:
        x[:, 1] = x[:, 0] * 0.98 + x[:, 1] * 0.05
    if twins and p > 3:
        x[:, 3] = x[:, 2]
    y = x @ rng.normal(size=p) + rng.normal(size=rows)
    x = (x - x.mean(0)) / x.std(0)
    return x.T @ x / rows, x.T @ (y - y.mean()) / rows


@pytest.mark.parametrize("seed", range(20))
def test_solutions_meet_the_optimality_conditions(seed):
    rng = np.random.default_rng(seed)
    a, b = problem(rng, int(rng.integers(1, 9)), twins=seed % 2 == 0)
    for l1 in (0.0, 0.003, 0.05, 0.4, 9.0):
        for l2 in (0.0, 0.2):
            w, knots = homotopy.solve(a, b, l1, l2)
            assert homotopy.violation(a, b, w, l1, l2) < 1e-9
            falling = [k.penalty for k in knots]
            assert falling == sorted(falling, reverse=True) and all(p >= l1 for p in falling)
            active = set()
            for k in knots:  # a feature comes in before it goes out, and every knot is a solution itself
                (active.add if k.enters else active.remove)(k.feature)
                assert homotopy.violation(a, b, k.w, k.penalty, l2) < 1e-8
            assert {j for j in range(len(b)) if w[j] != 0} <= active


def test_solutions_equal_coordinate_descent_and_closed_forms():
    rng = np.random.default_rng(0)
    a, b = problem(rng, 6)
    for l1, l2 in ((0.01, 0.0), (0.1, 0.3), (0.0, 1.0)):
        assert homotopy.solve(a, b, l1, l2)[0] == pytest.approx(gram._coordinate_descent(a, b, l1, l2), abs=1e-6)
    assert homotopy.solve(a, b, 0.0, 2.0)[0] == pytest.approx(np.linalg.solve(a + 2 * np.eye(6), b))
    assert homotopy.solve(np.eye(3), np.array([3.0, -2.0, 0.5]), 1.0)[0] == pytest.approx([2.0, -1.0, 0.0])
    assert homotopy.solve(np.zeros((2, 2)), np.zeros(2), 0.0)[0].tolist() == [0.0, 0.0]


def test_knots_and_certificates_as_tables(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    data = [(i % 5 + 1, "train", *map(float, r), float(r[0] * 5 - r[1] + rng.normal())) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "fold int, split string, a double, b double, c double, y double")
    grams = tune.fold_grams(df, ["a", "b", "c"], "y")
    knots = homotopy.lasso_knots(spark, tune.sum_grams(grams.values()), 0.0).orderBy("step").collect()
    assert [k.feature for k in knots][:2] == ["a", "b"] and all(k.enters for k in knots) and knots[0].penalty > knots[1].penalty
    found = homotopy.certificates(spark, grams, [(0.1, 1.0), (0.1, 0.5), (100.0, 1.0)]).collect()
    assert len(found) == 15 and max(r.violation for r in found) < 1e-9
    assert {r.n_active for r in found if r.alpha == 100.0} == {0}
