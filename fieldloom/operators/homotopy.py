"""Lasso and elastic-net solutions from sums of products, exact along the whole path.

As the absolute penalty falls from where all coefficients are zero, the solution moves on straight lines between knots, at
which a feature comes in or goes out. The knots are found one after the other, so a solution is that of a linear system
and needs no tolerance. The squared penalty only adds to the diagonal. (Osborne, Presnell and Turlach, A New Approach to
Variable Selection in Least Squares Problems, 2000.)

Everything here works on p x p numbers of the driver; the rows are read once, by ``gram``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators import gram as G


@dataclass
class Knot:
    """At ``penalty`` the ``feature`` came in or went out, at the solution ``w``."""

    penalty: float
    feature: int
    enters: bool
    w: np.ndarray


def solve(a: np.ndarray, b: np.ndarray, l1: float, l2: float = 0.0) -> tuple[np.ndarray, list[Knot]]:
    """w that minimises w'Aw / 2 - b'w + l1 |w|_1 + l2 |w|^2 / 2, and the knots above ``l1``.

    A feature that depends linearly on active ones never comes in: another solution of the same value is without it.
    """
    p = len(b)
    a = a + l2 * np.eye(p)
    w, knots = np.zeros(p), []
    usable = np.diag(a) > 1e-14
    if not usable.any() or np.abs(b[usable]).max() <= l1:
        return w, knots
    tiny = 1e-12 * np.abs(b).max()
    first = int(np.argmax(np.where(usable, np.abs(b), -1.0)))
    penalty, active, signs = abs(b[first]), [first], {first: np.sign(b[first])}
    knots.append(Knot(float(penalty), first, True, w.copy()))
    just_left, left_sign, barred = None, 0.0, ~usable
    while True:
        d = np.linalg.solve(a[np.ix_(active, active)], np.array([signs[j] for j in active]))
        c, pull = b - a @ w, a[:, active] @ d
        step, event = penalty - l1, None
        for j in range(p):
            if j in signs or barred[j]:
                continue
            for sign in (1.0, -1.0):  # its correlation meets the penalty from this side
                if j == just_left and sign == left_sign:
                    continue
                room, closing = penalty - sign * c[j], 1.0 - sign * pull[j]
                if closing > 1e-14 and room / closing < step - tiny:
                    step, event = max(room / closing, 0.0), (j, sign)
        for i, j in enumerate(active):
            if d[i] * w[j] < 0 and -w[j] / d[i] < step - tiny:
                step, event = -w[j] / d[i], (j, 0.0)
        w[active] += step * d
        penalty -= step
        if event is None:
            return w, knots
        j, sign = event
        if sign:
            trial = [*active, j]
            if np.linalg.cond(a[np.ix_(trial, trial)]) > 1e12:
                barred[j] = True
                continue
            active, signs[j], just_left = trial, sign, None
        else:
            active.remove(j)
            w[j], left_sign, just_left = 0.0, signs.pop(j), j
            barred = ~usable  # what depended on it may be free now
            if not active:
                return w, knots
        knots.append(Knot(float(penalty), j, bool(sign), w.copy()))


def violation(a: np.ndarray, b: np.ndarray, w: np.ndarray, l1: float, l2: float = 0.0) -> float:
    """Largest breach of the optimality conditions: |gradient| is at most l1, and -l1 times the sign at non-zero coefficients."""
    gradient = a @ w + l2 * w - b
    return float(np.where(w == 0, np.maximum(np.abs(gradient) - l1, 0.0), np.abs(gradient + l1 * np.sign(w))).max(initial=0.0))


def standard_form(gram: G.Gram) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Correlations of the features, covariances of the standardised features with the target, and the deviations."""
    cov, p = gram.covariance(), len(gram.features)
    spread = np.sqrt(np.clip(np.diag(cov)[:p], 0, None))
    s = np.where(spread > 0, spread, 1.0)
    return cov[:p, :p] / np.outer(s, s), cov[:p, p] / s, s


def lasso_knots(spark: SparkSession, gram: G.Gram, least: float) -> DataFrame:
    """(step, penalty, feature, enters) from the first feature down to the penalty ``least``."""
    a, b, _ = standard_form(gram)
    knots = solve(a, b, least)[1]
    return spark.createDataFrame([(i + 1, k.penalty, gram.features[k.feature], k.enters) for i, k in enumerate(knots)],
                                 "step int, penalty double, feature string, enters boolean")


def certificates(spark: SparkSession, grams: dict, settings: Sequence[tuple[float, float]]) -> DataFrame:
    """(fold, alpha, l1_ratio, n_active, objective, violation) of every setting on the rows outside each fold.

    ``objective`` and ``violation`` are those of the standardised problem, the target in its own unit.
    """
    total, rows = None, []
    for g in grams.values():
        total = g if total is None else total + g
    for fold, held_out in sorted(grams.items()):
        train = total - held_out
        a, b, _ = standard_form(train)
        variance = train.covariance()[-1, -1]
        for alpha, ratio in settings:
            l1, l2 = alpha * ratio, alpha * (1 - ratio)
            w, _ = solve(a, b, l1, l2)
            objective = variance / 2 + w @ a @ w / 2 - b @ w + l1 * np.abs(w).sum() + l2 * (w @ w) / 2
            rows.append((fold, alpha, ratio, int((w != 0).sum()), float(objective), violation(a, b, w, l1, l2)))
    return spark.createDataFrame(rows, "fold int, alpha double, l1_ratio double, n_active int, objective double, violation double")
