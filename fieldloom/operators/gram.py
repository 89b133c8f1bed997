"""Least squares from sums of products.

One aggregate over the rows gives, per fold, every sum of products of the features
and the target. Coefficients, regularisation paths, cross-validation, validation
curves and grid searches of the linear models follow from these few numbers, because
training on k-1 folds means adding k-1 of the sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FEATURES = 1_000

# Up to this many products one generated aggregate is fastest; wider tables multiply blocks of rows.
MAX_SUM_COLUMNS = 60


@dataclass
class Gram:
    """Sums of products over [1, x1..xp, y]; additive over disjoint sets of rows.

    Values are shifted by ``shift`` (rough means) before multiplying, which keeps the
    sums well conditioned.
    """

    features: list[str]
    target: str
    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.features, self.target, self.products + other.products, self.shift)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.features, self.target, self.products - other.products, self.shift)

    def only(self, features: Sequence[str]) -> Gram:
        """The sums of some of the features, over the same rows."""
        places = [0, *[1 + self.features.index(f) for f in features], len(self.features) + 1]
        return Gram(list(features), self.target, self.products[np.ix_(places, places)], self.shift[[p - 1 for p in places[1:]]])

    @property
    def n(self) -> float:
        return float(self.products[0, 0])

    def means(self) -> np.ndarray:
        return self.products[0, 1:] / self.n

    def covariance(self) -> np.ndarray:
        """Population covariance of [x1..xp, y]."""
        m = self.means()
        return self.products[1:, 1:] / self.n - np.outer(m, m)


def grams(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None) -> dict:
    """One ``Gram`` per fold (key None without folds); rows with a missing value are left out."""
    features = list(features)
    names = [*features, target]
    if len(features) > MAX_FEATURES:
        raise ValueError(f"{len(features)} features; sums of products are meant for at most {MAX_FEATURES}")
    data = df.select(*([fold] if fold else []), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    data = data.dropna(subset=[f"v{i}" for i in range(len(names))])
    centre = data.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(names))]).first()
    shift = np.array([centre[f"m{i}"] or 0.0 for i in range(len(names))])
    size = len(names) + 1
    result = {}
    if size * (size + 1) // 2 > MAX_SUM_COLUMNS:
        for row in _block_sums(data, fold, shift).collect():  # folds x size^2 numbers
            products = result.setdefault(row["fold"], np.zeros(size * size))
            products[row["pos"]] = row["total"]
        return {f: Gram(features, target, p.reshape(size, size), shift) for f, p in result.items()}
    terms: list[Column] = [F.lit(1.0)] + [F.col(f"v{i}") - F.lit(float(shift[i])) for i in range(len(names))]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = [F.sum(terms[i] * terms[j]).alias(f"s{i}_{j}") for i, j in pairs]
    grouped = data.groupBy(fold).agg(*sums) if fold else data.agg(*sums)
    for row in grouped.collect():  # one row per fold
        products = np.zeros((size, size))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"s{i}_{j}"] or 0.0
        result[row[fold] if fold else None] = Gram(features, target, products, shift)
    return result


def _block_sums(data: DataFrame, fold: str | None, shift: np.ndarray) -> DataFrame:
    """(fold, pos, total): each task multiplies its batches and passes on one matrix per fold."""
    columns = [f"v{i}" for i in range(len(shift))]
    rows = data.select((F.col(fold) if fold else F.lit(None)).cast("int").alias("fold"), *columns)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for frame in batches:
            for key, part in frame.groupby("fold", dropna=False):
                x = np.column_stack([np.ones(len(part)), part[columns].to_numpy() - shift])
                key = None if pd.isna(key) else int(key)
                sums[key] = sums.get(key, 0.0) + x.T @ x
        for key, m in sums.items():
            yield pd.DataFrame({"fold": pd.array([key], dtype="Int32"), "products": [m.ravel()]})

    parts = rows.mapInPandas(multiply, "fold int, products array<double>")
    return parts.select("fold", F.posexplode("products").alias("pos", "value")).groupBy("fold", "pos").agg(F.sum("value").alias("total"))


@dataclass
class LinearFit:
    """Coefficients per original unit, with the scale that was used while fitting."""

    features: list[str]
    intercept: float
    coefficients: np.ndarray
    scale: np.ndarray

    def predict(self) -> Column:
        value = F.lit(float(self.intercept))
        for name, b in zip(self.features, self.coefficients):
            value = value + F.lit(float(b)) * F.col(name)
        return value


def coefficient_table(spark: SparkSession, model: LinearFit) -> DataFrame:
    """Coefficients per standard deviation and per original unit, and the intercept."""
    rows = [(n, float(c * s), float(c)) for n, c, s in zip(model.features, model.coefficients, model.scale)]
    rows.append(("(intercept)", float(model.intercept), float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, per_std double, per_unit double")


def fit(gram: Gram, alpha: float = 0.0, l1_ratio: float = 0.0, scale: bool = True, lasso_form: bool | None = None) -> LinearFit:
    """Ordinary, ridge, lasso or elastic-net least squares.

    Ridge minimises |y - Xw|^2 + alpha |w|^2; with ``l1_ratio`` > 0 (or ``lasso_form``)
    the loss is |y - Xw|^2 / 2n + alpha l1_ratio |w|_1 + alpha (1 - l1_ratio) |w|^2 / 2.
    ``scale`` standardises the features by their population deviation first.
    """
    cov = gram.covariance()
    p = len(gram.features)
    spread = np.sqrt(np.clip(np.diag(cov)[:p], 0, None))
    s = np.where(spread > 0, spread, 1.0) if scale else np.ones(p)
    a = cov[:p, :p] / np.outer(s, s)
    b = cov[:p, p] / s
    if lasso_form if lasso_form is not None else l1_ratio > 0:
        from fieldloom.operators.homotopy import solve

        w = solve(a, b, alpha * l1_ratio, alpha * (1 - l1_ratio))[0]
    elif alpha > 0:
        w = np.linalg.solve(a + np.eye(p) * alpha / gram.n, b)
    else:
        w = np.linalg.lstsq(a, b, rcond=None)[0]
    coefficients = w / s
    means = gram.means() + gram.shift
    return LinearFit(gram.features, float(means[p] - coefficients @ means[:p]), coefficients, s)


def _coordinate_descent(a: np.ndarray, b: np.ndarray, l1: float, l2: float, tol: float = 1e-10, limit: int = 100_000):
    w = np.zeros(len(b))
    for _ in range(limit):
        moved = 0.0
        for j in range(len(b)):
            if a[j, j] == 0:
                continue
            rest = b[j] - a[j] @ w + a[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (a[j, j] + l2)
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= tol * max(1.0, float(np.abs(w).max())):
            return w
    raise RuntimeError(f"coordinate descent did not settle in {limit} rounds")


def score(gram: Gram, model: LinearFit) -> dict[str, float]:
    """R2 and RMSE of a fit on the rows behind ``gram``, without touching the rows."""
    p = len(gram.features)
    beta = np.concatenate([
        [model.intercept - (gram.shift[p] - model.coefficients @ gram.shift[:p])], model.coefficients, [-1.0]])
    sse = float(beta @ gram.products @ beta)
    cov = gram.covariance()
    total = float(cov[p, p] * gram.n)
    return {"r2": 1 - sse / total if total > 0 else float("nan"), "rmse": float(np.sqrt(max(sse, 0.0) / gram.n))}


def r2_from_others(gram: Gram, position: int) -> float:
    """R2 of one feature explained by the remaining features."""
    cov = gram.covariance()[: len(gram.features), : len(gram.features)]
    rest = [i for i in range(len(gram.features)) if i != position]
    if not rest or cov[position, position] <= 0:
        return 0.0
    w = np.linalg.lstsq(cov[np.ix_(rest, rest)], cov[rest, position], rcond=None)[0]
    return float(cov[rest, position] @ w / cov[position, position])
