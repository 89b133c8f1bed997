"""Cross-validation, curves, grid search, nomination and summaries.

Linear models are tuned from sums of products (``gram``): one pass over the rows serves
every fold and every candidate. Other models are fitted per fold and candidate, side by
side. What is learned to prepare features is learned from a fold's training rows alone,
once per fold, and shared by all candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import gram as G
from fieldloom.operators.evaluate import regression_aggregates
from fieldloom.operators.features import require_training_rows
from fieldloom.operators.trees import fit_trees, predictions
from fieldloom.session import materialise

# A fit takes training rows and returns a function that adds predictions to a frame.
Fit = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]
Score = Callable[[DataFrame], DataFrame]
# Learns from training rows and returns what prepares any rows, like ``lambda rows: estimator.fit(rows).transform``.
Prepare = Fit

# The search spaces; each holds its model's baseline setting.
REGRESSION_SPACES = {
    "ridge": {"alpha": [float(a) for a in np.logspace(-3, 3, 25)]},
    "lasso": {"alpha": [float(a) for a in np.logspace(-4, 1, 26)]},
    "elastic_net": {"alpha": [float(a) for a in np.logspace(-4, 0, 9)], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9, 1.0]},
    "polynomial": {"degree": [1, 2, 3], "interaction_only": [False, True]},
    "tree": {"max_depth": [3, 5, 7, 8, 9, 10, 12, 15, None], "min_leaf": [1, 5, 10, 20, 40]},
    "forest": {"trees": [100, 200, 400], "max_depth": [None, 10, 15], "min_leaf": [1, 3, 5, 10]},
    "boosting": {"learning_rate": [0.03, 0.05, 0.1, 0.2], "trees": [100, 200, 400], "max_depth": [2, 3, 4], "subsample": [0.8, 1.0]},
    "svr": {"kernel": ["linear", "rbf"], "C": [0.3, 1.0, 3.0, 10.0, 30.0], "gamma": ["scale", 0.01, 0.03, 0.1]},
    "knn": {"k": [3, 5, 7, 10, 15, 20, 30], "weights": ["uniform", "distance"], "p": [1, 2]},
}
CLASSIFICATION_SPACES = {
    "logistic": {"C": [0.1, 0.3, 1.0, 3.0, 10.0, 30.0], "class_weight": [None, "balanced"]},
    "knn": {"k": [3, 5, 7, 11, 15, 21, 31], "weights": ["uniform", "distance"]},
    "gaussian_nb": {"var_smoothing": [float(v) for v in np.logspace(-9, -1, 9)]},
    "tree": {"max_depth": [5, 10, 20, 40, None], "min_leaf": [1, 2, 5, 10], "class_weight": [None, "balanced"]},
    "svc": {"kernel": ["linear", "rbf"], "C": [0.3, 1.0, 3.0, 10.0], "class_weight": [None, "balanced"]},
}
RIDGE_PATH = [float(a) for a in np.logspace(-2, 5, 29)]
LASSO_PATH = [float(a) for a in np.logspace(-3, 1.5, 28)]

SCORES = "model string, params map<string,string>, fold int, metric string, value double, train_value double"


def candidates(space: Mapping[str, Sequence]) -> list[dict]:
    """Every combination, the last parameter varying fastest."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def _texts(params: Mapping) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


# ---------------------------------------------------------------- linear models: one pass

def fold_grams(train: DataFrame, features: Sequence[str], target: str, fold: str = "fold", split: str | None = "split") -> dict:
    require_training_rows(train, split)
    return G.grams(train, features, target, fold)


def _fit_linear(gram: G.Gram, kind: str, params: Mapping) -> G.LinearFit:
    if kind == "elastic_net":
        return G.fit(gram, params.get("alpha", 1.0), params.get("l1_ratio", 0.5), lasso_form=True)
    if kind == "lasso":
        return G.fit(gram, params.get("alpha", 1.0), 1.0, lasso_form=True)
    return G.fit(gram, params.get("alpha", 1.0) if kind == "ridge" else 0.0)


def linear_scores(spark: SparkSession, grams: Mapping, kind: str, settings: Sequence[Mapping], train_scores: bool = False) -> DataFrame:
    """R2 and RMSE per candidate and fold from the fold sums alone; scaling is refitted per fold."""
    total = sum_grams(grams.values())
    rows = []
    for params in settings:
        for f, held_out in sorted(grams.items()):
            train = total - held_out
            model = _fit_linear(train, kind, params)
            test, own = G.score(held_out, model), G.score(train, model) if train_scores else {}
            rows += [(kind, _texts(params), f, m, v, own.get(m)) for m, v in test.items()]
    return spark.createDataFrame(rows, SCORES)


def sum_grams(grams) -> G.Gram:
    result = None
    for g in grams:
        result = g if result is None else result + g
    return result


def linear_fold_errors(train: DataFrame, grams: Mapping, kind: str, params: Mapping, target: str, fold: str = "fold") -> DataFrame:
    """R2, RMSE and MAE per fold of one setting: each row is scored by the fit that did not see it."""
    total = sum_grams(grams.values())
    predicted = F.lit(None).cast("double")
    for f, held_out in grams.items():
        predicted = F.when(F.col(fold) == f, _fit_linear(total - held_out, kind, params).predict()).otherwise(predicted)
    return train.withColumn("_p", predicted).groupBy(fold).agg(*regression_aggregates(target, "_p"))


def path(spark: SparkSession, gram: G.Gram, kind: str, alphas: Sequence[float]) -> DataFrame:
    """Coefficients along a regularisation path, long form, with the number of zero ones."""
    rows = []
    for a in alphas:
        w = _fit_linear(gram, kind, {"alpha": a})
        per_std = w.coefficients * w.scale
        zero = int((np.abs(per_std) < 1e-12).sum())
        rows += [(a, n, float(c), zero) for n, c in zip(w.features, per_std)]
    return spark.createDataFrame(rows, "alpha double, feature string, coefficient double, n_zero long")


# ---------------------------------------------------------------- any model: one fit per fold

def cross_validate(
    train: DataFrame, models: Mapping[str, Fit], score: Score, fold: str = "fold", params: Mapping[str, Mapping] | None = None,
    parallelism: int = 4, train_scores: bool = False, prepare: Prepare | None = None, split: str | None = "split",
) -> DataFrame:
    """Long table of scores per model and fold. ``score`` turns predictions into one row of metrics.

    Only training rows are accepted: no test row can take part in a choice. ``prepare`` is
    fitted on each fold's training rows and applied to both sides, which are stored once
    for all models of the fold.
    """
    require_training_rows(train, split)
    spark = train.sparkSession
    folds = [r[0] for r in train.select(fold).distinct().orderBy(fold).collect()]

    def sides(f):
        own, held_out = train.where(F.col(fold) != f), train.where(F.col(fold) == f)
        if prepare is None:
            return own, held_out
        ready = prepare(own)
        return materialise(ready(own)), materialise(ready(held_out))

    def one(task):
        name, f = task
        own, held_out = parts[f]
        predict = models[name](own)
        found = score(predict(held_out)).first().asDict()
        seen = score(predict(own)).first().asDict() if train_scores else {}
        return [(name, _texts((params or {}).get(name, {})), f, m, None if v is None else float(v), seen.get(m)) for m, v in found.items()]

    with ThreadPoolExecutor(parallelism) as pool:
        parts = dict(zip(folds, pool.map(sides, folds)))
        rows = [r for part in pool.map(one, [(m, f) for m in models for f in folds]) for r in part]
    return spark.createDataFrame(rows, SCORES)


def grid_search(
    train: DataFrame, name: str, make: Callable[[dict], Fit], space: Mapping[str, Sequence], score: Score, metric: str,
    fold: str = "fold", parallelism: int = 4, prepare: Prepare | None = None, split: str | None = "split",
) -> tuple[DataFrame, dict, Callable[[DataFrame], DataFrame]]:
    """All candidates by mean fold score, the best setting (the first of equals), and its refit on all training rows.

    With ``prepare`` the refit learns the preparation again from all training rows and takes raw rows.
    """
    settings = candidates(space)
    keys = [f"{name} {i}" for i in range(len(settings))]
    scores = cross_validate(train, {k: make(s) for k, s in zip(keys, settings)}, score, fold,
                            dict(zip(keys, settings)), parallelism, prepare=prepare, split=split)
    table = ranked_candidates(scores, metric)
    best = settings[int(table.orderBy("rank").first()["model"].rsplit(" ", 1)[1])]
    if prepare is None:
        return table, best, make(best)(train)
    ready = prepare(train)
    predict = make(best)(materialise(ready(train)))
    return table, best, lambda df: predict(ready(df))


# ---------------------------------------------------------------- trees: one fit serves many candidates

def tree_scores(train: DataFrame, name: str, space: Mapping[str, Sequence], target: str, fold: str = "fold", prepare: Prepare | None = None,
                bootstrap: bool = False, parallelism: int = 4, split: str | None = "split", key: str = "id") -> DataFrame:
    """R2 and RMSE of every candidate (trees, max_depth, min_leaf) and fold, from one fit for each fold and ``min_leaf``.

    The trees are grown to the largest depth asked for, as many as the largest forest has; a smaller depth is the same tree cut
    there, a smaller forest its first trees, so the scores equal those of separate fits.
    """
    require_training_rows(train, split)
    settings, depths = candidates(space), list(space.get("max_depth", [None]))
    prefixes = list(space.get("trees", [1]))
    deepest = None if None in depths else max(depths)
    folds = [r[0] for r in train.select(fold).distinct().orderBy(fold).collect()]

    def side_of(f):
        own, held_out = train.where(F.col(fold) != f), train.where(F.col(fold) == f)
        if prepare is None:
            return own, held_out
        ready = prepare(own)
        return materialise(ready(own)), materialise(ready(held_out))

    def one(task):
        f, least = task
        own, held_out = sides[f]
        nodes = fit_trees(own, target, trees=max(prefixes), max_depth=deepest, min_leaf=least, bootstrap=bootstrap, key=key, split=split)
        scored = predictions(held_out, nodes, prefixes=prefixes, depths=depths)
        lines = F.array(*[F.struct(*[a.alias(n) for n, a in zip(("r2", "rmse"), _errors(F.col("predictions")[i], target))]) for i in range(len(depths) * len(prefixes))])
        found = scored.agg(lines.alias("lines")).first()["lines"]
        return {(depths[i // len(prefixes)], prefixes[i % len(prefixes)], least): line for i, line in enumerate(found)}, f

    with ThreadPoolExecutor(parallelism) as pool:
        sides = dict(zip(folds, pool.map(side_of, folds)))
        parts = list(pool.map(one, [(f, least) for f in folds for least in space.get("min_leaf", [1])]))
    rows = []
    for found, f in parts:
        for number, s in enumerate(settings):
            line = found.get((s.get("max_depth"), s.get("trees", 1), s.get("min_leaf", 1)))
            rows += [(f"{name} {number}", _texts(s), f, m, line[m], None) for m in ("r2", "rmse")] if line else []
    return train.sparkSession.createDataFrame(rows, SCORES)


def _errors(predicted, target: str):
    error = (F.col(target) - predicted) * (F.col(target) - predicted)
    return 1 - F.sum(error) / (F.var_pop(target) * F.count(target)), F.sqrt(F.avg(error))


# ---------------------------------------------------------------- tables

def summarise(scores: DataFrame) -> DataFrame:
    """Mean and population deviation over the folds per model, setting and metric."""
    keys = ["model", F.to_json("params").alias("setting"), "metric"]
    return scores.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.avg("train_value").alias("train_mean"),
        F.first("params").alias("params"))


def ranked_candidates(scores: DataFrame, metric: str) -> DataFrame:
    """One row per candidate, best mean first; equal means keep the grid order."""
    from pyspark.sql import Window as W

    number = F.try_element_at(F.split("model", " "), F.lit(-1)).try_cast("int")
    table = summarise(scores.where(F.col("metric") == metric)).withColumn("_grid", number)
    return table.withColumn("rank", F.row_number().over(W.orderBy(F.col("mean").desc_nulls_last(), "_grid", "model", "setting")).cast("long")).drop("_grid")


def grid_pivot(scores: DataFrame, metric: str, row: str, column: str) -> DataFrame:
    """Mean score with one parameter down and one across."""
    name = F.concat(F.lit(f"{column}="), F.translate(F.col("params")[column], ".", "_"))
    values = scores.where(F.col("metric") == metric).select(F.col("params")[row].alias(row), name.alias(column), "value")
    return values.groupBy(row).pivot(column).agg(F.avg("value"))


def nominate(cv: DataFrame, same: Sequence[tuple[str, str]], tunable: Sequence[str], metric: str, n: int = 2) -> DataFrame:
    """The n best models by CV that can be tuned and repeat no better-placed model.

    ``same`` lists pairs of models with equal training predictions, see ``same_functions``.
    """
    from pyspark.sql import Window as W

    spark = cv.sparkSession
    order = W.orderBy(F.round("mean", 12).desc(), "model")  # a row per model
    placed = summarise(cv.where(F.col("metric") == metric)).select("model", F.row_number().over(order).cast("long").alias("cv_rank"))
    pairs = spark.createDataFrame([p for a, b in same for p in ((a, b), (b, a))], "model string, other string")
    above = placed.select(F.col("model").alias("other"), F.col("cv_rank").alias("other_rank"))
    twins = (
        pairs.join(above, "other").join(placed, "model").where(F.col("other_rank") < F.col("cv_rank"))
        .groupBy("model").agg(F.min_by("other", "other_rank").alias("twin")))
    judged = placed.join(twins, "model", "left").select("cv_rank", "model", F.col("model").isin(*tunable).alias("tunable"), "twin")
    status = F.when(~F.col("tunable"), "nothing to tune").when(F.col("twin").isNotNull(), F.concat(F.lit("repeats "), "twin")).otherwise("eligible")
    judged = judged.withColumn("status", status)
    eligible = F.count_if(F.col("status") == "eligible").over(W.orderBy("cv_rank"))
    return judged.select("cv_rank", "model", "tunable", "status", ((F.col("status") == "eligible") & (eligible <= n)).alias("nominated"))


def same_functions(predictions: DataFrame, models: Sequence[str], tolerance: float = 1e-8) -> list[tuple[str, str]]:
    """Pairs of prediction columns that never differ by more than ``tolerance``; one aggregate."""
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i + 1:]]
    if not pairs:
        return []
    row = predictions.agg(*[F.max(F.abs(F.col(a) - F.col(b))).alias(f"d{i}") for i, (a, b) in enumerate(pairs)]).first()
    return [p for i, p in enumerate(pairs) if row[f"d{i}"] is not None and row[f"d{i}"] <= tolerance]


def tuning_summary(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    """(model, setting, mean, std) before and after with the change of the mean."""
    b = baseline.select("model", F.col("setting").alias("baseline_setting"), F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    t = tuned.select("model", F.col("setting").alias("tuned_setting"), F.col("mean").alias("tuned_mean"), F.col("std").alias("tuned_std"))
    return b.join(t, "model").withColumn("change", F.col("tuned_mean") - F.col("baseline_mean"))


def rank_agreement(cv: DataFrame, test: DataFrame, cv_metric: str, test_metric: str) -> DataFrame:
    """CV rank and test rank of each model side by side."""
    from fieldloom.operators.order import ranked

    a = ranked(cv.select("model", cv_metric), cv_metric, "model", "cv_rank")
    b = ranked(test.select("model", test_metric), test_metric, "model", "test_rank")
    return a.join(b, "model").withColumn("agrees", F.col("cv_rank") == F.col("test_rank"))
