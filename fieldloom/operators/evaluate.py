"""Exact metrics as aggregates, ranked tables, before/after and recompute checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.scalars import CLASS_LABELS, POS_LABEL
from fieldloom.operators.order import running_totals


# ---------------------------------------------------------------- regression

def regression_aggregates(actual: str | Column, predicted: str | Column) -> list[Column]:
    """R2, RMSE and MAE in target units; the variance is accumulated centred."""
    y = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    y, p = y.cast("double"), p.cast("double")
    error = y - p
    total = F.var_pop(y) * F.count(y)
    return [
        F.when(total > 0, 1 - F.sum(error * error) / total).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*regression_aggregates(actual, predicted))


def residual_summary(df: DataFrame, actual: str, predicted: str, large: float = 5.0) -> DataFrame:
    r = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"), F.max(F.abs(r)).alias("max_abs"),
                  F.count_if(F.abs(r) > large).alias("n_large"))


def prediction_change(df: DataFrame, before: str, after: str, large: float = 1.0) -> DataFrame:
    d = F.abs(F.col(after) - F.col(before))
    return df.agg(F.avg(d).alias("mean_change"), F.max(d).alias("max_change"), F.count_if(d > large).alias("n_large"))


# ---------------------------------------------------------------- classification

#: What a fitted classifier may leave, best first: the column, and which entry (by positive class) times which sign is the score.
SCORE_COLUMNS = (("probability", {0: (0, 1.0), 1: (1, 1.0)}), ("rawPrediction", {0: (1, -1.0), 1: (1, 1.0)}))


def positive_scores(df: DataFrame, positive_index: int = 1) -> tuple[DataFrame, str]:
    """Add ``score``, higher where class ``positive_index`` is likelier, and name the column it was read from."""
    found = [(column, turns[positive_index]) for column, turns in SCORE_COLUMNS if column in df.columns]
    if not found:
        raise ValueError(f"none of {[c for c, _ in SCORE_COLUMNS]} among the columns {df.columns}")
    column, (entry, sign) = found[0]
    return df.withColumn("score", F.lit(sign) * vector_to_array(column)[entry]), column


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str] = CLASS_LABELS, by: Sequence[str] = ()
) -> DataFrame:
    """One row per actual class in fixed order, one column per predicted class, zeros included."""
    counts = df.groupBy(*by).agg(*[
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"{i}_{j}")
        for i, a in enumerate(labels) for j, p in enumerate(labels)])
    return counts.select(*by, F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), *[F.col(f"{i}_{j}").alias(f"predicted_{p}") for j, p in enumerate(labels)])
        for i, a in enumerate(labels)])))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_metrics(
    df: DataFrame, actual: str, predicted: str, score: str | None = None, pos_label: str = POS_LABEL, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision/recall/F1 of the positive class and weighted over both, ROC-AUC of the score."""
    pos, said = F.col(actual) == pos_label, F.col(predicted) == pos_label
    cells = df.groupBy(*by).agg(
        F.count_if(pos & said).alias("tp"), F.count_if(~pos & said).alias("fp"),
        F.count_if(pos & ~said).alias("fn"), F.count_if(~pos & ~said).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    one = {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn)}
    other = {"precision": _ratio(tn, tn + fn), "recall": _ratio(tn, tn + fp), "f1": _ratio(2 * tn, 2 * tn + fp + fn)}
    result = cells.select(
        *by, _ratio(tp + tn, n).alias("accuracy"), *[one[m].alias(m) for m in one],
        *[((one[m] * (tp + fn) + other[m] * (tn + fp)) / n).alias(f"weighted_{m}") for m in one])
    if score is None:
        return result
    auc = roc_auc(df.withColumn("_pos", pos), "_pos", score, by)
    if not by:
        return result.withColumn("roc_auc", auc.select("roc_auc").scalar())
    return result.join(auc, list(by), "left")


def score_totals(df: DataFrame, is_positive: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: tied scores are one row from here on."""
    return df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~F.col(is_positive)).alias("neg"))


def roc_auc(df: DataFrame, is_positive: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve: pairs ranked rightly, ties counted half."""
    totals = running_totals(score_totals(df, is_positive, score, by), "score", ["neg"], by)
    return totals.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)).alias("_good"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
    ).select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_good") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def roc_curve(df: DataFrame, is_positive: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, falling, plus the origin with a NULL threshold."""
    totals = score_totals(df, is_positive, score)
    sums = totals.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    points = running_totals(totals, "score", ["pos", "neg"], descending=True).select(
        F.col("score").alias("threshold"), ((F.col("neg_before") + F.col("neg")) / sums["n"]).alias("fpr"),
        ((F.col("pos_before") + F.col("pos")) / sums["p"]).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(points)


def majority_baseline(train: DataFrame, test: DataFrame, label: str, pos_label: str = POS_LABEL) -> DataFrame:
    """Metrics of always predicting the most frequent training class with a constant score."""
    row = (
        train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), label).first())
    guess = test.withColumns({"_guess": F.lit(row[label]), "_score": F.lit(1.0 if row[label] == pos_label else 0.0)})
    return classification_metrics(guess, label, "_guess", "_score", pos_label).select(
        F.lit(row[label]).alias("majority_class"), "*")


def extreme_probability_share(df: DataFrame, probability: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    p = F.col(probability)
    return df.agg(F.avg(((p < low) | (p > high)).cast("int")).alias("share_extreme"))


# ---------------------------------------------------------------- result tables

def comparison_table(results: DataFrame, metric: str, model: str = "model") -> DataFrame:
    """Ranked by one metric, best first; a result table has one row per model."""
    return results.select(
        F.row_number().over(W.orderBy(F.col(metric).desc_nulls_last(), F.col(model))).cast("long").alias("rank"), *results.columns)


def before_after(rows: DataFrame) -> DataFrame:
    """The move of each (model, metric), and which way it went: the gain is the change, turned where less is better."""
    gain = F.signum(F.col("after") - F.col("before")) * F.when(F.col("higher_is_better"), 1).otherwise(-1)
    verdict = F.element_at(F.array(*map(F.lit, ("no", "no change", "yes"))), (gain + 2).cast("int"))  # fixed values
    return rows.withColumns({"change": F.col("after") - F.col("before"), "improved": verdict}).drop("higher_is_better")


def largest_difference(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Rows missing on either side and the largest absolute difference of the rest."""
    a = stored.select(*keys, F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    b = recomputed.select(*keys, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    both = a.join(b, list(keys), "full_outer")
    return both.agg(
        F.count_if(F.col("_in_a").isNull() | F.col("_in_b").isNull()).alias("n_unmatched"),
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_difference"))


def hard_label_auc(df: DataFrame, actual: str, predicted: str, score: str, pos_label: str = POS_LABEL) -> DataFrame:
    """AUC from scores next to AUC from predicted labels, which is the wrong way."""
    sides = df.select((F.col(actual) == pos_label).alias("_pos"), F.inline(F.array(
        F.struct(F.lit("score").alias("source"), F.col(score).cast("double").alias("s")),
        F.struct(F.lit("label").alias("source"), (F.col(predicted) == pos_label).cast("double").alias("s")))))
    return roc_auc(sides, "_pos", "s", ["source"])


def class_recall(df: DataFrame, actual: str, predicted: str, label: str) -> DataFrame:
    """Recall of one chosen class, as a scorer for cross-validation and grids."""
    hit = F.count_if((F.col(actual) == label) & (F.col(predicted) == label))
    return df.agg(_ratio(hit.cast("double"), F.count_if(F.col(actual) == label).cast("double")).alias("recall"))


def test_results(fitted: Mapping[str, object], test: DataFrame, line: Callable[[DataFrame], DataFrame], metric: str) -> DataFrame:
    """One ranked row per fitted model: ``line`` turns its predictions on the test rows into one row of metrics."""
    rows = None
    for name, model in fitted.items():
        own = line(model.transform(test)).select(F.lit(name).alias("model"), "*")
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    return comparison_table(rows, metric)
