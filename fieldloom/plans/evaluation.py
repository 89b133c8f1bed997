"""Metrics, curves and result tables, on plain score columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.operators import evaluate as E
from fieldloom.operators import split
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import PRICE, REVIEWS_SQL, reviews, split_sql

# The price stands for a prediction of the discounted price, and a scaled price for a second one.
_PRED = f"preds AS (SELECT l_returnflag, {PRICE} AS y, l_extendedprice AS p, l_extendedprice * 0.95 AS p2 FROM lineitem)"


def _predictions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.expr(PRICE).alias("y"), F.col("l_extendedprice").alias("p"), (F.col("l_extendedprice") * 0.95).alias("p2"))


def _regression_sql(p: str) -> str:
    return f"""round(1 - sum((y - {p}) * (y - {p})) / (var_pop(y) * count(y)), 6) AS r2, round(sqrt(avg((y - {p}) * (y - {p}))), 4) AS rmse,
 round(avg(abs(y - {p})), 4) AS mae"""


@query(f"WITH {_PRED} SELECT l_returnflag, {_regression_sql('p')} FROM preds GROUP BY l_returnflag")
def regression_metrics(spark, sf_dir):
    m = E.regression_metrics(_predictions(spark, sf_dir), "y", "p", ["l_returnflag"])
    return round_columns(round_columns(m, ["r2"]), ["rmse", "mae"], 4)


@query(f"""WITH {_PRED} SELECT round(avg(y - p), 4) AS mean, round(stddev_samp(y - p), 4) AS std, round(max(abs(y - p)), 4) AS max_abs,
 count(*) FILTER (abs(y - p) > 1000) AS n_large FROM preds""")
def residual_summary(spark, sf_dir):
    return round_columns(E.residual_summary(_predictions(spark, sf_dir), "y", "p", 1000.0), ["mean", "std", "max_abs"], 4)


@query(f"""WITH {_PRED} SELECT round(avg(abs(p2 - p)), 4) AS mean_change, round(max(abs(p2 - p)), 4) AS max_change,
 count(*) FILTER (abs(p2 - p) > 1000) AS n_large FROM preds""")
def prediction_change(spark, sf_dir):
    return round_columns(E.prediction_change(_predictions(spark, sf_dir), "p", "p2", 1000.0), ["mean_change", "max_change"], 4)


# Event value as score, purchase as the positive class; the score is rounded so that ties occur.
_SCORED = """scored AS (SELECT CASE WHEN event_type = 'purchase' THEN 'negative' ELSE 'positive' END AS actual, round("value") AS score,
 CASE WHEN "value" > 100 THEN 'negative' ELSE 'positive' END AS predicted FROM events)"""


def _scored(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "purchase", "negative").otherwise("positive").alias("actual"),
        F.round("value").alias("score"), F.when(F.col("value") > 100, "negative").otherwise("positive").alias("predicted"))


def _auc_sql(source: str, score: str = "score", name: str = "auc") -> str:
    return f"""{name}_r AS (SELECT actual, (rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0)::DOUBLE AS r FROM {source}),
{name} AS (SELECT (sum(r) FILTER (actual = 'negative') - count(*) FILTER (actual = 'negative') * (count(*) FILTER (actual = 'negative') + 1) / 2.0)
 / (count(*) FILTER (actual = 'negative') * count(*) FILTER (actual <> 'negative'))::DOUBLE AS auc FROM {name}_r)"""


_CELLS = """c AS (SELECT count(*) FILTER (actual = 'negative' AND predicted = 'negative')::DOUBLE AS tp,
 count(*) FILTER (actual <> 'negative' AND predicted = 'negative')::DOUBLE AS fp, count(*) FILTER (actual = 'negative' AND predicted <> 'negative')::DOUBLE AS fn,
 count(*) FILTER (actual <> 'negative' AND predicted <> 'negative')::DOUBLE AS tn FROM {source}),
m AS (SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
 coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
 coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0, (tp + fn) / (tp + fp + fn + tn) AS w1 FROM c)"""
_METRICS = """round(accuracy, 6) AS accuracy, round(p1, 6) AS "precision", round(r1, 6) AS recall, round(f1, 6) AS f1,
 round(p1 * w1 + p0 * (1 - w1), 6) AS weighted_precision, round(r1 * w1 + r0 * (1 - w1), 6) AS weighted_recall,
 round(f1 * w1 + f0 * (1 - w1), 6) AS weighted_f1, round(auc, 6) AS roc_auc"""
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "weighted_precision", "weighted_recall", "weighted_f1", "roc_auc"]


@query(f"WITH {_SCORED}, {_CELLS.format(source='scored')}, {_auc_sql('scored')} SELECT {_METRICS} FROM m, auc")
def classification_metrics(spark, sf_dir):
    return round_columns(E.classification_metrics(_scored(spark, sf_dir), "actual", "predicted", "score"), METRIC_NAMES)


@query(f"""WITH {_SCORED} SELECT a AS actual, count(*) FILTER (predicted = 'negative') AS predicted_negative,
 count(*) FILTER (predicted = 'positive') AS predicted_positive, count(*) FILTER (predicted = 'neutral') AS predicted_neutral
 FROM (SELECT unnest(['negative', 'positive', 'neutral']) AS a) LEFT JOIN scored ON a = actual GROUP BY a""")
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(_scored(spark, sf_dir), "actual", "predicted", ("negative", "positive", "neutral"))


@query(f"WITH {_SCORED}, {_auc_sql('scored')} SELECT round(auc, 8) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    df = _scored(spark, sf_dir).withColumn("pos", F.col("actual") == "negative")
    return round_columns(E.roc_auc(df, "pos", "score"), ["roc_auc"], 8)


@query(f"""WITH {_SCORED}, t AS (SELECT score, count(*) FILTER (actual = 'negative') AS p, count(*) FILTER (actual <> 'negative') AS n FROM scored GROUP BY score)
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT score, round((sum(n) OVER w / sum(n) OVER ())::DOUBLE, 6), round((sum(p) OVER w / sum(p) OVER ())::DOUBLE, 6) FROM t
 WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""")
def roc_curve(spark, sf_dir):
    df = _scored(spark, sf_dir).withColumn("pos", F.col("actual") == "negative")
    return round_columns(E.roc_curve(df, "pos", "score"), ["fpr", "tpr"])


@query(f"""WITH {_SCORED}, h AS (SELECT actual, (predicted = 'negative')::INT AS score FROM scored), {_auc_sql('scored')}, {_auc_sql('h', name='hard')}
SELECT 'score' AS source, round(auc, 6) AS roc_auc FROM auc UNION ALL SELECT 'label', round(auc, 6) FROM hard""")
def hard_label_auc(spark, sf_dir):
    return round_columns(E.hard_label_auc(_scored(spark, sf_dir), "actual", "predicted", "score"), ["roc_auc"])


@query(f"""WITH {REVIEWS_SQL}, {split_sql('reviews', 'label')},
maj AS (SELECT label AS g FROM split_rows WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
guess AS (SELECT label AS actual, g AS predicted, (g = 'negative')::DOUBLE AS score FROM split_rows, maj WHERE split = 'test'),
{_CELLS.format(source='guess')}, {_auc_sql('guess')} SELECT g AS majority_class, {_METRICS} FROM m, auc, maj""")
def majority_baseline(spark, sf_dir):
    df = split.train_test_split(reviews(spark, sf_dir), "id", "label")
    return round_columns(E.majority_baseline(df.where(F.col("split") == "train"), df.where(F.col("split") == "test"), "label"), METRIC_NAMES)


def _three_results(spark, sf_dir):
    df = _predictions(spark, sf_dir).select("y", F.inline(F.array(
        F.struct(F.lit("price").alias("model"), F.col("p").alias("p")), F.struct(F.lit("reduced price").alias("model"), F.col("p2").alias("p")),
        F.struct(F.lit("same price").alias("model"), F.col("p").alias("p")))))
    return E.regression_metrics(df, "y", "p", ["model"])


_THREE = f"""{_PRED}, three AS (SELECT 'price' AS model, {_regression_sql('p')} FROM preds UNION ALL SELECT 'reduced price', {_regression_sql('p2')} FROM preds
 UNION ALL SELECT 'same price', {_regression_sql('p')} FROM preds)"""


@query(f"WITH {_THREE} SELECT row_number() OVER (ORDER BY r2 DESC, model) AS rank, * FROM three")
def comparison_table(spark, sf_dir):
    results = round_columns(round_columns(_three_results(spark, sf_dir), ["r2"]), ["rmse", "mae"], 4)
    return E.comparison_table(results, "r2")


@query(f"""WITH {_THREE}, b AS (SELECT * FROM three WHERE model = 'price'), l AS (
 SELECT 'reduced price' AS model, 'r2' AS metric, b.r2 AS before, a.r2 AS after, true AS up FROM b, three a WHERE a.model = 'reduced price'
 UNION ALL SELECT 'reduced price', 'rmse', b.rmse, a.rmse, false FROM b, three a WHERE a.model = 'reduced price'
 UNION ALL SELECT 'same price', 'mae', b.mae, a.mae, false FROM b, three a WHERE a.model = 'same price')
SELECT model, metric, before, after, round(after - before, 4) + 0.0 AS change, CASE WHEN after = before THEN 'no change'
 WHEN (after > before) = up THEN 'yes' ELSE 'no' END AS improved FROM l""")
def before_after(spark, sf_dir):
    results = round_columns(round_columns(_three_results(spark, sf_dir), ["r2"]), ["rmse", "mae"], 4)
    long = results.unpivot("model", ["r2", "rmse", "mae"], "metric", "after")
    base = long.where(F.col("model") == "price").select("metric", F.col("after").alias("before"))
    wanted = (F.struct("model", "metric")).isin(
        F.struct(F.lit("reduced price"), F.lit("r2")), F.struct(F.lit("reduced price"), F.lit("rmse")), F.struct(F.lit("same price"), F.lit("mae")))
    rows = long.join(base, "metric").where(wanted).withColumn("higher_is_better", F.col("metric") == "r2")
    return E.before_after(rows).withColumn("change", rounded("change", 4))


@query(f"""WITH {_PRED}, m AS (SELECT l_returnflag, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae FROM preds GROUP BY 1),
l AS (UNPIVOT m ON rmse, mae INTO NAME metric VALUE v)
SELECT count(*) FILTER (metric IS NULL) AS n_unmatched, round(max(abs(round(v, 1) - v)), 4) AS max_difference FROM l""")
def recompute_check(spark, sf_dir):
    """Metrics as a report shows them, with one digit, against the same metrics computed again from the rows."""
    metrics = E.regression_metrics(_predictions(spark, sf_dir), "y", "p", ["l_returnflag"]).unpivot("l_returnflag", ["rmse", "mae"], "metric", "value")
    return round_columns(E.largest_difference(round_columns(metrics, ["value"], 1), metrics, ["l_returnflag", "metric"]), ["max_difference"], 4)


@query("SELECT round(avg((\"value\" / 500 < 0.01 OR \"value\" / 500 > 0.99)::INT), 6) AS share_extreme FROM events")
def extreme_probability(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("p", F.col("value") / 500)
    return round_columns(E.extreme_probability_share(df, "p"), ["share_extreme"])
