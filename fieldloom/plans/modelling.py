"""Models on the order lines, the embeddings and the labelled texts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.operators import bayes, evaluate, features, gram, knn, models, sparse_knn, split, tfidf, trees, tune
from fieldloom.plans.evaluation import METRIC_NAMES
from fieldloom.plans.preparation import SPLIT_SQL
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import split_lines, split_sql
from fieldloom.plans.text import CAP, WEIGHTS_SQL, split_reviews, weights_sql
from fieldloom.session import materialise

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_linestatus", "l_returnflag"]


def side(df, name):
    return df.where(F.col("split") == name)


def _regression(df, name="model"):
    return round_columns(round_columns(df, ["r2"]), ["rmse", "mae"], 4)


# ---------------------------------------------------------------- least squares, two features

_STATS = f"""{SPLIT_SQL}, t AS (SELECT l_extendedprice AS a, l_discount AS b, y FROM split_rows WHERE split = 'train'),
s AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab,
 covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM t)"""
_OLS = f"""{_STATS}, w AS (SELECT (ay * vb - by_ * ab) / (va * vb - ab * ab) AS wa, (by_ * va - ay * ab) / (va * vb - ab * ab) AS wb, * FROM s),
fit AS (SELECT wa, wb, my - wa * ma - wb * mb AS w0, sqrt(va) AS sa, sqrt(vb) AS sb FROM w)"""
_RIDGE = f"""{_STATS}, z AS (SELECT *, ab / sqrt(va * vb) AS r, ay / sqrt(va) AS ra, by_ / sqrt(vb) AS rb, 1 + 1.0::DOUBLE / n AS d FROM s),
fit AS (SELECT (ra * d - rb * r) / (d * d - r * r) / sqrt(va) AS wa, (rb * d - ra * r) / (d * d - r * r) / sqrt(vb) AS wb,
 my - (ra * d - rb * r) / (d * d - r * r) / sqrt(va) * ma - (rb * d - ra * r) / (d * d - r * r) / sqrt(vb) * mb AS w0, sqrt(va) AS sa, sqrt(vb) AS sb FROM z)"""
_SCORE = """p AS (SELECT y, w0 + wa * l_extendedprice + wb * l_discount AS p FROM split_rows, fit WHERE split = 'test')
SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
 round(avg(abs(y - p)), 4) AS mae FROM p"""


def _two_feature_fit(spark, sf_dir, **settings):
    df = split_lines(spark, sf_dir)
    found = gram.grams(side(df, "train"), ["l_extendedprice", "l_discount"], "y")[None]
    return df, gram.fit(found, **settings)


@query(f"WITH {_OLS}, {_SCORE}")
def ols(spark, sf_dir):
    df, fit = _two_feature_fit(spark, sf_dir)
    return _regression(evaluate.regression_metrics(side(df, "test").withColumn("p", fit.predict()), "y", "p"))


@query(f"WITH {_RIDGE}, {_SCORE}")
def ridge(spark, sf_dir):
    df, fit = _two_feature_fit(spark, sf_dir, alpha=1.0)
    return _regression(evaluate.regression_metrics(side(df, "test").withColumn("p", fit.predict()), "y", "p"))


@query(f"""WITH {_OLS} SELECT 'l_extendedprice' AS feature, round(wa * sa, 4) AS per_std, round(wa, 6) AS per_unit FROM fit
UNION ALL SELECT 'l_discount', round(wb * sb, 4), round(wb, 4) FROM fit
UNION ALL SELECT '(intercept)', round(w0, 4), round(w0, 4) FROM fit""")
def coef_table(spark, sf_dir):
    _, fit = _two_feature_fit(spark, sf_dir)
    table_ = gram.coefficient_table(spark, fit)
    return table_.select("feature", rounded("per_std", 4).alias("per_std"), F.when(
        F.col("feature") == "l_extendedprice", rounded("per_unit")).otherwise(rounded("per_unit", 4)).alias("per_unit"))


@query(f"""WITH {_STATS}, al AS (SELECT power(10, -2 + i * 7 / 28.0::DOUBLE) AS alpha FROM range(29) t(i)),
z AS (SELECT *, ab / sqrt(va * vb) AS r, ay / sqrt(va) AS ra, by_ / sqrt(vb) AS rb, 1 + alpha / n AS d FROM s, al)
SELECT round(alpha, 6) AS alpha, 'l_extendedprice' AS feature, round((ra * d - rb * r) / (d * d - r * r), 4) AS coefficient, CAST(0 AS BIGINT) AS n_zero FROM z
UNION ALL SELECT round(alpha, 6), 'l_discount', round((rb * d - ra * r) / (d * d - r * r), 4), CAST(0 AS BIGINT) FROM z""")
def ridge_path(spark, sf_dir):
    train = side(split_lines(spark, sf_dir), "train")
    found = gram.grams(train, ["l_extendedprice", "l_discount"], "y")[None]
    return round_columns(round_columns(tune.path(spark, found, "ridge", tune.RIDGE_PATH), ["alpha"]), ["coefficient"], 4)


# Two standardised features of correlation r: both active with the signs of their own solution, or one, or none.
@query(f"""WITH {_STATS}, z AS (SELECT ab / sqrt(va * vb) AS r, ay / sqrt(va) AS a, by_ / sqrt(vb) AS b FROM s),
al AS (SELECT power(10, -3 + i * 4.5 / 27.0::DOUBLE) AS alpha FROM range(28) t(i)), sg AS (SELECT x.v AS sa, y.v AS sb FROM (VALUES (-1), (1)) x(v), (VALUES (-1), (1)) y(v)),
both_ AS (SELECT alpha, ((a - alpha * sa) - r * (b - alpha * sb)) / (1 - r * r) AS wa, ((b - alpha * sb) - r * (a - alpha * sa)) / (1 - r * r) AS wb, sa, sb FROM z, al, sg),
ok AS (SELECT alpha, wa, wb FROM both_ WHERE wa * sa > 0 AND wb * sb > 0),
one AS (SELECT alpha, sign(a) * greatest(abs(a) - alpha, 0) AS wa, sign(b) * greatest(abs(b) - alpha, 0) AS wb, r, a, b FROM z, al),
w AS (SELECT alpha, CASE WHEN ok.alpha IS NOT NULL THEN ok.wa WHEN abs(b - r * one.wa) <= alpha THEN one.wa ELSE 0 END AS wa,
 CASE WHEN ok.alpha IS NOT NULL THEN ok.wb WHEN abs(b - r * one.wa) <= alpha THEN 0 ELSE one.wb END AS wb FROM one LEFT JOIN ok USING (alpha)),
n AS (SELECT *, CAST((abs(wa) < 1e-12)::INT + (abs(wb) < 1e-12)::INT AS BIGINT) AS n_zero FROM w)
SELECT round(alpha, 6) AS alpha, 'l_extendedprice' AS feature, round(wa, 4) + 0.0 AS coefficient, n_zero FROM n UNION ALL SELECT round(alpha, 6), 'l_discount', round(wb, 4) + 0.0, n_zero FROM n""")
def lasso_path_two(spark, sf_dir):
    train = side(split_lines(spark, sf_dir), "train")
    found = gram.grams(train, ["l_extendedprice", "l_discount"], "y")[None]
    return round_columns(round_columns(tune.path(spark, found, "lasso", tune.LASSO_PATH), ["alpha"]), ["coefficient"], 4)


def moments_sql(source: str, columns: list[str], by: str = "0", unit: bool = True) -> str:
    """Of each group: n, means m1.., deviations s1.. (1 with ``unit`` false), correlations c1_2.., covariances r1.. with y, and my, vy."""
    p = range(1, len(columns) + 1)
    x = dict(zip(p, columns))
    spread = ", ".join(f"coalesce(nullif(stddev_pop({x[i]}), 0), 1) AS s{i}" if unit else f"1.0::DOUBLE AS s{i}" for i in p)
    raw = ", ".join(f"covar_pop({x[i]}, {x[j]}) AS v{i}_{j}" for i in p for j in p if i <= j) + ", " + ", ".join(f"covar_pop({x[i]}, y) AS t{i}, avg({x[i]}) AS m{i}" for i in p)
    put = ", ".join(f"v{min(i, j)}_{max(i, j)} / (s{i} * s{j}) AS c{i}_{j}" for i in p for j in p) + ", " + ", ".join(f"t{i} / s{i} AS r{i}" for i in p)
    return f"(SELECT *, {put} FROM (SELECT {by} AS k, count(*)::DOUBLE AS n, avg(y) AS my, var_pop(y) AS vy, {spread}, {raw} FROM {source} GROUP BY 1))"


def descent_sql(p: int, settings: str, rounds: int) -> str:
    """``fit``: coefficients w1.. of the standardised problem by ``rounds`` of coordinate descent, for every group of ``mo`` and row (i, l1, l2n, l2) of ``settings``."""
    inner = "SELECT gs.*, {} FROM gs JOIN mo USING (k) WHERE it < {}".format(", ".join([*(f"c{i}_{j}" for i in range(1, p + 1) for j in range(1, p + 1)), *(f"r{i}" for i in range(1, p + 1)), "n"]), rounds)
    for i in range(1, p + 1):
        rest = f"(r{i} - (" + " + ".join(f"c{i}_{j} * w{j}" for j in range(1, p + 1) if j != i) + "))" if p > 1 else f"r{i}"
        new = f"CASE WHEN c{i}_{i} = 0 THEN 0 ELSE sign({rest}) * greatest(abs({rest}) - l1, 0) / (c{i}_{i} + l2 + l2n / n) END"
        inner = f"SELECT * REPLACE ({new} AS w{i}) FROM ({inner})"
    ws = ", ".join(f"w{i}" for i in range(1, p + 1))
    zero = ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(1, p + 1))
    return f"gs AS (SELECT k, i, l1, l2n, l2, 0 AS it, {zero} FROM mo, ({settings}) UNION ALL SELECT k, i, l1, l2n, l2, it + 1, {ws} FROM ({inner})), fit AS (SELECT k, i, l1, l2n, l2, {ws} FROM gs WHERE it = {rounds})"


def predicted_sql(columns: list[str], fit: str = "fit", mo: str = "mo") -> str:
    return f"{mo}.my + " + " + ".join(f"{fit}.w{i} * ({c} - {mo}.m{i}) / {mo}.s{i}" for i, c in enumerate(columns, 1))


_LASSO = "SELECT j AS i, power(10, -3 + j * 4.5 / 27.0::DOUBLE) AS l1, 0 AS l2n, 0 AS l2 FROM range(28) t(j)"


@query(f"""WITH RECURSIVE {SPLIT_SQL}, tr AS (SELECT * FROM split_rows WHERE split = 'train'), mo AS {moments_sql('tr', NUMERIC)}, {descent_sql(4, _LASSO, 100)},
z AS (SELECT l1, [w1, w2, w3, w4] AS w, CAST((abs(w1) < 1e-12)::INT + (abs(w2) < 1e-12)::INT + (abs(w3) < 1e-12)::INT + (abs(w4) < 1e-12)::INT AS BIGINT) AS n_zero FROM fit)
SELECT round(l1, 6) AS alpha, unnest({NUMERIC}) AS feature, round(unnest(w), 4) + 0.0 AS coefficient, n_zero FROM z""")
def lasso_path(spark, sf_dir):
    """Four features along 28 penalties, exact by homotopy."""
    train = side(split_lines(spark, sf_dir), "train")
    found = gram.grams(train, NUMERIC, "y")[None]
    return round_columns(round_columns(tune.path(spark, found, "lasso", tune.LASSO_PATH), ["alpha"]), ["coefficient"], 4)


# ---------------------------------------------------------------- estimators over the assembled vector

def prepared(spark, sf_dir, scale=True):
    """Train and test rows with the vector column of a preprocessor fitted on train."""
    df = split_lines(spark, sf_dir)
    pre = features.TabularPreprocessor(numeric=NUMERIC, categorical=CATEGORICAL, scale=scale).fit(side(df, "train"))
    ready = materialise(pre.transform(df).select("id", "split", "y", "features"))
    return side(ready, "train"), side(ready, "test")


def _fitted_metrics(train, test, estimators):
    result = None
    for name, estimator in estimators.items():
        scored = estimator.fit(train).transform(test)
        line = evaluate.regression_metrics(scored, "y", "prediction").select(F.lit(name).alias("model"), "*")
        result = line if result is None else result.unionByName(line)
    return evaluate.comparison_table(_regression(result), "r2")


# The eight prepared features: standardised numbers, one column for the line state, one for each return flag.
_PREPARED = [f"(({c} - avg({c}) FILTER (split = 'train') OVER ()) / stddev_pop({c}) FILTER (split = 'train') OVER ())" for c in NUMERIC]
_PREPARED += ["(l_linestatus = 'O')::INT::DOUBLE", *[f"(l_returnflag = '{f}')::INT::DOUBLE" for f in "ANR"]]
_X8 = [f"x{i}" for i in range(1, 9)]
_FOUR_KINDS = "SELECT * FROM (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), (1, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE), (2, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), (3, 0.5::DOUBLE, 0.0::DOUBLE, 0.5::DOUBLE)) t(i, l1, l2n, l2)"
KINDS = ["linear", "ridge", "lasso", "elastic net"]


@query(f"""WITH RECURSIVE {SPLIT_SQL}, px AS (SELECT split, y, {", ".join(f"{e} AS {x}" for e, x in zip(_PREPARED, _X8))} FROM split_rows), tr AS (SELECT * FROM px WHERE split = 'train'),
mo AS {moments_sql('tr', _X8, unit=False)}, {descent_sql(8, _FOUR_KINDS, 400)},
p AS (SELECT fit.i, y, {predicted_sql(_X8)} AS p FROM px, fit JOIN mo USING (k) WHERE split = 'test'),
q AS (SELECT i, {KINDS}[i + 1] AS model, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae FROM p GROUP BY i)
SELECT row_number() OVER (ORDER BY round(r2, 6) DESC, model) AS rank, model, round(r2, 6) AS r2, round(rmse, 3) AS rmse, round(mae, 3) AS mae FROM q""")
def linear_models(spark, sf_dir):
    """Four baseline models from one sum of products over the prepared vector, scored on test."""
    train, test = prepared(spark, sf_dir)
    names = [f"f{i}" for i in range(train.select("features").first()[0].size)]
    wide = lambda df: df.select("y", *[vector_to_array("features")[i].alias(n) for i, n in enumerate(names)])
    sums = gram.grams(wide(train), names, "y")[None]
    fits = dict(zip(KINDS, (gram.fit(sums, scale=False), gram.fit(sums, 1.0, scale=False), gram.fit(sums, 1.0, 1.0, scale=False), gram.fit(sums, 1.0, 0.5, scale=False))))
    scored = wide(test).select("y", *[f.predict().alias(n) for n, f in fits.items()])
    lines = scored.agg(*[F.struct(*evaluate.regression_aggregates("y", n)).alias(n) for n in KINDS])
    long = lines.select(F.inline(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"`{n}`.r2").alias("r2"), F.col(f"`{n}`.rmse").alias("rmse"), F.col(f"`{n}`.mae").alias("mae")) for n in KINDS])))
    return evaluate.comparison_table(round_columns(round_columns(long, ["r2"]), ["rmse", "mae"], 3), "r2")


@query()
def robust_linear(spark, sf_dir):
    """The Huber loss on the same vector."""
    train, test = prepared(spark, sf_dir)
    return _fitted_metrics(train, test, {"robust linear": models.robust_linear(models.target_facts(train, "y"))})


@query()
def polynomial_regression(spark, sf_dir):
    """Degree chosen by CV on train from the fold sums, then scored on test."""
    df = split_lines(spark, sf_dir).select("id", "id_hash", "split", "y", *NUMERIC[1:])
    train = materialise(split.kfold(side(df, "train"), "id", checked=True, hashed="id_hash").drop("id", "id_hash"))
    expanded, names = features.polynomial(train, NUMERIC[1:], 3)
    widest = tune.fold_grams(expanded, names, "y")  # holds the sums of every smaller degree
    scores = []
    folds = {}
    for degree in (1, 2, 3):
        terms = [" ".join(t) for t in features.polynomial_terms(NUMERIC[1:], degree)]
        grams = folds[degree] = {f: g.only(terms) for f, g in widest.items()}
        scores.append(tune.linear_scores(spark, grams, "linear", [{"degree": degree}]))
    table_ = tune.summarise(scores[0].unionByName(scores[1]).unionByName(scores[2])).where(F.col("metric") == "r2")
    best = int(table_.orderBy(F.col("mean").desc(), "setting").first()["params"]["degree"])
    fit = gram.fit(tune.sum_grams(folds[best].values()))
    test, _ = features.polynomial(side(df, "test"), NUMERIC[1:], best)
    metrics = evaluate.regression_metrics(test.withColumn("p", fit.predict()), "y", "p")
    return round_columns(table_.select(F.col("params")["degree"].cast("int").alias("degree"), "mean", "std").withColumn(
        "chosen", F.col("degree") == best).withColumn("test_r2", F.when(F.col("chosen"), metrics.select("r2").scalar())), ["mean", "std", "test_r2"])


@query()
def tree_models(spark, sf_dir):
    train, test = prepared(spark, sf_dir, scale=False)
    return _fitted_metrics(train, test, {
        "tree": models.tree_regressor(), "forest": models.forest_regressor(key="id"), "boosting": models.boosted_regressor()})


# SQL: one tree without a depth limit over the eight prepared features; a row of ``grown`` is a training row on a level, with the split above it.
_VECTOR = """[coalesce(l_quantity, 0)::DOUBLE, l_extendedprice, l_discount, l_tax, (l_linestatus = 'F')::INT::DOUBLE, (l_linestatus = 'O')::INT::DOUBLE]"""


def _tree_sql(vector: str) -> str:
    return f"""RECURSIVE {SPLIT_SQL}, tr AS (SELECT id, y, {vector} AS x FROM split_rows WHERE split = 'train'),
grown AS (
 SELECT 0 AS level, id, y, x, 0::BIGINT AS node, NULL::INT AS above, NULL::DOUBLE AS cut, NULL::DOUBLE AS gain FROM tr
 UNION ALL
 SELECT level + 1, id, y, x, node * 2 + (x[best.f] > best.t)::INT, best.f, best.t, best.gain FROM (
  SELECT *, first_value({{'f': f, 't': t, 'gain': gain, 'share': share}}) OVER (PARTITION BY node ORDER BY share DESC NULLS LAST, f, t) AS best FROM (
   SELECT *, moved * moved / nl + moved * moved / (n - nl) AS gain,
    CASE WHEN nx > v AND sse > 0 THEN round((moved * moved / nl + moved * moved / (n - nl)) / sse, 9) END AS share, CASE WHEN (v + nx) / 2 >= nx THEN v ELSE (v + nx) / 2 END AS t FROM (
    SELECT level, id, y, x, node, f, v, n, nx, sse, row_number() OVER o AS nl, sum(c) OVER (o ROWS UNBOUNDED PRECEDING) AS moved FROM (
     SELECT *, y - my AS c, sum((y - my) * (y - my)) OVER (PARTITION BY node, f) AS sse, lead(v) OVER (PARTITION BY node, f ORDER BY v, id) AS nx FROM (
      SELECT *, count(*) OVER (PARTITION BY node, f) AS n, avg(y) OVER (PARTITION BY node, f) AS my, max(y) OVER (PARTITION BY node, f) > min(y) OVER (PARTITION BY node, f) AS mixed FROM (
       SELECT *, unnest(x) AS v, generate_subscripts(x, 1)::INT AS f FROM grown)) WHERE mixed)
    WINDOW o AS (PARTITION BY node, f ORDER BY v, id)))) WHERE f = 1 AND best.share IS NOT NULL),
splits AS (SELECT DISTINCT level - 1 AS level, node >> 1 AS node, above AS f, cut, gain FROM grown WHERE level > 0)"""


def _plain_tree(spark, sf_dir):
    """A full tree of the training lines over plain numbers: the four measures and the two line states."""
    df = split_lines(spark, sf_dir)
    states = [(F.col("l_linestatus") == s).cast("double") for s in ("F", "O")]
    return trees.fit_trees(side(df.select("id", "y", "split", F.array(*[F.col(c).cast("double") for c in NUMERIC], *states).alias("features")), "train"), "y")


PLAIN = [*NUMERIC, "l_linestatus_F", "l_linestatus_O"]


@query(f"""WITH {_tree_sql(_VECTOR)}, g AS (SELECT f, sum(gain) AS g FROM splits GROUP BY f), names AS (SELECT unnest({PLAIN}) AS feature, generate_subscripts({PLAIN}, 1) AS f)
SELECT feature, round(coalesce(g, 0) / (SELECT sum(g) FROM g), 5) + 0.0 AS importance FROM names LEFT JOIN g USING (f)""")
def importance(spark, sf_dir):
    """Share of the fall in squared error over all splits of a full tree, recomputed by SQL split for split."""
    found = trees.importances(_plain_tree(spark, sf_dir), len(PLAIN))
    names = spark.createDataFrame(list(enumerate(PLAIN)), "feature int, name string")
    return round_columns(found.join(names, "feature").select(F.col("name").alias("feature"), "importance"), ["importance"], 5)


@query(f"""WITH {_tree_sql(_VECTOR)}, top AS (SELECT f, cut FROM splits WHERE level = 0)
SELECT (SELECT max(level) + 1 FROM splits)::INT AS depth, (SELECT count(*) + 1 FROM splits) AS n_leaves, (SELECT {PLAIN}[f] FROM top) AS top_feature, round((SELECT cut FROM top), 6) AS top_threshold""")
def tree_facts(spark, sf_dir):
    """Depth, leaves and first split of the same tree."""
    model = trees.TreeModel(_plain_tree(spark, sf_dir), "features", len(PLAIN), False)
    facts = model.facts()
    return spark.createDataFrame([(facts["depth"], facts["leaves"], PLAIN[facts["feature"]], round(facts["threshold"], 6))], "depth int, n_leaves long, top_feature string, top_threshold double")


@query(f"""WITH {_tree_sql(_VECTOR)}, c AS (SELECT level, node, count(*) AS n FROM grown GROUP BY ALL)
SELECT s.level::INT AS depth, {PLAIN}[s.f] AS feature, round(cut, 6) AS threshold, n AS n_rows, round(gain / n, 3) AS gain_per_row FROM splits s JOIN c USING (level, node) WHERE s.level < 5""")
def tree_splits(spark, sf_dir):
    """Every split of the first five levels with its rows and the fall of the squared error for each of them."""
    nodes = _plain_tree(spark, sf_dir).where("depth <= 5")
    child = nodes.select(F.col("node").alias("child"), F.col("sse").alias("below"))
    split_ = nodes.where("left >= 0 AND depth < 5").select("node", "depth", "feature", "threshold", F.col("rows").alias("n_rows"), "sse", F.explode(F.array("left", "right")).alias("child"))
    both = split_.join(child, "child").groupBy("node", "depth", "feature", "threshold", "n_rows").agg((F.first("sse") - F.sum("below")).alias("gain"))
    name = F.element_at(F.array(*map(F.lit, PLAIN)), F.col("feature") + 1)
    return both.select("depth", name.alias("feature"), rounded("threshold").alias("threshold"), "n_rows", rounded(F.col("gain") / F.col("n_rows"), 3).alias("gain_per_row"))


@query()
def rff_svr(spark, sf_dir):
    """RBF kernel regression through random Fourier features; ``score_source`` names the approximation."""
    train, test = prepared(spark, sf_dir)
    rff = models.RandomFourierFeatures(gamma=models.scale_gamma(train), components=300)
    scored = models.kernel_ridge(train, rff, 1.0)(test)
    return _regression(evaluate.regression_metrics(scored, "y", "prediction")).withColumn(
        "score_source", F.lit("random Fourier features, D=300"))


# ---------------------------------------------------------------- neighbours

_EMB = f"""src AS (SELECT vec_id AS id, label, embedding AS x FROM embeddings), {split_sql('src', 'label')},
q AS (SELECT * FROM split_rows WHERE split = 'test'), t AS (SELECT * FROM split_rows WHERE split = 'train')"""


def _distance_sql(metric: str) -> str:
    zipped = "list_transform(list_zip(q.x, t.x), lambda p: {body})"
    body = {"euclidean": "(p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)", "manhattan": "abs(p[1]::DOUBLE - p[2]::DOUBLE)",
            "chebyshev": "abs(p[1]::DOUBLE - p[2]::DOUBLE)", "cosine": "p[1]::DOUBLE * p[2]::DOUBLE"}[metric]
    parts = zipped.format(body=body)
    square = lambda v: f"list_sum(list_transform({v}.x, lambda e: e::DOUBLE * e::DOUBLE))"
    return {"euclidean": f"sqrt(list_sum({parts}))", "manhattan": f"list_sum({parts})", "chebyshev": f"list_max({parts})",
            "cosine": f"1 - list_sum({parts}) / sqrt({square('q')} * {square('t')})"}[metric]


def _found_sql(metric: str, k: int = 5) -> str:
    return f"""{_EMB}, found AS (SELECT q.id AS query_id, t.id AS train_id, t.label AS label, q.label AS truth, round({_distance_sql(metric)}, 12) AS d FROM q, t
 QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY round({_distance_sql(metric)}, 12), t.id) <= {k})"""


def _embeddings(spark, sf_dir, payload="label"):
    df = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", "embedding")
    df = split.train_test_split(df, "id", "label")
    parts = df.select("id", "split", "label", *knn.dense_parts("embedding"), F.col(payload).cast("string").alias("payload"))
    return side(parts, "test"), side(parts, "train")


def _classify(metric):
    def run(spark, sf_dir):
        test, train = _embeddings(spark, sf_dir)
        return knn.knn_classify(knn.neighbours(test, train, 5, metric)).select("query_id", "prediction", rounded("share").alias("share"))

    run.__name__ = f"knn_classify_{metric}"
    return run


for _m in knn.METRICS:
    query(f"""WITH {_found_sql(_m)}, v AS (SELECT query_id, label::VARCHAR AS label, count(*) AS c FROM found GROUP BY ALL)
    SELECT query_id, label AS prediction, round(c / 5.0::DOUBLE, 6) AS share FROM v QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY c DESC, label) = 1""")(_classify(_m))


@query(f"WITH {_found_sql('euclidean')} SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS INT) AS rank, train_id, round(d, 6) AS distance FROM found")
def knn_neighbours(spark, sf_dir):
    test, train = _embeddings(spark, sf_dir)
    return knn.neighbours(test, train).select("query_id", "rank", "train_id", rounded("distance").alias("distance"))


@query(f"""WITH {_found_sql('euclidean')} SELECT query_id, round(sum(label / d) / sum(1 / d), 6) AS prediction FROM found GROUP BY query_id""")
def knn_regress_weighted(spark, sf_dir):
    test, train = _embeddings(spark, sf_dir)
    return round_columns(knn.knn_regress(knn.neighbours(test, train), "distance"), ["prediction"])


@query(f"""WITH {SPLIT_SQL}, s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2,
 avg(l_discount) AS m3, stddev_pop(l_discount) AS s3 FROM split_rows WHERE split = 'train'),
sup AS (SELECT s_suppkey AS id, s_acctbal / 10000 AS a, s_nationkey / 25.0::DOUBLE AS b FROM supplier),
cus AS (SELECT c_custkey AS id, c_acctbal / 10000 AS a, c_nationkey / 25.0::DOUBLE AS b, c_acctbal AS y FROM customer),
f AS (SELECT sup.id AS query_id, cus.id AS train_id, cus.y, round(sqrt((sup.a - cus.a) * (sup.a - cus.a) + (sup.b - cus.b) * (sup.b - cus.b)), 12) AS d FROM sup, cus
 QUALIFY row_number() OVER (PARTITION BY sup.id ORDER BY round(sqrt((sup.a - cus.a) * (sup.a - cus.a) + (sup.b - cus.b) * (sup.b - cus.b)), 12), cus.id) <= 5)
SELECT query_id, round(avg(y), 4) AS prediction FROM f GROUP BY query_id""")
def knn_regress(spark, sf_dir):
    """The balance of the five customers nearest to each supplier in balance and nation."""
    point = lambda a, b: F.array(F.col(a) / 10000, F.col(b) / 25.0)
    queries = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), *knn.dense_parts(point("s_acctbal", "s_nationkey")))
    train = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), *knn.dense_parts(point("c_acctbal", "c_nationkey")), F.col("c_acctbal").cast("string").alias("payload"))
    return round_columns(knn.knn_regress(knn.neighbours(queries, train)), ["prediction"], 4)


# SQL: every test text against every training text, from the weights of shared terms.
def _text_found(weights: str, metric: str = "euclidean") -> str:
    own, shared, distance = {
        "euclidean": ("sum(weight * weight)", "sum(a.weight * b.weight)", "sqrt(greatest(coalesce(nq.s, 0) + coalesce(nt.s, 0) - 2 * coalesce(shared, 0), 0))"),
        "manhattan": ("sum(weight)", "sum(least(a.weight, b.weight))", "greatest(coalesce(nq.s, 0) + coalesce(nt.s, 0) - 2 * coalesce(shared, 0), 0)"),
        "cosine": ("sqrt(sum(weight * weight))", "sum(a.weight * b.weight)", "greatest(1 - coalesce(shared / (nq.s * nt.s), 0), 0)"),
    }[metric]
    return f"""{weights}, qs AS (SELECT id FROM split_rows WHERE split = 'test'), ts AS (SELECT id, label FROM split_rows WHERE split = 'train'),
dot AS (SELECT a.id AS qid, b.id AS tid, {shared} AS shared FROM weights a JOIN weights b USING (term) WHERE a.split = 'test' AND b.split = 'train' GROUP BY ALL),
norm AS (SELECT id, {own} AS s FROM weights GROUP BY id),
d AS (SELECT qs.id AS query_id, ts.id AS train_id, ts.label, round({distance}, 7) + 0.0 AS d
 FROM qs CROSS JOIN ts LEFT JOIN dot ON qid = qs.id AND tid = ts.id LEFT JOIN norm nq ON nq.id = qs.id LEFT JOIN norm nt ON nt.id = ts.id),
found AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS INT) AS rank FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) <= 5)"""


def _texts(spark, sf_dir, cap):
    df = split_reviews(spark, sf_dir)
    model = tfidf.Tfidf(maxFeatures=cap).fit(side(df, "train"))
    return materialise(model.weights(df).select(
        "id", "split", "label", *knn.sparse_parts("_weights"), F.when(F.size("_weights.indices") == 0, "empty").otherwise("full").alias("fill")))


def text_neighbours(spark, sf_dir, metric="euclidean", payload="label", cap=CAP):
    parts = _texts(spark, sf_dir, cap)
    return sparse_knn.neighbours(side(parts, "test"), side(parts, "train").withColumn("payload", F.col(payload)), 5, metric)


@query(f"""WITH {_text_found(WEIGHTS_SQL)} SELECT query_id, rank, train_id, round(d, 6) AS distance FROM found""")
def knn_text(spark, sf_dir):
    """The five nearest training texts of every test text, with their ids."""
    return text_neighbours(spark, sf_dir).select("query_id", "rank", "train_id", rounded("distance").alias("distance"))


@query(f"""WITH {_text_found(WEIGHTS_SQL)} SELECT query_id, rank, round(d, 3) AS distance FROM found""")
def knn_text_distances(spark, sf_dir):
    return text_neighbours(spark, sf_dir).select("query_id", "rank", rounded("distance", 3).alias("distance"))


def _vote_sql(metric: str, weighting: str) -> str:
    weight = "1.0::DOUBLE" if weighting == "uniform" else "CASE WHEN min(d) OVER (PARTITION BY query_id) = 0 THEN (d = 0)::INT::DOUBLE ELSE 1 / d END"
    return f"""WITH {_text_found(WEIGHTS_SQL, metric)}, w AS (SELECT query_id, label, {weight} AS w FROM found),
v AS (SELECT query_id, label, sum(w) / sum(sum(w)) OVER (PARTITION BY query_id) AS share FROM w GROUP BY query_id, label)
SELECT query_id, label, round(share, 6) AS share, label = first_value(label) OVER (PARTITION BY query_id ORDER BY round(share, 9) DESC, label) AS predicted FROM v"""


def _votes(metric, weighting):
    def run(spark, sf_dir):
        shares = knn.knn_shares(text_neighbours(spark, sf_dir, metric), weighting)
        first = F.first("label").over(W.partitionBy("query_id").orderBy(F.round("share", 9).desc(), "label"))
        return shares.select("query_id", "label", rounded("share").alias("share"), (F.col("label") == first).alias("predicted"))

    run.__name__ = f"knn_text_votes_{metric}_{weighting}"
    return run


for _m in sparse_knn.METRICS:
    for _w in ("uniform", "distance"):
        query(_vote_sql(_m, _w))(_votes(_m, _w))


# Vocabulary of 40 terms; a text is empty when it has no weight.
@query(f"""WITH {_text_found(weights_sql(40))}, f AS (SELECT query_id, train_id FROM found),
e AS (SELECT query_id, max((NOT EXISTS (SELECT 1 FROM norm WHERE norm.id = f.train_id))::INT) AS a, min((NOT EXISTS (SELECT 1 FROM norm WHERE norm.id = f.train_id))::INT) AS b
 FROM f GROUP BY query_id) SELECT round(avg(a), 6) AS share_any, round(avg(b), 6) AS share_all FROM e""")
def knn_empty_neighbours(spark, sf_dir):
    """With a tiny vocabulary some texts have no known term and sit near every query."""
    found = text_neighbours(spark, sf_dir, payload="fill", cap=40)
    return round_columns(knn.empty_neighbour_share(found), ["share_any", "share_all"])


# ---------------------------------------------------------------- naive Bayes

@query(f"""WITH src AS (SELECT vec_id AS id, label, embedding AS x FROM embeddings), {split_sql('src', 'label')},
cells AS (SELECT id, label, split, unnest(x)::DOUBLE AS v, generate_subscripts(x, 1) AS j FROM split_rows),
st AS (SELECT label, j, avg(v) AS m, var_pop(v) AS s FROM cells WHERE split = 'train' GROUP BY ALL),
e AS (SELECT 1e-9::DOUBLE * max(s) AS eps FROM (SELECT var_pop(v) AS s FROM cells WHERE split = 'train' GROUP BY j)),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM split_rows WHERE split = 'train')::DOUBLE) AS lp FROM split_rows WHERE split = 'train' GROUP BY label),
sc AS (SELECT c.id, st.label, pr.lp + sum(-0.5::DOUBLE * ln(2 * pi() * (s + eps)) - (v - m) * (v - m) / (2 * (s + eps))) AS score
 FROM cells c JOIN st USING (j) JOIN pr ON pr.label = st.label, e WHERE c.split = 'test' GROUP BY c.id, st.label, pr.lp)
SELECT id, CAST(arg_max(label, score) AS INT) AS prediction FROM sc GROUP BY id""")
def gaussian_nb(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("x"))
    df = split.train_test_split(df, "id", "label")
    model = bayes.fit_gaussian_nb(side(df, "train"), "x", "label")
    return model.transform(side(df, "test"), "x").select("id", "prediction")


# ---------------------------------------------------------------- text classifiers

def text_vectors(spark, sf_dir, cap=CAP):
    df = models.label_index(split_reviews(spark, sf_dir), "label", "negative")
    model = tfidf.Tfidf(maxFeatures=cap).fit(side(df, "train"))
    ready = materialise(model.transform(df).select("id", "split", "label", "y", "features"))
    return side(ready, "train"), side(ready, "test"), model


def scored_classes(fitted, test):
    scored, source = evaluate.positive_scores(fitted.transform(test))
    return scored.withColumn("predicted", F.when(F.col("prediction") == 1.0, "negative").otherwise("positive")), source


@query()
def text_classifiers(spark, sf_dir):
    train, test, _ = text_vectors(spark, sf_dir)
    n = train.count()
    weighted = features.with_class_weight(train, features.class_weights(train, "label"), "label")
    lines = None
    for name, estimator, rows in (
        ("logistic", models.logistic(n), train), ("logistic balanced", models.logistic(n, weight="weight"), weighted),
        ("tree", models.tree_classifier(), train), ("linear svc", models.linear_svc(n), train),
        ("gaussian nb", models.gaussian_nb(), train),
    ):
        scored, source = scored_classes(estimator.fit(rows), test)
        line = evaluate.classification_metrics(scored, "label", "predicted", "score").select(
            F.lit(name).alias("model"), "*", F.lit(source).alias("score_source"))
        lines = line if lines is None else lines.unionByName(line)
    return evaluate.comparison_table(round_columns(lines, METRIC_NAMES), "weighted_f1")


@query()
def odds_ratios(spark, sf_dir):
    train, _, vocab = text_vectors(spark, sf_dir)
    fitted = models.logistic(train.count()).fit(train)
    return round_columns(models.odds_ratios(fitted, vocab.getOrDefault("vocabulary"), train), ["coefficient", "odds_ratio"], 4)


@query()
def rff_svc(spark, sf_dir):
    """RBF kernel margin classifier through random Fourier features."""
    train, test, _ = text_vectors(spark, sf_dir)
    rff = models.RandomFourierFeatures(gamma=models.scale_gamma(train), components=300)
    mapped = lambda df: rff.transform(df).select("label", "y", F.col("kernel_features").alias("features"))
    scored, source = scored_classes(models.linear_svc(train.count()).fit(mapped(train)), mapped(test))
    return round_columns(evaluate.classification_metrics(scored, "label", "predicted", "score"), METRIC_NAMES).withColumn(
        "score_source", F.lit(f"{source}, random Fourier features, D=300"))
