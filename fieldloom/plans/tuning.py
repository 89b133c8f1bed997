"""Cross-validation, curves, grids, nomination."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.operators import bayes, evaluate, features, gram, homotopy, knn, logistic_grid, models, sparse_bayes, sparse_knn, split, tfidf, tune
from fieldloom.plans.modelling import NUMERIC, descent_sql, moments_sql, predicted_sql, side
from fieldloom.plans.preparation import SPLIT_SQL
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import kfold_sql, split_lines
from fieldloom.plans.text import CAP, WORDS, pairs, split_reviews
from fieldloom.plans.text import SPLIT_SQL as REVIEWS_SPLIT_SQL
from fieldloom.session import materialise

TWO = ["l_extendedprice", "l_discount"]

# SQL: training rows with folds; two-feature sums of the rows outside each fold.
_FOLDS = f"""{SPLIT_SQL}, tr AS (SELECT id, l_extendedprice AS a, l_discount AS b, y FROM split_rows WHERE split = 'train'), {kfold_sql('tr')},
s AS (SELECT k AS fold, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab,
 covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM folded, range(1, 6) r(k) WHERE fold <> k GROUP BY k)"""


def _ridge_scores(alphas: str) -> str:
    return f"""{_FOLDS}, al AS ({alphas}), z AS (SELECT *, ab / sqrt(va * vb) AS r, ay / sqrt(va) AS ra, by_ / sqrt(vb) AS rb, 1 + alpha / n AS d FROM s, al),
w AS (SELECT fold, i, alpha, (ra * d - rb * r) / (d * d - r * r) / sqrt(va) AS wa, (rb * d - ra * r) / (d * d - r * r) / sqrt(vb) AS wb, ma, mb, my FROM z),
sc AS (SELECT w.fold, i, alpha, 1 - sum((y - my - wa * (a - ma) - wb * (b - mb)) ** 2) / (var_pop(y) * count(*)) AS r2,
 sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2)) AS rmse, avg(abs(y - my - wa * (a - ma) - wb * (b - mb))) AS mae
 FROM folded f JOIN w ON w.fold = f.fold GROUP BY ALL)"""


def training_folds(spark, sf_dir, columns=("id", *NUMERIC, "l_linestatus", "l_returnflag")):
    """Training rows with their folds, stored with ``columns`` alone: what the caller reads."""
    train = side(split_lines(spark, sf_dir), "train")
    return materialise(split.kfold(train, "id", checked=True, hashed="id_hash").select("split", "fold", "y", *columns))


@query(f"""WITH {_ridge_scores("SELECT 0 AS i, 0.0::DOUBLE AS alpha")}
SELECT fold, round(r2, 6) AS r2, round(rmse, 4) AS rmse, round(mae, 4) AS mae FROM sc""")
def cross_validate(spark, sf_dir):
    """Five folds of least squares from one pass of sums and one pass of scores."""
    train = training_folds(spark, sf_dir, TWO)
    grams = tune.fold_grams(train, TWO, "y")
    return round_columns(round_columns(tune.linear_fold_errors(train, grams, "linear", {}, "y"), ["r2"]), ["rmse", "mae"], 4)


_GRID = "SELECT i, power(10, -3 + i * 6 / 24.0::DOUBLE) AS alpha FROM range(25) t(i)"


@query(f"""WITH {_ridge_scores(_GRID)}
SELECT i + 1 AS candidate, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std FROM sc GROUP BY i""")
def grid_search(spark, sf_dir):
    """25 ridge settings x 5 folds from one pass over the rows."""
    grams = tune.fold_grams(training_folds(spark, sf_dir, TWO), TWO, "y")
    settings = tune.candidates(tune.REGRESSION_SPACES["ridge"])
    scores = tune.linear_scores(spark, grams, "ridge", settings).where(F.col("metric") == "r2")
    number = F.array_position(F.lit([str(s["alpha"]) for s in settings]), F.col("params")["alpha"])
    return round_columns(scores.groupBy(number.cast("long").alias("candidate")).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")), ["mean", "std"])


@query(f"""WITH {_ridge_scores("SELECT i, power(10, i * 2.0::DOUBLE) AS alpha FROM range(4) t(i)")},
own AS (SELECT w.fold, i, alpha, 1 - sum((y - my - wa * (a - ma) - wb * (b - mb)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM folded f JOIN w ON w.fold <> f.fold GROUP BY ALL)
SELECT sc.alpha, round(avg(own.r2), 6) AS train_mean, round(avg(sc.r2), 6) AS cv_mean, round(stddev_pop(sc.r2), 6) AS cv_std
 FROM sc JOIN own USING (fold, i) GROUP BY sc.alpha""")
def validation_curve(spark, sf_dir):
    grams = tune.fold_grams(training_folds(spark, sf_dir, TWO), TWO, "y")
    scores = tune.linear_scores(spark, grams, "ridge", [{"alpha": a} for a in (1.0, 100.0, 10000.0, 1000000.0)], train_scores=True)
    return round_columns(scores.where(F.col("metric") == "r2").groupBy(F.col("params")["alpha"].cast("double").alias("alpha")).agg(
        F.avg("train_value").alias("train_mean"), F.avg("value").alias("cv_mean"), F.stddev_pop("value").alias("cv_std")),
        ["train_mean", "cv_mean", "cv_std"])


_ENET = "SELECT row_number() OVER (ORDER BY a, r) AS i, power(10, -4 + a * 0.5::DOUBLE) * r AS l1, 0 AS l2n, power(10, -4 + a * 0.5::DOUBLE) * (1 - r) AS l2 FROM range(9) t(a), (SELECT unnest([0.1, 0.3, 0.5, 0.7, 0.9, 1.0])::DOUBLE AS r)"
_ENET_FIT = f"""RECURSIVE {SPLIT_SQL}, tr AS (SELECT * FROM split_rows WHERE split = 'train'), {kfold_sql('tr')}, outside AS (SELECT f.*, k FROM folded f, range(1, 6) r(k) WHERE fold <> k),
mo AS {moments_sql('outside', NUMERIC, 'k')}, {descent_sql(4, _ENET, 150)}"""
_ENET_LABEL = "round(l1 + l2, 6) AS alpha, round(l1 / (l1 + l2), 6) AS l1_ratio"


@query(f"""WITH {_ENET_FIT}, sc AS (SELECT fit.k, fit.i, any_value(l1) AS l1, any_value(l2) AS l2, 1 - sum((y - ({predicted_sql(NUMERIC)})) ** 2) / (var_pop(y) * count(*)) AS r2
 FROM folded JOIN fit ON fit.k = fold JOIN mo ON mo.k = fold GROUP BY fit.k, fit.i), g AS (SELECT {_ENET_LABEL}, avg(r2) AS r2 FROM sc GROUP BY i, l1, l2)
SELECT alpha, {", ".join(f'round(max(r2) FILTER (l1_ratio = {r}), 6) AS "l1_ratio={str(r).replace(".", "_")}"' for r in (0.1, 0.3, 0.5, 0.7, 0.9, 1.0))} FROM g GROUP BY alpha""")
def grid_pivot(spark, sf_dir):
    """Elastic net: alpha down, share of the absolute penalty across; 54 settings x 5 folds, one pass."""
    grams = tune.fold_grams(training_folds(spark, sf_dir, NUMERIC), NUMERIC, "y")
    scores = tune.linear_scores(spark, grams, "elastic_net", tune.candidates(tune.REGRESSION_SPACES["elastic_net"]))
    pivot = tune.grid_pivot(scores, "r2", "alpha", "l1_ratio").withColumn("alpha", F.col("alpha").cast("double"))
    return round_columns(pivot, pivot.columns)


_PAIRS = " + ".join(f"w{i} * w{j} * c{i}_{j}" for i in range(1, 5) for j in range(1, 5))


@query(f"""WITH {_ENET_FIT} SELECT k::INT AS fold, {_ENET_LABEL}, (w1 <> 0)::INT + (w2 <> 0)::INT + (w3 <> 0)::INT + (w4 <> 0)::INT AS n_active,
 round((vy / 2 + ({_PAIRS}) / 2 - (r1 * w1 + r2 * w2 + r3 * w3 + r4 * w4) + l1 * (abs(w1) + abs(w2) + abs(w3) + abs(w4)) + l2 * (w1 * w1 + w2 * w2 + w3 * w3 + w4 * w4) / 2) / vy, 9) AS objective, true AS optimal
FROM fit JOIN mo USING (k)""")
def elastic_net_certificates(spark, sf_dir):
    """Every setting of the grid on every fold: active features, objective over the target's variance, and whether the optimality conditions hold to 1e-6."""
    grams = tune.fold_grams(training_folds(spark, sf_dir, NUMERIC), NUMERIC, "y")
    settings = [(c["alpha"], c["l1_ratio"]) for c in tune.candidates(tune.REGRESSION_SPACES["elastic_net"])]
    total = tune.sum_grams(grams.values())
    variance = F.lit(None).cast("double")
    for f, g in grams.items():
        variance = F.when(F.col("fold") == f, float((total - g).covariance()[-1, -1])).otherwise(variance)
    found = homotopy.certificates(spark, grams, settings)
    return found.select("fold", rounded("alpha").alias("alpha"), rounded("l1_ratio").alias("l1_ratio"), "n_active", rounded(F.col("objective") / variance, 9).alias("objective"), (F.col("violation") <= 1e-6).alias("optimal"))


def _score(df):
    return evaluate.regression_metrics(df, "y", "prediction")


# Four linear models over raw columns; ``repeated`` is the same function as ``linear``.
LINEAR = {"linear": (TWO, {}), "repeated": (TWO, {}), "ridge": (TWO, {"alpha": 1000.0}), "price only": (["l_extendedprice"], {})}

# SQL: mean fold R2 of the four; one feature is the other formula with its second coefficient left out.
_FOUR = f"""{_ridge_scores("SELECT * FROM (VALUES (0, 0.0::DOUBLE), (1, 1000.0::DOUBLE)) t(i, alpha)")},
single AS (SELECT s.fold, 1 - sum((y - my - ay / va * (a - ma)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM folded f JOIN s ON s.fold = f.fold GROUP BY s.fold),
four AS (SELECT 'linear' AS model, avg(r2) AS mean FROM sc WHERE i = 0 UNION ALL SELECT 'repeated', avg(r2) FROM sc WHERE i = 0
 UNION ALL SELECT 'ridge', avg(r2) FROM sc WHERE i = 1 UNION ALL SELECT 'price only', avg(r2) FROM single)"""


def _cv_of_four(train):
    """Fold scores of the four models from one pass of fold sums; the target needs both columns, so each model has the same rows."""
    both = tune.fold_grams(train, TWO, "y")
    sums = {tuple(c): {f: g.only(c) for f, g in both.items()} for c, _ in LINEAR.values()}
    lines = None
    for name, (columns, setting) in LINEAR.items():
        line = tune.linear_scores(train.sparkSession, sums[tuple(columns)], "ridge" if setting else "linear", [setting]).withColumn("model", F.lit(name))
        lines = line if lines is None else lines.unionByName(line)
    fits = {name: gram.fit(tune.sum_grams(sums[tuple(columns)].values()), **setting) for name, (columns, setting) in LINEAR.items()}
    return lines, fits


@query(f"""WITH {_FOUR}, o AS (SELECT model, row_number() OVER (ORDER BY round(mean, 12) DESC, model) AS cv_rank FROM four),
j AS (SELECT cv_rank, model, model <> 'linear' AS tunable, CASE WHEN model = 'linear' THEN 'nothing to tune'
 WHEN model = 'repeated' THEN 'repeats linear' ELSE 'eligible' END AS status FROM o)
SELECT *, status = 'eligible' AND sum((status = 'eligible')::INT) OVER (ORDER BY cv_rank) <= 2 AS nominated FROM j""")
def nominate(spark, sf_dir):
    train = training_folds(spark, sf_dir, TWO)
    cv, fits = _cv_of_four(train)
    predicted = train.withColumns({name: fit.predict() for name, fit in fits.items()})
    return tune.nominate(cv, tune.same_functions(predicted, list(fits)), ["repeated", "ridge", "price only"], "r2")


@query()
def tuning_summary(spark, sf_dir):
    grams = tune.fold_grams(training_folds(spark, sf_dir, TWO), TWO, "y")
    kinds = {"ridge": {"alpha": 1.0}, "lasso": {"alpha": 1.0}}
    base = best = None
    for kind, setting in kinds.items():
        b = tune.summarise(tune.linear_scores(spark, grams, kind, [setting]).where(F.col("metric") == "r2"))
        t = tune.ranked_candidates(tune.linear_scores(spark, grams, kind, tune.candidates(tune.REGRESSION_SPACES[kind])), "r2").where(
            F.col("rank") == 1).drop("rank")
        base, best = (b, t) if base is None else (base.unionByName(b), best.unionByName(t))
    return round_columns(tune.tuning_summary(base, best), ["baseline_mean", "baseline_std", "tuned_mean", "tuned_std", "change"])


# SQL: test scores of the four fits on all training rows.
_TESTED = f"""{_FOUR}, g AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab,
 covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM tr), gz AS (SELECT *, ab / sqrt(va * vb) AS r, ay / sqrt(va) AS ra, by_ / sqrt(vb) AS rb, 1 + 1000.0::DOUBLE / n AS d FROM g),
gw AS (SELECT m.model, ma, mb, my, CASE m.model WHEN 'price only' THEN ay / va WHEN 'ridge' THEN (ra * d - rb * r) / (d * d - r * r) / sqrt(va) ELSE (ra - rb * r) / (1 - r * r) / sqrt(va) END AS wa,
 CASE m.model WHEN 'price only' THEN 0 WHEN 'ridge' THEN (rb * d - ra * r) / (d * d - r * r) / sqrt(vb) ELSE (rb - ra * r) / (1 - r * r) / sqrt(vb) END AS wb FROM gz, four m),
tested AS (SELECT model, round(1 - sum((y - my - wa * (l_extendedprice - ma) - wb * (l_discount - mb)) ** 2) / (var_pop(y) * count(*)), 6) AS test_r2
 FROM split_rows, gw WHERE split = 'test' GROUP BY model)"""


@query(f"""WITH {_TESTED}, b AS (SELECT model, round(mean, 6) AS cv_r2, test_r2 FROM four JOIN tested USING (model)),
r AS (SELECT *, row_number() OVER (ORDER BY cv_r2 DESC, model) AS cv_rank, row_number() OVER (ORDER BY test_r2 DESC, model) AS test_rank FROM b)
SELECT *, cv_rank = test_rank AS agrees FROM r""")
def rank_agreement(spark, sf_dir):
    """One split for both sides; the scores of all four models come from one aggregate over the test rows."""
    df = materialise(split_lines(spark, sf_dir).select("id", "id_hash", "split", "y", *TWO))
    scores, fits = _cv_of_four(materialise(split.kfold(side(df, "train"), "id", checked=True, hashed="id_hash").drop("id", "id_hash")))
    cv = tune.summarise(scores.where(F.col("metric") == "r2")).select("model", F.col("mean").alias("cv_r2"))
    test = side(df, "test")
    wide = test.agg(*[evaluate.regression_aggregates("y", fit.predict())[0].alias(f"m{i}") for i, fit in enumerate(fits.values())])
    lines = wide.select(F.inline(F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"m{i}").alias("test_r2")) for i, name in enumerate(fits)])))
    return round_columns(tune.rank_agreement(round_columns(cv, ["cv_r2"]), round_columns(lines, ["test_r2"]), "cv_r2", "test_r2"), ["cv_r2", "test_r2"])


# SQL: without scaling the penalty meets the raw sums of squares n va + alpha.
@query(f"""WITH {_FOLDS}, z AS (SELECT *, ab / sqrt(va * vb) AS r, ay / sqrt(va) AS ra, by_ / sqrt(vb) AS rb, 1 + 1000.0::DOUBLE / n AS d FROM s),
w AS (SELECT true AS scaled, fold, (ra * d - rb * r) / (d * d - r * r) / sqrt(va) AS wa, (rb * d - ra * r) / (d * d - r * r) / sqrt(vb) AS wb, ma, mb, my FROM z
 UNION ALL SELECT false, fold, (ay * (vb + 1000.0::DOUBLE / n) - by_ * ab) / ((va + 1000.0::DOUBLE / n) * (vb + 1000.0::DOUBLE / n) - ab * ab),
 (by_ * (va + 1000.0::DOUBLE / n) - ay * ab) / ((va + 1000.0::DOUBLE / n) * (vb + 1000.0::DOUBLE / n) - ab * ab), ma, mb, my FROM z),
sc AS (SELECT scaled, w.fold, 1 - sum((y - my - wa * (a - ma) - wb * (b - mb)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM folded f JOIN w ON w.fold = f.fold GROUP BY ALL)
SELECT scaled, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std FROM sc GROUP BY scaled""")
def scaling_study_ridge(spark, sf_dir):
    """Ridge with and without standardised features, cross-validated from the fold sums."""
    grams = tune.fold_grams(training_folds(spark, sf_dir, TWO), TWO, "y")
    return _scaling(spark, grams, {"alpha": 1000.0})


def _scaling(spark, grams, setting):
    total = tune.sum_grams(grams.values())
    rows = []
    for scale in (True, False):
        for f, held_out in sorted(grams.items()):
            fit = gram.fit(total - held_out, **setting, scale=scale)
            rows.append((scale, f, gram.score(held_out, fit)["r2"]))
    scores = spark.createDataFrame(rows, "scaled boolean, fold int, r2 double")
    return round_columns(scores.groupBy("scaled").agg(F.avg("r2").alias("mean"), F.stddev_pop("r2").alias("std")), ["mean", "std"])


@query()
def scaling_study(spark, sf_dir):
    """The same penalised model with and without standardised features, cross-validated."""
    return _scaling(spark, tune.fold_grams(training_folds(spark, sf_dir, NUMERIC), NUMERIC, "y"), {"alpha": 1.0, "l1_ratio": 0.5})


# SQL: features made orthogonal one after the other on the training rows; then every coefficient stands alone.
@query(f"""WITH {SPLIT_SQL}, x AS (SELECT split, y, l_extendedprice AS a, l_discount AS b, l_extendedprice * (1 - l_discount) AS c FROM split_rows),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, covar_pop(b, a) / var_pop(a) AS ba, covar_pop(c, a) / var_pop(a) AS ca, covar_pop(y, a) / var_pop(a) AS wa FROM x WHERE split = 'train'),
e AS (SELECT split, y, my, wa, a - ma AS e1, b - mb - ba * (a - ma) AS e2, c - mc - ca * (a - ma) AS c1 FROM x, m),
m2 AS (SELECT covar_pop(c1, e2) / var_pop(e2) AS cb, covar_pop(y, e2) / var_pop(e2) AS wb FROM e WHERE split = 'train'),
e3 AS (SELECT split, y, my, wa, wb, e1, e2, c1 - cb * e2 AS e3 FROM e, m2),
m3 AS (SELECT covar_pop(y, e3) / var_pop(e3) AS wc FROM e3 WHERE split = 'train'),
p AS (SELECT y, my + wa * e1 + wb * e2 AS p2, my + wa * e1 + wb * e2 + wc * e3 AS p3 FROM e3, m3 WHERE split = 'test')
SELECT 'without' AS features, round(1 - sum((y - p2) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - p2) ** 2)), 4) AS rmse FROM p
UNION ALL SELECT 'with', round(1 - sum((y - p3) ** 2) / (var_pop(y) * count(*)), 6), round(sqrt(avg((y - p3) ** 2)), 4) FROM p""")
def feature_effect(spark, sf_dir):
    """Test scores of a linear model with and without an engineered product."""
    df = materialise(split_lines(spark, sf_dir).select("split", "y", *TWO, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")))
    lines = None
    for name, columns in (("without", TWO), ("with", [*TWO, "net"])):
        fit = gram.fit(gram.grams(side(df, "train"), columns, "y")[None])
        line = evaluate.regression_metrics(side(df, "test").withColumn("p", fit.predict()), "y", "p").select(F.lit(name).alias("features"), "r2", "rmse")
        lines = line if lines is None else lines.unionByName(line)
    return round_columns(round_columns(lines, ["r2"]), ["rmse"], 4)


@query()
def model_grid_search(spark, sf_dir):
    """The published grid of the tree, all depths from one fit for each fold and leaf size; preprocessing learned within each fold."""
    train = training_folds(spark, sf_dir)
    pre = features.TabularPreprocessor(numeric=NUMERIC, categorical=["l_linestatus"], scale=False)
    scores = tune.tree_scores(train, "tree", tune.REGRESSION_SPACES["tree"], "y", prepare=lambda rows: pre.fit(rows).transform)
    return tune.ranked_candidates(scores, "r2").select("rank", "setting", rounded("mean").alias("mean"), rounded("std").alias("std"))


@query()
def forest_grid_search(spark, sf_dir):
    """The published grid of the forest over the parts: 36 candidates from 400 trees for each fold and leaf size."""
    parts = table(spark, sf_dir, "part")
    word = lambda i: F.crc32(F.element_at(F.split("p_type", " "), i).cast("binary")) % 97
    rows = parts.select(F.col("p_partkey").alias("id"), F.lit("train").alias("split"), F.col("p_retailprice").alias("y"),
                        F.array(*[c.cast("double") for c in (F.col("p_size"), F.length("p_name"), F.length("p_brand"), word(1), word(-1))]).alias("features"))
    folded = materialise(split.kfold(rows, "id"))
    scores = tune.tree_scores(folded, "forest", tune.REGRESSION_SPACES["forest"], "y", bootstrap=True)
    return tune.ranked_candidates(scores, "r2").select("rank", "setting", rounded("mean").alias("mean"), rounded("std").alias("std"))


# ---------------------------------------------------------------- classification

# TF-IDF learned in every fold anew, folds stratified by the label; the rare class is the positive one.
_SMOOTH = "SELECT CAST(i AS INT) AS i, power(10, i - 9.0::DOUBLE) AS vs FROM range(9) t(i)"
_BASE = "SELECT 0 AS i, 1e-9::DOUBLE AS vs"
_TR = f"""{REVIEWS_SPLIT_SQL}, tr AS (SELECT id, label, text FROM split_rows WHERE split = 'train'), {kfold_sql('tr', 'PARTITION BY label')}"""
# (k, id, label, held, text): under every fold k its own training rows and its held-out ones; or all training rows and the test rows as one group.
_GROUPED_CV = "grouped AS (SELECT k, id, label, fold = k AS held, text FROM folded, range(1, 6) r(k))"
_GROUPED_TEST = "grouped AS (SELECT 0 AS k, id, label, split = 'test' AS held, text FROM split_rows)"

# Weights of every row under its group's vocabulary, (k, id, label, held, term, w).
_WEIGHTED = f"""wd AS (SELECT k, id, label, held, {WORDS} AS w FROM grouped), tf AS (SELECT k, id, label, held, term, count(*) AS tf FROM (SELECT k, id, label, held, unnest({pairs('w')}) AS term FROM wd) GROUP BY ALL),
gn AS (SELECT k, count(*) AS n FROM grouped WHERE NOT held GROUP BY k),
vo AS (SELECT k, term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf FROM (SELECT k, term, count(*) AS df, sum(tf) AS total FROM tf WHERE NOT held GROUP BY k, term HAVING count(*) >= 2
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY sum(tf) DESC, term) <= {CAP}) JOIN gn USING (k)),
we AS (SELECT k, id, label, held, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY k, id)) AS w FROM (SELECT k, id, label, held, term, (1 + ln(tf)) * idf AS raw FROM tf JOIN vo USING (k, term)))"""


def _nb_sql(by: str) -> str:
    """Gaussian naive Bayes on all terms, zeros included, for the smoothings ``by``: (k, i, id, actual, predicted, score)."""
    return f"""cl AS (SELECT k, label, count(*)::DOUBLE AS n FROM grouped WHERE NOT held GROUP BY k, label), su AS (SELECT k, label, term, sum(w) AS s, sum(w * w) AS q FROM we WHERE NOT held GROUP BY ALL),
st AS (SELECT cl.k, cl.label, vo.term, n, coalesce(s, 0) / n AS m, greatest(coalesce(q, 0) / n - (coalesce(s, 0) / n) ** 2, 0) AS v FROM cl JOIN vo ON vo.k = cl.k LEFT JOIN su ON su.k = cl.k AND su.label = cl.label AND su.term = vo.term),
ep AS (SELECT k, max(v) AS top FROM (SELECT k, term, sum(q) / any_value(n) - (sum(s) / any_value(n)) ** 2 AS v FROM su JOIN (SELECT k, sum(n) AS n FROM cl GROUP BY k) USING (k) GROUP BY k, term) GROUP BY k),
sm AS (SELECT st.*, i, v + vs * top AS e FROM st JOIN ep USING (k), ({by})),
ze AS (SELECT k, i, label, ln(any_value(n) / (SELECT sum(n) FROM cl WHERE cl.k = sm.k)) + sum(-0.5::DOUBLE * ln(2 * pi() * e) - m * m / (2 * e)) AS z FROM sm GROUP BY k, i, label),
co AS (SELECT we.k, we.id, i, sm.label, sum(w * m / e - w * w / (2 * e)) AS c FROM we JOIN sm ON sm.k = we.k AND sm.term = we.term WHERE held GROUP BY ALL),
sl AS (SELECT g.k, g.id, g.label AS actual, ze.i, ze.label, z + coalesce(c, 0) AS score FROM grouped g JOIN ze ON ze.k = g.k LEFT JOIN co ON co.k = g.k AND co.id = g.id AND co.i = ze.i AND co.label = ze.label WHERE held),
said AS (SELECT k, i, id, actual, CASE WHEN max(score) FILTER (label = 'negative') >= max(score) FILTER (label = 'positive') THEN 'negative' ELSE 'positive' END AS predicted,
 exp(max(score) FILTER (label = 'negative') - max(score)) / (exp(max(score) FILTER (label = 'negative') - max(score)) + exp(max(score) FILTER (label = 'positive') - max(score))) AS score FROM sl GROUP BY k, i, id, actual)"""


_CELL = """ct AS (SELECT k, i, count(*) FILTER (WHERE actual = 'negative' AND predicted = 'negative')::DOUBLE AS tp, count(*) FILTER (WHERE actual <> 'negative' AND predicted = 'negative')::DOUBLE AS fp,
 count(*) FILTER (WHERE actual = 'negative' AND predicted <> 'negative')::DOUBLE AS fn, count(*) FILTER (WHERE actual <> 'negative' AND predicted <> 'negative')::DOUBLE AS tn FROM said GROUP BY k, i),
au AS (SELECT k, i, (sum(r) FILTER (actual = 'negative') - count(*) FILTER (actual = 'negative') * (count(*) FILTER (actual = 'negative') + 1) / 2.0::DOUBLE) / (count(*) FILTER (actual = 'negative') * count(*) FILTER (actual <> 'negative')) AS roc_auc
 FROM (SELECT k, i, actual, rank() OVER (PARTITION BY k, i ORDER BY score) + (count(*) OVER (PARTITION BY k, i, score) - 1) / 2.0::DOUBLE AS r FROM said) GROUP BY k, i),
me AS (SELECT k, i, (tp + tn) / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
 CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
 (CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END * (tp + fn) + CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END * (tn + fp)) / (tp + fp + fn + tn) AS weighted_f1, roc_auc
 FROM ct JOIN au USING (k, i))"""
SIX = ["accuracy", "precision", "recall", "f1", "weighted_f1", "roc_auc"]


def review_folds(spark, sf_dir):
    """The training texts in five folds, stratified by the label."""
    return materialise(split.kfold(split_reviews(spark, sf_dir).where(F.col("split") == "train"), "id", stratum="label").select("id", "split", "label", "text", "fold"))


def fold_metrics(predictions, by=("group", "candidate")):
    """Six metrics of each fold and candidate, long: (fold, candidate, metric, value)."""
    wide = evaluate.classification_metrics(predictions, "label", "prediction", "score", by=by).select(*by, *SIX)
    return wide.unpivot(list(by), SIX, "metric", "value")


def _nb_predictions(spark, sf_dir, smoothings):
    vectors, size = sparse_bayes.fold_vectors(review_folds(spark, sf_dir), "text", "label", CAP)
    return materialise(sparse_bayes.cross_validated(vectors, size, "negative", smoothings))


@query(f"""WITH {_TR}, {_GROUPED_CV}, {_WEIGHTED}, {_nb_sql(_BASE)}, {_CELL},
l AS (UNPIVOT (SELECT k, {", ".join(SIX)} FROM me) ON {", ".join(SIX)} INTO NAME metric VALUE value)
SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM l GROUP BY metric""")
def classification_cv(spark, sf_dir):
    """Six metrics of naive Bayes on TF-IDF over five stratified folds, the vocabulary learned in each fold anew."""
    scores = fold_metrics(_nb_predictions(spark, sf_dir, [bayes.VAR_SMOOTHING]))
    return scores.groupBy("metric").agg(rounded(F.avg("value")).alias("mean"), rounded(F.stddev_pop("value")).alias("std"))


_GRID_NB = f"""{_TR}, {_GROUPED_CV}, {_WEIGHTED}, {_nb_sql(_SMOOTH)}, {_CELL},
gr AS (SELECT i, round(avg(weighted_f1), 9) AS m, round(avg(weighted_f1), 6) AS mean, round(stddev_pop(weighted_f1), 6) AS std, round(avg(roc_auc), 6) AS auc FROM me GROUP BY i)"""
SMOOTHINGS = tune.CLASSIFICATION_SPACES["gaussian_nb"]["var_smoothing"]


def _nb_grid(spark, sf_dir):
    """One row for each smoothing, ``best`` marks the first of equal means."""
    scores = materialise(fold_metrics(_nb_predictions(spark, sf_dir, SMOOTHINGS)))
    f1 = F.when(F.col("metric") == "weighted_f1", F.col("value"))
    table_ = scores.groupBy("candidate").agg(F.round(F.avg(f1), 9).alias("m"), F.avg(f1).alias("mean"), F.stddev_pop(f1).alias("std"),
                                             F.avg(F.when(F.col("metric") == "roc_auc", F.col("value"))).alias("auc"))
    return table_.withColumn("best", F.row_number().over(W.orderBy(F.col("m").desc(), "candidate")) == 1).drop("m")


@query(f"""WITH {_GRID_NB} SELECT i AS candidate, mean, std, auc, i = (SELECT i FROM gr ORDER BY m DESC, i LIMIT 1) AS best FROM gr""")
def classification_grid(spark, sf_dir):
    """All nine smoothings by weighted F1 over the folds, from one pass of sums."""
    return round_columns(_nb_grid(spark, sf_dir), ["mean", "std", "auc"])


@query(f"""WITH best AS (SELECT i FROM (WITH {_GRID_NB} SELECT i FROM gr ORDER BY m DESC, i LIMIT 1)),
whole AS (WITH {_TR}, {_GROUPED_TEST}, {_WEIGHTED}, {_nb_sql(_SMOOTH)}, {_CELL} SELECT * FROM me),
b AS (UNPIVOT (SELECT accuracy, weighted_f1, roc_auc FROM whole WHERE i = 0) ON accuracy, weighted_f1, roc_auc INTO NAME metric VALUE before),
a AS (UNPIVOT (SELECT accuracy, weighted_f1, roc_auc FROM whole WHERE i = (SELECT i FROM best)) ON accuracy, weighted_f1, roc_auc INTO NAME metric VALUE after)
SELECT 'gaussian nb' AS model, metric, round(before, 6) AS before, round(after, 6) AS after, round(round(after, 6) - round(before, 6), 6) + 0.0 AS change,
 CASE WHEN round(after, 6) = round(before, 6) THEN 'no change' WHEN after > before THEN 'yes' ELSE 'no' END AS improved FROM b JOIN a USING (metric)""")
def classification_before_after(spark, sf_dir):
    """Test scores of the baseline and of the best smoothing, refitted on all training texts."""
    df = split_reviews(spark, sf_dir)
    model = tfidf.Tfidf(maxFeatures=CAP).fit(side(df, "train"))
    rows = materialise(model.weights(df).select(F.lit(0).alias("group"), "id", "label", "split", *sparse_bayes.weights_of()))
    fits = sparse_bayes.fit(side(rows, "train"), "label", len(model.getOrDefault("vocabulary")))
    best = _nb_grid(spark, sf_dir).where("best").first()["candidate"]
    scores = fold_metrics(sparse_bayes.scored(side(rows, "test"), fits, "negative", [SMOOTHINGS[0], SMOOTHINGS[best]]), ("candidate",))
    wide = scores.where(F.col("metric").isin("accuracy", "weighted_f1", "roc_auc")).groupBy("metric").agg(
        *[rounded(F.max(F.when(F.col("candidate") == i, F.col("value")))).alias(name) for i, name in enumerate(("before", "after"))])
    both = wide.select(F.lit("gaussian nb").alias("model"), "metric", "before", "after", F.lit(True).alias("higher_is_better"))
    return evaluate.before_after(both).withColumn("change", rounded("change"))


STRENGTHS = tune.candidates(tune.CLASSIFICATION_SPACES["logistic"])
BASELINE = STRENGTHS.index({"C": 1.0, "class_weight": None})


def _logistic_grid(vectors, size):
    """One row for each of the twelve settings, ``best`` marks the first of equal means; and whether all their fits are solved."""
    grid = logistic_grid.fit(vectors.where(~F.col("held_out")), "label", "negative", size, STRENGTHS)
    scores = materialise(fold_metrics(logistic_grid.scored(vectors.where("held_out"), grid, "negative", "positive")))
    f1 = F.when(F.col("metric") == "weighted_f1", F.col("value"))
    table_ = scores.groupBy("candidate").agg(F.round(F.avg(f1), 9).alias("m"), F.avg(f1).alias("mean"), F.stddev_pop(f1).alias("std"),
                                             F.avg(F.when(F.col("metric") == "roc_auc", F.col("value"))).alias("auc"))
    return table_.withColumn("best", F.row_number().over(W.orderBy(F.col("m").desc(), "candidate")) == 1).drop("m"), grid


@query()
def text_logistic_grid(spark, sf_dir):
    """The published grid of the logistic regression on TF-IDF over stratified folds; all 60 fits share their passes over the rows."""
    table_, grid = _logistic_grid(*sparse_bayes.fold_vectors(review_folds(spark, sf_dir), "text", "label", CAP))
    names = spark.createDataFrame([(i, s["C"], s["class_weight"], bool(grid.gradient[i::len(STRENGTHS)].max() <= 1e-6)) for i, s in enumerate(STRENGTHS)],
                                  "candidate int, C double, class_weight string, solved boolean")
    return names.join(round_columns(table_, ["mean", "std", "auc"], 4), "candidate")


@query()
def text_logistic_before_after(spark, sf_dir):
    """Test scores of the baseline and of the best setting of the grid, both refitted on all training texts."""
    table_, _ = _logistic_grid(*sparse_bayes.fold_vectors(review_folds(spark, sf_dir), "text", "label", CAP))
    settings = [STRENGTHS[BASELINE], STRENGTHS[table_.where("best").first()["candidate"]]]
    df = split_reviews(spark, sf_dir)
    model = tfidf.Tfidf(maxFeatures=CAP).fit(side(df, "train"))
    rows = materialise(model.weights(df).select(F.lit(0).alias("group"), "id", "label", "split", *sparse_bayes.weights_of()))
    grid = logistic_grid.fit(side(rows, "train"), "label", "negative", len(model.getOrDefault("vocabulary")), settings)
    scores = fold_metrics(logistic_grid.scored(side(rows, "test"), grid, "negative", "positive"), ("candidate",))
    wide = scores.groupBy("metric").agg(*[rounded(F.max(F.when(F.col("candidate") == i, F.col("value"))), 4).alias(name) for i, name in enumerate(("before", "after"))])
    both = wide.select(F.lit("logistic").alias("model"), "metric", "before", "after", F.lit(True).alias("higher_is_better"))
    return evaluate.before_after(both).withColumn("change", rounded("change", 4))


@query()
def classification_nominate(spark, sf_dir):
    """The two best text models by weighted F1 over the stratified folds that can be tuned: naive Bayes, two logistic regressions, neighbours, the majority."""
    vectors, size = sparse_bayes.fold_vectors(review_folds(spark, sf_dir), "text", "label", CAP)
    own, held = vectors.where(~F.col("held_out")), vectors.where("held_out")
    settings = [STRENGTHS[BASELINE], {"C": 1.0, "class_weight": "balanced"}]
    named = lambda df, names: df.withColumn("model", F.element_at(F.array(*map(F.lit, names)), F.col("candidate") + 1)).drop("candidate")
    parts = [named(sparse_bayes.cross_validated(vectors, size, "negative"), ["gaussian nb"]),
             named(logistic_grid.scored(held, logistic_grid.fit(own, "label", "negative", size, settings), "negative", "positive"), ["logistic", "logistic balanced"])]
    for (f,) in vectors.select("group").distinct().orderBy("group").collect():
        found = sparse_knn.neighbours(held.where(F.col("group") == f), own.where(F.col("group") == f).withColumn("payload", F.col("label")), 5, "cosine")
        shares = knn.knn_shares(found).groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("label") == "negative", F.col("share"))), F.lit(0.0)).alias("score"))
        said = held.where(F.col("group") == f).join(shares, F.col("id") == F.col("query_id")).select(
            "id", "label", "group", F.when(F.col("score") >= 0.5, "negative").otherwise("positive").alias("prediction"), "score", F.lit("neighbours").alias("model"))
        parts.append(said)
    common = own.groupBy("group", "label").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("label", "n").alias("prediction"))
    parts.append(held.join(common, "group").select("id", "label", "group", "prediction", F.lit(0.0).alias("score"), F.lit("majority").alias("model")))
    columns = ["id", "label", "group", "prediction", "score", "model"]
    every = materialise(reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts]))
    long = fold_metrics(every, ("group", "model")).where("metric = 'weighted_f1'")
    scores = long.select("model", F.create_map().cast("map<string,string>").alias("params"), F.col("group").alias("fold"), "metric", "value", F.lit(None).cast("double").alias("train_value"))
    means = tune.summarise(scores).select("model", rounded("mean", 4).alias("mean"), rounded("std", 4).alias("std"))
    return tune.nominate(scores, [], ["gaussian nb", "logistic", "logistic balanced", "neighbours"], "weighted_f1").join(means, "model")
