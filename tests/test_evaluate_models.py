import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fieldloom.operators import bayes, evaluate, gram, knn, models, split, trees, tune


def frame(spark, actual, predicted, score):
    return spark.createDataFrame(list(zip(actual, predicted, [float(s) for s in score])), "actual string, predicted string, score double")


N, POS = "negative", "positive"


def test_the_rare_class_is_the_positive_class(spark):
    df = frame(spark, [N, N, POS, POS, POS, POS], [N, POS, POS, POS, POS, N], [.9, .4, .1, .2, .3, .6])
    m = evaluate.classification_metrics(df, "actual", "predicted", "score").first()
    assert m["precision"] == m["recall"] == 0.5
    assert m["weighted_recall"] == pytest.approx(m["accuracy"]) == pytest.approx(4 / 6)
    assert m["weighted_f1"] == pytest.approx((2 * 0.5 + 4 * 0.75) / 6, abs=1e-12)
    assert m["roc_auc"] == pytest.approx(7 / 8)
    cells = evaluate.confusion_matrix(df, "actual", "predicted").collect()
    assert [(r["actual"], r["predicted_negative"], r["predicted_positive"]) for r in cells] == [(N, 1, 1), (POS, 1, 3)]


def test_no_predicted_positive_gives_zero_not_an_error(spark):
    m = evaluate.classification_metrics(frame(spark, [N, POS], [POS, POS], [0, 0]), "actual", "predicted", "score").first()
    assert m["precision"] == m["recall"] == m["f1"] == 0.0 and m["roc_auc"] == 0.5


def brute_auc(pos, score):
    good = sum((a > b) + (a == b) / 2 for a, p in zip(score, pos) if p for b, q in zip(score, pos) if not q)
    return good / (sum(pos) * (len(pos) - sum(pos)))


def test_auc_with_one_score_on_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    score = np.round(rng.normal(size=600), 1)
    score[:200] = 0.3
    pos = [bool(v) for v in rng.random(600) < 0.3]
    df = spark.createDataFrame(list(zip(pos, [float(s) for s in score])), "pos boolean, s double")
    assert evaluate.roc_auc(df, "pos", "s").first()["roc_auc"] == pytest.approx(brute_auc(pos, score))
    points = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "pos", "s").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and area == pytest.approx(brute_auc(pos, score))


def test_majority_baseline(spark):
    train = spark.createDataFrame([(POS,)] * 7 + [(N,)] * 3, "label string")
    row = evaluate.majority_baseline(train, spark.createDataFrame([(POS,), (N,)], "label string"), "label").first()
    assert row["majority_class"] == POS and row["accuracy"] == 0.5 and row["recall"] == 0.0 and row["roc_auc"] == 0.5


def test_regression_metrics_are_in_target_units(spark):
    def metrics(scale):
        rows = [(scale * y, scale * (y + e)) for y, e in zip((10.0, 20.0, 30.0, 40.0), (1.0, -1.0, 2.0, -2.0))]
        return evaluate.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    a, b = metrics(1.0), metrics(10.0)
    assert a["mae"] == pytest.approx(1.5) and b["rmse"] == pytest.approx(10 * a["rmse"]) and a["r2"] == pytest.approx(b["r2"])


def test_before_after_is_honest(spark):
    rows = spark.createDataFrame([("A", "R2", .9, .8, True), ("B", "RMSE", 2.0, 1.5, False), ("C", "R2", .9, .9, True)],
                                 "model string, metric string, before double, after double, higher_is_better boolean")
    assert [r["improved"] for r in evaluate.before_after(rows).collect()] == ["no", "yes", "no change"]


@pytest.fixture(scope="module")
def binary(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    negative = x[:, 0] + 0.8 * rng.normal(size=300) > 0.6
    return spark.createDataFrame([(Vectors.dense(r), N if n else POS) for r, n in zip(x, negative)], ["features", "label"])


@pytest.fixture(scope="module")
def indexed(spark, binary):
    return models.label_index(binary, "label", N)


def test_scores_come_from_probabilities_or_decision_values(indexed):
    scored, source = evaluate.positive_scores(models.logistic(300).fit(indexed).transform(indexed))
    assert source == "probability"
    decided, raw = evaluate.positive_scores(models.linear_svc(300).fit(indexed).transform(indexed))
    assert raw == "rawPrediction"
    for df in (scored, decided):
        df = df.withColumn("predicted", F.when(F.col("prediction") == 1, N).otherwise(POS))
        auc = {r["source"]: r["roc_auc"] for r in evaluate.hard_label_auc(df, "label", "predicted", "score").collect()}
        assert auc["score"] > 0.8 and auc["score"] != pytest.approx(auc["label"])
    with pytest.raises(ValueError, match="none of"):
        evaluate.positive_scores(indexed)


def test_logistic_minimises_the_published_objective(spark, indexed):
    fitted = models.logistic(300, C=0.5).fit(indexed)
    x = np.array([r["features"].toArray() for r in indexed.collect()])
    y = np.array([r["y"] for r in indexed.collect()])
    w, b = fitted.coefficients.toArray(), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(0.5 * x.T @ (p - y) + w).max() < 1e-3 and abs((p - y).sum()) < 1e-3


@pytest.fixture(scope="module")
def xy():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1.0, 5.0, 0.1] + [0.0, 100.0, -3.0]
    return x, x @ [2.0, -1.0, 4.0] + 7 + rng.normal(size=400)


@pytest.fixture(scope="module")
def rows(spark, xy):
    x, y = xy
    df = spark.createDataFrame([(i, *map(float, r), float(t), Vectors.dense(r)) for i, (r, t) in enumerate(zip(x, y))],
                               ["id", "a", "b", "c", "y", "features"])
    return split.kfold(df, "id").withColumn("split", F.lit("train")).cache()


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)


@pytest.mark.parametrize("alpha", [0.0, 1.0, 50.0])
def test_ridge_mapping_and_gram_form(rows, xy, alpha):
    x, y = xy
    facts = models.target_facts(rows, "y")
    fitted = (models.ridge(facts, alpha) if alpha else models.linear(facts)).fit(rows)
    assert fitted.coefficients.toArray() == pytest.approx(closed_form(x, y, alpha), rel=1e-6)
    z = (x - x.mean(0)) / x.std(0)
    found = gram.fit(gram.grams(rows, ["a", "b", "c"], "y")[None], alpha)
    assert found.coefficients * x.std(0) == pytest.approx(closed_form(z, y, alpha), rel=1e-8)


def test_elastic_net_meets_its_optimality_conditions(rows, xy):
    x, y = xy
    alpha, share = 0.3, 0.5
    n, xc, yc = len(y), x - x.mean(0), y - y.mean()
    for w in (models.elastic_net(models.target_facts(rows, "y"), alpha, share).fit(rows).coefficients.toArray(),
              gram.fit(gram.grams(rows, ["a", "b", "c"], "y")[None], alpha, share, scale=False).coefficients):
        g = -xc.T @ (yc - xc @ w) / n + alpha * (1 - share) * w
        for gj, wj in zip(g, w):
            assert (abs(gj) <= alpha * share + 1e-3) if wj == 0 else gj == pytest.approx(-alpha * share * np.sign(wj), abs=1e-3)


def test_fold_sums_give_the_same_scores_as_refitting(spark, rows):
    features = ["a", "b", "c"]
    grams = tune.fold_grams(rows, features, "y")
    fast = {r["fold"]: r for r in tune.linear_fold_errors(rows, grams, "ridge", {"alpha": 2.0}, "y").collect()}
    sums = {(r["fold"], r["metric"]): r["value"] for r in tune.linear_scores(spark, grams, "ridge", [{"alpha": 2.0}]).collect()}

    def fit(train):
        found = gram.fit(gram.grams(train, features, "y")[None], 2.0)
        return lambda df: df.withColumn("prediction", found.predict())

    sizes = []
    slow = tune.cross_validate(rows, {"ridge": lambda t: (sizes.append(t.count()), fit(t))[1]},
                               lambda d: evaluate.regression_metrics(d, "y", "prediction")).collect()
    assert sizes == [320] * 5
    for r in slow:
        assert fast[r["fold"]][r["metric"]] == pytest.approx(r["value"], rel=1e-8)
        if r["metric"] != "mae":
            assert sums[(r["fold"], r["metric"])] == pytest.approx(r["value"], rel=1e-8)


def test_grid_search_takes_the_first_of_equals_and_refits(rows):
    def make(setting):
        def fit(train):
            found = gram.fit(gram.grams(train, ["a"], "y")[None], setting["alpha"])
            return lambda df: df.withColumn("prediction", found.predict())
        return fit

    table, best, model = tune.grid_search(rows, "ridge", make, {"same": [1, 2], "alpha": [0.0, 1e6]},
                                          lambda d: evaluate.regression_metrics(d, "y", "prediction"), "r2")
    assert best == {"same": 1, "alpha": 0.0} and [r["rank"] for r in table.orderBy("rank").collect()] == [1, 2, 3, 4]
    assert "prediction" in model(rows).columns


def test_nomination_skips_twins_and_fixed_models(spark):
    cv = spark.createDataFrame([(m, {}, 1, "r2", v, None) for m, v in (("lin", .9), ("poly", .9), ("ridge", .8), ("tree", .7), ("knn", .6))], tune.SCORES)
    rows = {r["model"]: r for r in tune.nominate(cv, [("lin", "poly")], ["poly", "ridge", "tree", "knn"], "r2").collect()}
    assert [m for m in rows if rows[m]["nominated"]] == ["ridge", "tree"]
    assert rows["lin"]["status"] == "nothing to tune" and rows["poly"]["status"] == "repeats lin"


def test_search_spaces():
    sizes = {k: len(tune.candidates(v)) for k, v in tune.REGRESSION_SPACES.items()}
    assert sizes["ridge"] == 25 and sizes["boosting"] == 72 and sizes["elastic_net"] == 54
    assert len(tune.candidates(tune.CLASSIFICATION_SPACES["logistic"])) == 12 and len(tune.candidates(tune.CLASSIFICATION_SPACES["svc"])) == 16


def test_tree_models_by_properties(rows):
    error = {}
    for depth in (2, 6):
        fitted = models.tree_regressor(max_depth=depth).fit(rows)
        error[depth] = evaluate.regression_metrics(fitted.transform(rows), "y", "prediction").first()["rmse"]
        assert fitted.facts()["depth"] <= depth
        assert trees.importances(fitted.nodes, 3).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert error[6] < error[2]


def test_fourier_features_approximate_the_kernel(spark):
    a, b = np.array([0.1, 0.5]), np.array([0.4, -0.2])
    df = spark.createDataFrame([(Vectors.dense(a),), (Vectors.dense(b),)], ["features"])
    x, y = (r["kernel_features"].toArray() for r in models.RandomFourierFeatures(gamma=0.7, components=4000).transform(df).collect())
    assert x @ y == pytest.approx(np.exp(-0.7 * ((a - b) ** 2).sum()), abs=0.05)


# ---------------------------------------------------------------- neighbours

def brute_neighbours(q, t, k, metric):
    out = []
    for x in q:
        d = {"euclidean": np.sqrt(((t - x) ** 2).sum(1)), "manhattan": np.abs(t - x).sum(1), "chebyshev": np.abs(t - x).max(1)}.get(metric)
        if d is None:
            nx, nt = np.linalg.norm(x), np.linalg.norm(t, axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                d = 1 - np.where((nt * nx) > 0, (t @ x) / (nt * nx), 0.0)
        d = np.round(d, 10)
        out.append(list(np.lexsort((np.arange(len(t)), d))[:k]))
    return out


@pytest.mark.parametrize("metric", knn.METRICS)
def test_neighbours_equal_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "QUERIES_PER_TASK", 15)
    rng = np.random.default_rng(7)
    t = np.round(rng.normal(size=(300, 4)), 1)
    t[:100] = t[0]   # copies: a third of the rows are one point
    t[100:103] = 0.0
    q = np.vstack([np.round(rng.normal(size=(38, 4)), 1), t[:1], np.zeros((1, 4))])
    parts = lambda m: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], "id long, x array<double>").select(
        "id", *knn.dense_parts("x"), F.col("id").cast("string").alias("payload"))
    found = knn.neighbours(parts(q), parts(t), 5, metric).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    for i, expected in enumerate(brute_neighbours(q, t, 5, metric)):
        a = np.round([r["distance"] for r in got[i]], 8)
        ref = brute_neighbours(q[i: i + 1], t, 5, metric)[0]
        assert len(got[i]) == 5 and [r["train_id"] for r in got[i]] == ref or np.allclose(
            a, np.round(sorted(_distance(q[i], t[j], metric) for j in ref), 8))
        assert all(r["payload"] == str(r["train_id"]) for r in got[i])


def _distance(a, b, metric):
    if metric == "cosine":
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return 1 - (a @ b / n if n else 0.0)
    d = np.abs(a - b)
    return {"euclidean": np.sqrt((d * d).sum()), "manhattan": d.sum(), "chebyshev": d.max()}[metric]


def test_sparse_rows_and_fewer_rows_than_k(spark):
    schema = "id long, w struct<indices:array<int>,values:array<double>>"
    train = spark.createDataFrame([(0, ([0], [1.0])), (1, ([], [])), (2, ([1], [1.0]))], schema)
    query = spark.createDataFrame([(9, ([2], [1.0]))], schema)
    found = knn.neighbours(query.select("id", *knn.sparse_parts("w")),
                           train.select("id", *knn.sparse_parts("w"), F.lit("p").alias("payload")), 5, "euclidean", 3)
    rows = found.orderBy("rank").collect()
    # The empty row is nearer (1) than rows sharing nothing (sqrt 2).
    assert [r["train_id"] for r in rows] == [1, 0, 2] and rows[0]["distance"] == pytest.approx(1.0)


def test_votes(spark):
    found = spark.createDataFrame([(1, 1, 10, 0.0, "2"), (1, 2, 11, 1.0, "4"), (2, 1, 10, 1.0, "2"), (2, 2, 11, 2.0, "4")],
                                  "query_id long, rank int, train_id long, distance double, payload string")
    assert {r["query_id"]: r["prediction"] for r in knn.knn_regress(found).collect()} == {1: 3.0, 2: 3.0}
    weighted = {r["query_id"]: r["prediction"] for r in knn.knn_regress(found, "distance").collect()}
    assert weighted == pytest.approx({1: 2.0, 2: (2 + 4 / 2) / 1.5})
    assert {r["query_id"]: r["prediction"] for r in knn.knn_classify(found).collect()} == {1: "2", 2: "2"}


def test_gaussian_nb_matches_the_formula(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (60, 3)), rng.normal(1, 2, (90, 3))])
    y = np.array([0] * 60 + [1] * 90)
    df = spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y)], "x array<double>, y int")
    model = bayes.fit_gaussian_nb(df, "x", "y", 1e-3, split=None)
    eps = 1e-3 * x.var(axis=0).max()
    score = np.array([np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + eps))
                      + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + eps)).sum(1) for c in (0, 1)]).T
    rows = model.transform(df, "x").collect()
    assert [r["prediction"] for r in rows] == score.argmax(1).tolist()
    p = np.exp(score - score.max(1, keepdims=True))
    assert np.array([r["probability"] for r in rows]) == pytest.approx(p / p.sum(1, keepdims=True))


def test_whole_text_pipeline(spark):
    texts = [(f"not good {i} food", N) if i % 3 == 0 else (f"good tasty {i % 5} food", POS) for i in range(60)]
    df = models.label_index(spark.createDataFrame(texts, "text string, label string"), "label", N).withColumn("split", F.lit("train"))
    fitted = models.classification_pipeline(models.logistic(60), "text", 50, user={"n": "CAST(length(text) AS DOUBLE)"}).fit(df)

    def line(scored):
        scored, _ = evaluate.positive_scores(scored)
        named = scored.withColumn("said", F.when(F.col("prediction") == 1.0, N).otherwise(POS))
        return evaluate.classification_metrics(named, "label", "said", "score")

    table = evaluate.test_results({"logistic": fitted}, df, line, "weighted_f1")
    assert table.columns[:3] == ["rank", "model", "accuracy"] and table.first()["accuracy"] == 1.0


def test_recall_of_a_chosen_class(spark):
    df = frame(spark, [N, N, N, POS], [N, POS, N, N], [1, 0, 1, 1])
    assert evaluate.class_recall(df, "actual", "predicted", N).first()["recall"] == pytest.approx(2 / 3)
    assert evaluate.class_recall(df, "actual", "predicted", POS).first()["recall"] == 0.0


def test_regression_catalogue(spark):
    from fieldloom.operators import features

    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(a), "Yes" if b else "No", float(3 * a + 2 * b + rng.normal() / 10), "train")
                                for a, b in zip(rng.normal(size=200), rng.random(200) < 0.5)], "a double, k string, y double, split string")
    ready = features.TabularPreprocessor(numeric=["a"], categorical=["k"]).fit(df).transform(df)
    facts = models.target_facts(ready, "y")
    catalogue = models.regression_catalogue(facts, gamma=0.5)
    assert len(catalogue) == 9 and len(models.classification_catalogue(10)) == 4
    fitted = {name: catalogue[name].fit(ready) for name in ("linear", "polynomial", "tree", "svr")}
    table = evaluate.test_results(fitted, ready, lambda d: evaluate.regression_metrics(d, "y", "prediction"), "r2").collect()
    assert [r["rank"] for r in table] == [1, 2, 3, 4] and min(r["r2"] for r in table) > 0.95
    pipeline = models.regression_pipeline(models.linear(facts), ["a"], ["k"], user={"a2": "a * a"})
    assert pipeline.fit(df).transform(df).count() == 200
    assert models.feature_names(ready) == ["a", "k_Yes"]


def test_preparation_is_learned_within_each_fold(rows):
    learned, scored = [], []

    def prepare(own):
        centre = own.agg(F.avg("a")).first()[0]
        learned.append((own.count(), centre))
        return lambda df: df.withColumn("x", F.col("a") - F.lit(centre))

    def make(setting):
        def fit(own):
            scored.append(own.agg(F.avg("x")).first()[0])
            return lambda df: df.withColumn("prediction", F.lit(setting["value"]))
        return fit

    _, best, model = tune.grid_search(rows, "constant", make, {"value": [0.0, -90.0]}, lambda d: evaluate.regression_metrics(d, "y", "prediction"),
                                      "rmse", prepare=prepare)
    # Once per fold for both candidates, on 320 of 400 rows, and once more on all rows for the refit.
    assert sorted(n for n, _ in learned) == [320] * 5 + [400] and len({c for _, c in learned}) == 6
    assert np.abs(scored).max() < 1e-9 and "x" in model(rows).columns


def test_depths_beyond_the_limit_are_no_silent_clamp():
    assert models.tree_depth(None) == 30 and models.tree_depth(None, 12) == 12
    with pytest.raises(ValueError):
        models.tree_classifier(max_depth=31)
    space = models.buildable(tune.CLASSIFICATION_SPACES["tree"])
    assert space["max_depth"] == [5, 10, 20, 30] and len(tune.candidates(space)) == 32


def test_coordinate_descent_says_when_it_did_not_settle():
    with pytest.raises(RuntimeError):
        gram._coordinate_descent(np.array([[1.0, 0.999], [0.999, 1.0]]), np.array([1.0, 0.5]), 0.0, 0.0, limit=2)


def test_wide_and_narrow_sums_of_products_agree(rows, monkeypatch):
    narrow = gram.grams(rows, ["a", "b", "c"], "y", "fold")
    whole = gram.grams(rows, ["a", "b", "c"], "y")
    monkeypatch.setattr(gram, "MAX_SUM_COLUMNS", 0)
    wide = gram.grams(rows, ["a", "b", "c"], "y", "fold")
    assert set(wide) == set(narrow) == {1, 2, 3, 4, 5}
    for f in wide:
        assert wide[f].products == pytest.approx(narrow[f].products, rel=1e-9, abs=1e-6)
    assert gram.grams(rows, ["a", "b", "c"], "y")[None].products == pytest.approx(whole[None].products, rel=1e-9, abs=1e-6)


def test_approximate_neighbours_find_most(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8)) * 10
    points = (centres[:, None, :] + rng.normal(size=(40, 20, 8)) * 0.3).reshape(-1, 8)
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["id", "features"])
    got = knn.approximate_neighbours(df.where("id % 20 = 0"), df.where("id % 20 > 0"), 5, radius=4.0, bucket=4.0).collect()
    hits = 0
    for q in range(0, len(points), 20):
        d = np.linalg.norm(points - points[q], axis=1)
        want = [i for i in np.argsort(d, kind="stable") if i % 20][:5]
        hits += len(set(want) & {r["train_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 200


@pytest.mark.parametrize("metric", knn.METRICS)
def test_neighbours_are_found_in_bounded_memory(metric):
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    rng = np.random.default_rng(1)
    frame = lambda n, at: pd.DataFrame({"id": np.arange(at, at + n), "ix": [None] * n, "vx": list(rng.normal(size=(n, 16))), "payload": ["p"] * n})
    block = lambda f: SimpleNamespace(payloads=f["payload"].to_list(), **dict(zip(("ids", "lens", "ixs", "vxs"), knn._pack(f))))
    ids, rows, payloads = knn._block([block(frame(4_096, 0))], metric, 16)
    queries = frame(3_000, 10_000)
    tracemalloc.start()
    found = knn._nearest_in_block([block(queries)], ids, rows, payloads, 5, metric, 16)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 15_000 and most < 80e6  # a matrix of all distances takes 98 MB, all differences 16 times that


def test_kernel_ridge_equals_the_closed_form_and_moves_no_features(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3))
    y = np.sin(x[:, 0]) * 5 + x[:, 1] + 100
    df = spark.createDataFrame([("train", Vectors.dense(r.tolist()), float(v)) for r, v in zip(x, y)], ["split", "features", "y"]).repartition(3)
    rff = models.RandomFourierFeatures(gamma=0.3, components=20)
    got = models.kernel_ridge(df, rff, 2.0)(df).toPandas()
    z = rff.projection()(np.vstack([v.toArray() for v in got.features]))
    c, t = z - z.mean(axis=0), got.y - got.y.mean()
    w = np.linalg.solve(c.T @ c + 2 * np.eye(20), c.T @ t)
    assert got.prediction.to_numpy() == pytest.approx(c @ w + got.y.mean())
    with pytest.raises(ValueError, match="no training rows"):
        models.kernel_ridge(df.where("false"), rff)


def test_statistics_of_text_trees_leave_room_in_a_task():
    assert models.tree_classifier().getOrDefault("maxMemoryInMB") <= 256
