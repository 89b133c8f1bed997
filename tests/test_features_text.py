import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.functions import text as X
from fieldloom.operators import features as P
from fieldloom.operators import tfidf


def test_scaler_learns_from_train_only(spark):
    rng = np.random.default_rng(0)
    rows = [(float(v), "c", "train") for v in rng.normal(0, 1, 500)] + [(float(v), "c", "test") for v in rng.normal(100, 1, 200)]
    df = spark.createDataFrame(rows, "x double, k string, split string")
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    model = P.TabularPreprocessor(numeric=["x"], categorical=["k"]).fit(train)
    mean = lambda d: model.transform(d).agg(F.avg(vector_to_array("features")[0])).first()[0]
    assert abs(mean(train)) < 1e-9 and mean(test) > 50
    with pytest.raises(P.LeakageError):
        P.TabularPreprocessor(numeric=["x"]).fit(df)


def test_fill_encode_and_reload(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "Yes", "a"), (2.0, "No", "b"), (float("nan"), None, "it's"), (10.0, "No", "a"), (3.0, "No", None)],
                               "x double, yes string, k string")
    model = P.TabularPreprocessor(numeric=["x"], categorical=["yes", "k"], scale=False, splitCol="").fit(df)
    new = spark.createDataFrame([(None, "Yes", "unseen"), (5.0, None, "it's")], "x double, yes string, k string")
    # Median 2.5; Yes = 1 in the only column of a two-level category; unknown levels set nothing.
    expected = [[2.5, 1.0, 0.0, 0.0, 0.0], [5.0, 0.0, 0.0, 0.0, 1.0]]
    assert [r["features"].toArray().tolist() for r in model.transform(new).collect()] == expected
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "m"))
    assert [r["features"].toArray().tolist() for r in again.transform(new).collect()] == expected


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    known = P.learn(df, ["x"], split=None)
    assert [r[0] for r in df.select(known.standardised("x")).collect()] == [0.0, 0.0]


def test_polynomial_sizes():
    names = list("abcde")
    assert [len(P.polynomial_terms(names, d)) for d in (1, 2, 3)] == [5, 20, 55]
    assert len(P.polynomial_terms(names, 2, interaction_only=True)) == 15


def test_user_columns(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "selected")], "a double, s string")
    assert P.UserColumns().transform(df).columns == ["a", "s"]
    step = P.UserColumns(expressions={"a_x2": "2 * a", "both": "a_x2 + a", "flag": "s = 'select'"})
    assert [(r["a_x2"], r["both"], r["flag"]) for r in step.transform(df).collect()] == [(2.0, 3.0, False), (4.0, 6.0, False)]
    step.write().overwrite().save(str(tmp_path / "u"))
    assert P.UserColumns.load(str(tmp_path / "u")).transform(df).columns == ["a", "s", "a_x2", "both", "flag"]


@pytest.mark.parametrize("text", ["a - avg(a) OVER ()", "explode(array(a))", "sum(a)", "(SELECT 1)", "nowhere + 1"])
def test_user_columns_must_be_row_wise(spark, text):
    with pytest.raises(ValueError):
        P.UserColumns(expressions={"b": text}).transform(spark.createDataFrame([(1.0,)], "a double"))


def test_user_columns_must_be_new(spark):
    with pytest.raises(ValueError):
        P.UserColumns(expressions={"a": "2 * a"}).transform(spark.createDataFrame([(1.0,)], "a double"))


def test_levels_of_any_type_and_spelling(spark):
    df = spark.createDataFrame([(1, "St. A"), (2, "b`c"), (3, "St. A"), (None, None)], "n int, place string")
    out = P.TabularPreprocessor(categorical=["n", "place"], splitCol="").fit(df).transform(df)
    assert [r["features"].toArray().tolist() for r in out.collect()] == [[1, 0, 0, 0], [0, 1, 0, 1], [0, 0, 1, 0], [1, 0, 0, 0]]


def test_rows_must_be_known_to_be_training_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    with pytest.raises(P.LeakageError):
        P.learn(df, ["x"])
    assert P.learn(df, ["x"], split=None).medians == {"x": 1.5}


def test_numbers_with_type_suffixes_are_text(spark):
    texts = ["5", " 5.5 ", "5d", "1F", "2L", "1e3", "-.5", "5.", "inf", "nan", "0x1", "", None, "1_0"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.to_number("t")).collect()]
    assert got == [5.0, 5.5, None, None, None, 1000.0, -0.5, 5.0, math.inf, None, None, None, None, None]


def test_scalars(spark):
    df = spark.createDataFrame([("12 Reviews , 3 Followers", "\tN/A ", "Rated 4/5"), ("1 Review", "ok", "5 stars, 16 tables"), (None, None, "5stars6")],
                               "meta string, m string, t string")
    rows = df.select(S.integer_before("meta", "Review").alias("r"), S.integer_before("meta", "Follower").alias("f"),
                     S.is_missing_marker("m").alias("m"), S.states_rating("t").alias("s"), S.word_count("t").alias("w")).collect()
    assert [r["r"] for r in rows] == [12.0, 1.0, None] and [r["f"] for r in rows] == [3.0, None, None]
    assert [r["m"] for r in rows] == [True, False, None] and [r["s"] for r in rows] == [True, True, False]
    long = spark.createDataFrame([("x" * 61,), ("y" * 60,)], "s string").select(S.clip_example("s").alias("s")).collect()
    assert long[0]["s"] == "x" * 57 + "..." and long[1]["s"] == "y" * 60


def test_tokens_and_counts(spark):
    df = spark.createDataFrame([("Café a b ﬁne CAFÉ",), ("x",), ("",), (None,)], "t string")
    got = tfidf.with_terms(df, "t").select("terms").collect()
    assert got[0]["terms"] == ["cafe", "fine", "cafe", "cafe fine", "fine cafe"]
    assert got[1]["terms"] == got[2]["terms"] == got[3]["terms"] == []
    counts = {r["term"]: r["tf"] for r in tfidf.term_frequencies(tfidf.with_terms(df, "t")).collect()}
    assert counts == {"cafe": 2, "fine": 1, "cafe fine": 1, "fine cafe": 1}
    assert X.TOKEN_PATTERN


TEXTS = ["not good at all", "no taste", "good food", "good food good", "not good no taste"]


def numpy_tfidf(texts):
    docs = [t.split() + [f"{a} {b}" for a, b in zip(t.split(), t.split()[1:])] for t in texts]
    vocab = sorted({t for d in docs for t in d if sum(t in e for e in docs) >= 2})
    idf = {t: math.log((1 + len(docs)) / (1 + sum(t in e for e in docs))) + 1 for t in vocab}
    out = []
    for d in docs:
        w = {t: (1 + math.log(d.count(t))) * idf[t] for t in vocab if t in d}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.append({t: v / norm for t, v in w.items()} if norm else {})
    return vocab, out


def test_tfidf_equals_the_formula_and_keeps_negations(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    vocab, expected = numpy_tfidf(TEXTS)
    model = tfidf.Tfidf(maxFeatures=100, splitCol="").fit(df)
    assert model.getOrDefault("vocabulary") == vocab and {"not", "no"} <= set(vocab)
    for r in model.transform(df).collect():
        got = {vocab[i]: v for i, v in zip(r["features"].indices, r["features"].values)}
        assert got == pytest.approx(expected[r["id"]])
    model.write().overwrite().save(str(tmp_path / "tfidf"))
    again = tfidf.TfidfModel.load(str(tmp_path / "tfidf"))
    assert [r["features"] for r in again.transform(df).orderBy("id").collect()] == [r["features"] for r in model.transform(df).orderBy("id").collect()]
    terms = tfidf.with_terms(df, "text")
    long = tfidf.weights_long(terms, tfidf.vocabulary(terms, None), "id").collect()
    assert {(r["id"], r["term"]): r["weight"] for r in long} == pytest.approx({(i, t): w for i, d in enumerate(expected) for t, w in d.items()})


def test_vocabulary_cap_breaks_ties_by_term(spark):
    df = spark.createDataFrame([("bb aa cc",), ("bb aa cc",)], "text string")
    rows = tfidf.vocabulary(tfidf.with_terms(df, "text", ngrams=1), 2).collect()
    assert sorted(r["term"] for r in rows) == ["aa", "bb"]


def test_dense_guard():
    tfidf.check_dense(1000, 1000)
    with pytest.raises(MemoryError):
        tfidf.check_dense(1_000_000, 5000)


def test_folding_takes_no_batches_of_whole_texts(spark):
    from pyspark.sql import functions as F

    from fieldloom.functions.text import fold_accents

    texts = ["plain ascii", "Crème Brûlée", "ﬁne ½ 한국", "", None, "é ́"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    folded = df.select("i", fold_accents("t").alias("t"))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    marks = lambda t: None if t is None else "".join(c for c in __import__("unicodedata").normalize("NFKD", t) if not __import__("unicodedata").combining(c))
    assert {r["i"]: r["t"] for r in folded.collect()} == {i: marks(t) for i, t in enumerate(texts)}
    assert folded.where(F.col("i") == 0).first()["t"] == "plain ascii"


def test_norm_of_a_text_is_summed_once(spark):
    """Merged into the division, the norm would be summed again for each weight of the text."""
    df = spark.createDataFrame([(1, "red green blue red"), (2, "green tea"), (3, "x")], "id long, text string")
    weights = tfidf.TfidfModel(vocabulary=["blue", "green", "red"], idf=[2.0, 1.0, 2.0], ngrams=1).weights(df)
    assert "/ sqrt" not in weights._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r["id"]: (list(r["_weights"]["indices"]), list(r["_weights"]["values"])) for r in weights.collect()}
    raw = [2.0, 1.0, 2.0 * (1 + math.log(2))]
    assert got[1][0] == [0, 1, 2] and got[1][1] == pytest.approx([v / math.hypot(*raw) for v in raw])
    assert got[2] == ([1], [1.0]) and got[3] == ([], [])


def test_no_nested_lambda_is_an_argument_of_the_vector_function(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    plan = tfidf.Tfidf(maxFeatures=100, splitCol="").fit(df).transform(df).select("features")._jdf.queryExecution().executedPlan().toString()
    calls = [line for line in plan.splitlines() if "_sparse(" in line]
    assert len(calls) == 1 and "ArrowEvalPython" in calls[0] and "lambda" not in calls[0]
