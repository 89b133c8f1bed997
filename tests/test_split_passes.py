"""What the split, its folds and the fold sums read and compute, on rows of their own."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import duplicates, gram, split, tune
from fieldloom.plans import modelling, splitting, tuning


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame([(i, "negative" if i < 300 else "positive", float(i % 97)) for i in range(1000)], "id long, label string, y double")


def write_lines(spark, folder, keys):
    day = datetime.datetime(2024, 1, 1)
    rows = [(k, n, i, i % 7, day, float(i % 11 + 1), 100.0 + i * i % 89, i % 5 / 100, i % 3 / 100, "ANR"[i % 3], "OF"[i % 2]) for i, (k, n) in enumerate(keys)]
    spark.createDataFrame(rows, """l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double,
 l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string""").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def counted(monkeypatch, owner, name):
    calls, known = [], getattr(owner, name)

    def call(*args, **kwargs):
        calls.append(args)
        return known(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)
    return calls


def pairs_of(df, name):
    return {r["id"]: r[name] for r in df.select("id", name).collect()}


def test_cuts_are_compared_without_lambdas(classes):
    for df in (split.train_test_split(classes, "id", "label"), split.kfold(classes, "id"), split.kfold(classes, "id", stratum="label")):
        assert "lambda" not in df._jdf.queryExecution().executedPlan().toString()


def test_strata_of_uneven_numbers_of_cuts(classes):
    plan = lambda sizes: {"negative": [0, 100], "positive": [350]}
    cut = split._cut_by_hash(classes, "id", "label", 42, plan, "past")
    assert {(r["label"], r["past"]): r["count"] for r in cut.groupBy("label", "past").count().collect()} == {
        ("negative", 1): 100, ("negative", 2): 200, ("positive", 0): 350, ("positive", 1): 350}
    assert cut.columns == [*classes.columns, "past"]


@pytest.mark.parametrize("limit", [0, 1_000])
def test_stored_hash_gives_the_same_sides_and_folds(classes, monkeypatch, limit):
    plain = split.split_on_target(classes, "id", "y"), split.kfold(classes, "id"), split.kfold(classes, "id", 3, "label")
    expected = [pairs_of(df, df.columns[-1]) for df in plain]
    monkeypatch.setattr(split, "MAX_PREFIXES", limit)
    known = classes.withColumn("place", split.stored_hash("id"))
    again = (split.split_on_target(known, "id", "y", checked=True, hashed="place"), split.kfold(known, "id", checked=True, hashed="place"),
             split.kfold(known, "id", 3, "label", checked=True, hashed="place"))
    assert [pairs_of(df, df.columns[-1]) for df in again] == expected
    assert "md5" not in known.sparkSession.createDataFrame(known.limit(5).toArrow()).transform(
        lambda df: split.kfold(df, "id", 2, checked=True, hashed="place"))._jdf.queryExecution().executedPlan().toString()


def test_ids_of_one_digit_lines_are_not_grouped(spark, tmp_path, monkeypatch):
    grouped = counted(monkeypatch, split, "require_row_key")
    df = splitting.split_lines(spark, write_lines(spark, tmp_path, [(i // 4, i % 4) for i in range(200)] + [(3, 2), (3, 2)]))
    assert df.count() == 200 and not grouped and df.where(F.col("split") == "test").count() == 40


@pytest.mark.parametrize("keys", [[(1, 10), (2, 0), (3, 1)], [(1, 1), (2, None), (3, 1)], [(1, 1), (None, 2), (3, 1)]])
def test_other_ids_are_still_checked(spark, tmp_path, keys):
    with pytest.raises(ValueError):
        splitting.split_lines(spark, write_lines(spark, tmp_path, keys))


def test_whole_number_keys_travel_once(spark):
    df = spark.createDataFrame([(1, 5, "b", 0.0), (1, 4, "c", -0.0), (None, 3, "x", 1.0), (None, 2, "y", 1.0), (2, 1, "z", None)], "k int, o int, t string, v double")
    first = duplicates.drop_duplicates(df, ["k"], ["o"])
    assert "c0, t#" in first._jdf.queryExecution().analyzed().toString() and first.columns == df.columns
    assert sorted((r["k"] or 0, r["o"], r["t"]) for r in first.collect()) == [(0, 2, "y"), (1, 4, "c"), (2, 1, "z")]
    assert sorted(r["o"] for r in duplicates.drop_duplicates(df, ["v"], ["o"]).collect()) == [1, 2, 4]
    assert sorted((r["k"] or 0, r["o"]) for r in duplicates.drop_duplicates(df, ["k", "v"], ["k", "o"]).collect()) == [(0, 2), (1, 4), (2, 1)]


def test_sums_of_some_features_are_part_of_the_sums_of_all(spark):
    df = spark.createDataFrame([(i % 3, float(i), float(i * i % 7), float(i % 5), float(3 * i + i % 4)) for i in range(60)], "fold int, a double, b double, c double, y double")
    for fold, whole in gram.grams(df, ["a", "b", "c"], "y", "fold").items():
        own, part = gram.grams(df, ["c", "a"], "y", "fold")[fold], whole.only(["c", "a"])
        assert part.features == own.features and np.allclose(part.products, own.products) and np.allclose(part.shift, own.shift)
        assert np.allclose(gram.fit(part).coefficients, gram.fit(own).coefficients)


@pytest.mark.parametrize("query", [modelling.polynomial_regression, tuning.rank_agreement, tuning.nominate])
def test_models_share_one_pass_of_fold_sums(spark, tmp_path, monkeypatch, query):
    passes = counted(monkeypatch, tune, "fold_grams")
    rows = query(spark, write_lines(spark, tmp_path, [(i // 4, i % 4) for i in range(400)])).collect()
    assert len(passes) == 1 and len(rows) == (3 if query is modelling.polynomial_regression else 4)


@pytest.mark.parametrize("query", [tuning.grid_search, tuning.tuning_summary])
def test_folds_are_stored_with_the_columns_of_the_model(spark, tmp_path, monkeypatch, query):
    passes = counted(monkeypatch, tune, "fold_grams")
    query(spark, write_lines(spark, tmp_path, [(i // 4, i % 4) for i in range(400)])).collect()
    assert set(passes[0][0].columns) == {"split", "fold", "y", *tuning.TWO}
