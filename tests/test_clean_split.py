import math

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.operators import clean, duplicates, split


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame([(r,) for r in ["1", "1.5", "2", "2.5", "3", "3.5", "4", "4.5", "5", "Like", None]], "rating string")


def test_label_rule(ratings):
    rows = clean.derive_label(ratings, "rating").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in rows} == {"negative": 3, "positive": 3, None: 5}


def test_label_report_names_every_outcome(ratings):
    report = {r["raw_value"]: r["outcome"] for r in clean.label_report(ratings, "rating").collect()}
    assert report["<missing>"] == S.OUTCOME_MISSING and report["Like"] == S.OUTCOME_NON_NUMERIC
    assert report["2.5"] == report["3"] == report["3.5"] == S.OUTCOME_MIDDLE
    assert report["2"] == "negative" and report["4"] == "positive"


def test_cleaning_counts_and_result(spark):
    rows = [(1, "a", "x", "good", "5"), (2, "a", "x", "good", "4"), (3, "a", "x", None, "5"), (4, "b", "y", "bad", "1"),
            (5, "b", "y", "so so", "3"), (6, "c", None, "fine", "5"), (7, "c", None, "fine", "5")]
    df = spark.createDataFrame(rows, "id int, place string, who string, review string, rating string").withColumn("7514", F.lit(None).cast("string"))
    cleaned, steps = clean.clean_labelled_text(df, "review", "rating", ["place", "who", "review"], ["id"], ["7514"])
    assert [(r["rows"], r["removed"]) for r in steps.orderBy("step").collect()] == [(7, 0), (6, 1), (5, 1), (3, 2)]
    assert sorted(r["id"] for r in cleaned.collect()) == [1, 4, 6] and "7514" not in cleaned.columns


def test_duplicates_treat_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None, "p"), (2, None, "q"), (3, "a", "p"), (4, "a", "p"), (5, "b", "p")], "id int, k string, v string")
    report = duplicates.duplicate_report(df, {"k": ["k"], "all": None}).collect()
    assert [r["n_duplicates"] for r in report] == [2, 0]
    assert sorted(r["id"] for r in duplicates.duplicate_members(df, ["k"]).collect()) == [1, 2, 3, 4]
    assert sorted(r["id"] for r in duplicates.drop_duplicates(df, ["k"], ["id"]).collect()) == [1, 3, 5]
    differing = {r["column"]: r["n_groups_differing"] for r in duplicates.differing_columns(df, ["k"]).collect()}
    assert differing == {"id": 2, "v": 1}
    line = duplicates.drop_duplicates_report(df, duplicates.drop_duplicates(df, ["k"], ["id"]), ["k"]).first()
    assert (line["rows_before"], line["duplicates_removed"], line["rows_after"], line["duplicates_remaining_under_key"]) == (5, 2, 3, 0)


def test_first_row_needs_an_order(spark):
    with pytest.raises(ValueError):
        duplicates.drop_duplicates(spark.createDataFrame([(1, 2)], "a int, b int"), ["a"])


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame([(i, "negative" if i < 300 else "positive", float(i % 97)) for i in range(1000)], "id long, label string, y double")


def test_stratified_split_keeps_class_shares(classes):
    rows = split.train_test_split(classes, "id", "label").collect()
    for side, size in (("train", 800), ("test", 200)):
        part = [r for r in rows if r["split"] == side]
        assert len(part) == size
        assert abs(sum(r["label"] == "negative" for r in part) / size - 0.3) <= 0.005


def test_split_is_reproducible_and_independent_of_layout(spark, classes):
    a = {r["id"]: r["split"] for r in split.split_on_target(classes, "id", "y").collect()}
    b = {r["id"]: r["split"] for r in split.split_on_target(classes.repartition(13), "id", "y").collect()}
    plain = {r["id"]: r["split"] for r in split.split_on_target(classes, "id", "y", None).collect()}
    assert a == b and a != plain
    assert sum(v == "test" for v in a.values()) == sum(v == "test" for v in plain.values()) == 200
    assert set(split.split_on_target(classes, "id", "y").columns) == {"id", "label", "y", "split"}


def test_split_through_several_prefix_rounds(classes, monkeypatch):
    expected = {r["id"]: r["split"] for r in split.train_test_split(classes, "id", "label").collect()}
    monkeypatch.setattr(split, "PREFIX", 1)
    monkeypatch.setattr(split, "WINDOW_ROWS", 2)
    assert {r["id"]: r["split"] for r in split.train_test_split(classes, "id", "label").collect()} == expected


@pytest.mark.parametrize("n", [10, 1003])
def test_fold_sizes(spark, n):
    df = spark.range(n)
    sizes = [r["count"] for r in split.kfold(df, "id").groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [n // 5 + (i < n % 5) for i in range(5)]


def test_quotas_follow_largest_remainders():
    assert split.test_quotas({"a": 5, "b": 5, "c": 3}) == {"a": 1, "b": 1, "c": 1}
    quota = split.test_quotas({"a": 6263, "b": 2428})
    assert sum(quota.values()) == math.ceil(0.2 * 8691) == 1739


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 2, 3, 4]], "v double")
    rows = split.quantile_bins(df, "v", 4).orderBy("v").collect()
    # Edges 1, 2, 2, 2.75, 4 merge to 1, 2, 2.75, 4.
    assert [r["bin"] for r in rows] == [0, 0, 0, 0, 2, 2]


def test_overlap_and_digest(spark):
    df = spark.createDataFrame([(1, "A ", "train"), (2, "a", "test"), (3, "b", "test")], "id long, t string, split string")
    row = split.text_overlap(df, "t").first()
    assert (row["test_rows"], row["test_rows_seen_in_train"], row["pct_test_rows_seen_in_train"]) == (2, 1, 50.0)
    assert split.row_overlap(df, ["t"]).first()["test_rows_seen_in_train"] == 0
    import hashlib

    assert split.id_list_digest(df, "id") == hashlib.sha256(b"2,3").hexdigest()
    with pytest.raises(ValueError):
        split.id_list_digest(df, "id", max_ids=1)


@pytest.mark.parametrize("ids", [[1, 2, None, 4], [1, 2, 2, 4]])
def test_row_keys_are_neither_null_nor_repeated(spark, ids):
    df = spark.createDataFrame([(i, "a") for i in ids], "id long, label string")
    for cut in (lambda d: split.train_test_split(d, "id", "label"), lambda d: split.kfold(d, "id", 2)):
        with pytest.raises(ValueError):
            cut(df)


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch):
    from fieldloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_first_rows_need_one_exchange_and_no_join(spark):
    from pyspark.sql import functions as F

    from fieldloom.operators import duplicates

    rows = [(1, 5, "b", None), (1, None, "c", 2.0), (1, None, "a", 1.0), (None, 3, "x", 0.0), (None, 3, "y", 0.0), (2, 1, "z", float("nan")), (2, 1, "z", float("nan"))]
    df = spark.createDataFrame(rows, "k int, o int, t string, v double").repartition(3)
    first = duplicates.drop_duplicates(df, ["k"], ["o"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and first.columns == df.columns
    digest = {r["t"]: r["h"] for r in df.select("t", F.xxhash64(F.struct(*df.columns)).alias("h")).collect()}
    kept = {r["k"]: (r["o"], r["t"]) for r in first.collect()}
    assert first.count() == 3 and kept == {1: (None, min("ac", key=digest.get)), None: (3, min("xy", key=digest.get)), 2: (1, "z")}
