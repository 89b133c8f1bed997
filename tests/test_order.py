import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import order


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    skewed = np.round(rng.exponential(10, 3000), 1)
    skewed[:1000] = 7.0  # one value holds a third of all rows
    return skewed


@pytest.fixture(scope="module")
def frame(spark, values):
    return spark.createDataFrame([(i % 3 == 0, float(v), None if i % 10 == 0 else float(v)) for i, v in enumerate(values)],
                                 "third boolean, v double, holes double")


PROBS = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)


def test_quantiles_of_short_columns(frame, values):
    got = order.exact_quantiles(frame, {"v": PROBS, "holes": PROBS})
    assert got["v"] == pytest.approx(np.quantile(values, PROBS))
    kept = [v for i, v in enumerate(values) if i % 10]
    assert got["holes"] == pytest.approx(np.quantile(kept, PROBS))


@pytest.mark.parametrize("accuracy", [20, 100])
def test_quantiles_through_brackets_and_running_totals(frame, values, monkeypatch, accuracy):
    monkeypatch.setattr(order, "WINDOW_ROWS", 50)
    got = order.exact_quantiles(frame, {"v": PROBS}, accuracy=accuracy)
    assert got["v"] == pytest.approx(np.quantile(values, PROBS))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert order.exact_quantiles(empty, {"v": (0.5,)}) == {"v": [None]}


def test_grouped_quantiles(frame, values):
    got = {r["third"]: r for r in order.grouped_quantiles(frame, ["third"], "v", {"median": 0.5, "p90": 0.9}).collect()}
    for flag in (True, False):
        part = [v for i, v in enumerate(values) if (i % 3 == 0) == flag]
        assert got[flag]["median"] == pytest.approx(np.quantile(part, 0.5))
        assert got[flag]["p90"] == pytest.approx(np.quantile(part, 0.9))


def test_running_totals_do_not_depend_on_partitions(spark, frame):
    counts = frame.groupBy("third", "v").agg(F.count("*").alias("n"))
    results = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = order.running_totals(counts, "v", ["n"], ["third"]).collect()
        results.append(sorted((r["third"], r["v"], r["n"], r["n_before"]) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
    for flag in (True, False):
        seen = 0
        for third, _, n, before in results[0]:
            if third == flag:
                assert before == seen
                seen += n


def test_average_ranks(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,), (None,)], "v double")
    assert {r["v"]: r["avg_rank"] for r in order.average_ranks(df, "v").collect()} == {1.0: 1.0, 2.0: 2.5, 5.0: 4.0}


def test_top_and_bottom(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "k string, v double")
    rows = order.top_and_bottom(df, "v", "k", 1).collect()
    assert [(r["k"], r["direction"]) for r in rows] == [("b", "top"), ("a", "bottom")]
