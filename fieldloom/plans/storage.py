"""Tables, splits, searches, models and manifests written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from fieldloom.operators import evaluate, features, models, tune
from fieldloom.plans.modelling import NUMERIC, _OLS, _SCORE, _two_feature_fit, side
from fieldloom.plans.preparation import SPLIT_SQL
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import split_lines
from fieldloom.plans.tuning import TWO, _GRID, _ridge_scores, training_folds
from fieldloom.session import checkpoint_root, materialise
from fieldloom.sources import artifacts, tables
from fieldloom.sources.contracts import Contract


def folder(spark) -> str:
    return f"{checkpoint_root(spark)}/stored-{uuid.uuid4().hex}"


def _customers(spark, sf_dir):
    """The customers as CSV files, as many as the session deals rows to, and their contract: types, row count, checksum, roles."""
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = f"{folder(spark)}/customer"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, "c_custkey").write.option("header", True).option("escape", '"').csv(path)
    digest = tables.dataset_digest(tables.file_digests(spark, f"{path}/*.csv")).first()["sha256"]
    contract = Contract("customers", "customer", "regression", df.schema, df.count(), digest, "c_acctbal", numeric=("c_nationkey",),
                        categorical=("c_mktsegment",), excluded={"c_custkey": "identifier", "c_name": "name"})
    return path, contract


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    """Checksum, columns, row count and every cell's type are checked before a row is returned."""
    path, contract = _customers(spark, sf_dir)
    return tables.load_raw(spark, contract, f"{path}/*.csv")


@query("""SELECT 'customers' AS dataset, true AS sha256_matches_contract, count(*) AS "rows", CAST(5 AS BIGINT) AS "columns" FROM customer""")
def csv_provenance(spark, sf_dir):
    path, contract = _customers(spark, sf_dir)
    tables.write_provenance(spark, {f"{path}/*.csv": contract}, f"{path}-provenance")
    return spark.read.json(f"{path}-provenance").select("dataset", "sha256_matches_contract", "rows", "columns")


@query("""SELECT * FROM (VALUES (CAST(0 AS BIGINT), 'c_custkey', 'excluded', 'identifier'), (1, 'c_name', 'excluded', 'name'), (2, 'c_nationkey', 'numeric', ''),
 (3, 'c_acctbal', 'target', ''), (4, 'c_mktsegment', 'categorical', '')) t(position, "column", role, reason) WHERE EXISTS (SELECT 1 FROM customer)""")
def csv_roles(spark, sf_dir):
    path, contract = _customers(spark, sf_dir)
    return tables.column_roles(tables.load_raw(spark, contract, f"{path}/*.csv"), contract)


@query(f"WITH {SPLIT_SQL} SELECT id, split, l_quantity FROM split_rows")
def split_round_trip(spark, sf_dir):
    df, path = split_lines(spark, sf_dir), folder(spark)
    artifacts.save_split(df, path, "id")
    return artifacts.read_split(df.select("id", "l_quantity"), path, "id").select("id", "split", "l_quantity")


@query(f"""WITH {_ridge_scores(_GRID)}
SELECT CAST(row_number() OVER (ORDER BY round(avg(r2), 12) DESC, i) AS BIGINT) AS rank, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std FROM sc GROUP BY i""")
def search_round_trip(spark, sf_dir):
    """Details of the ridge grid, settings as JSON text, as one CSV file."""
    grams = tune.fold_grams(training_folds(spark, sf_dir, TWO), TWO, "y")
    scores = tune.linear_scores(spark, grams, "ridge", tune.candidates(tune.REGRESSION_SPACES["ridge"]))
    path = artifacts.save_search(tune.ranked_candidates(scores, "r2"), folder(spark), "ridge")
    stored = artifacts.read_table(spark, path, "model string, setting string, metric string, mean double, std double, train_mean double, params string, rank long")
    return stored.select("rank", rounded("mean").alias("mean"), rounded("std").alias("std"))


@query(f"""WITH {_OLS}, m AS (WITH {_SCORE}), l AS (UNPIVOT m ON r2, rmse, mae INTO NAME metric VALUE value)
SELECT 'least squares' AS model, 'all rows' AS fingerprint, metric, value FROM l""")
def manifest_round_trip(spark, sf_dir):
    df, fit = _two_feature_fit(spark, sf_dir)
    scores = evaluate.regression_metrics(side(df, "test").withColumn("p", fit.predict()), "y", "p")
    row = round_columns(round_columns(scores, ["r2"]), ["rmse", "mae"], 4).first().asDict()
    path = folder(spark)
    artifacts.write_manifest(spark, path, {"mode": "full"}, "all rows", {"least squares": {"params": {"alpha": 0}, "metrics": row}})
    return artifacts.read_manifest(spark, path).select("model", F.col("split_fingerprint").alias("fingerprint"), F.explode("metrics").alias("metric", "value"))


@query(f"""WITH {SPLIT_SQL} SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_unmatched, true AS same_after_reload, true AS same_after_refit FROM split_rows WHERE split = 'test'""")
def model_round_trip(spark, sf_dir):
    """A fitted pipeline against its stored copy and against a second fit: predictions differ by 1e-9 at most."""
    df = materialise(split_lines(spark, sf_dir).select("id", "split", "y", *NUMERIC, "l_linestatus"))
    train, test = side(df, "train"), side(df, "test")
    prepare = features.TabularPreprocessor(numeric=NUMERIC, categorical=["l_linestatus"])
    facts = models.target_facts(prepare.fit(train).transform(train), "y")
    pipeline = Pipeline(stages=[prepare, models.ridge(facts)])
    fitted, path = pipeline.fit(train), folder(spark)
    artifacts.save_model(fitted, path)
    stored = artifacts.reload_difference(fitted, path, test, "id")
    again = artifacts.refit_difference(pipeline.fit, train, test, "id")
    return test.agg(F.count("*").alias("n_scored")).select(
        "n_scored", stored.select("n_unmatched").scalar().alias("n_unmatched"),
        stored.select(F.col("max_difference") <= 1e-9).scalar().alias("same_after_reload"),
        again.select(F.col("max_difference") <= 1e-9).scalar().alias("same_after_refit"))


@query("SELECT CAST(0 AS BIGINT) AS n_unmatched, 0.0::DOUBLE AS max_difference FROM lineitem LIMIT 1")
def stored_metrics(spark, sf_dir):
    """Metrics of a result table as stored, against the same metrics computed again."""
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("y"), F.col("l_extendedprice").alias("p"))
    long = evaluate.regression_metrics(df, "y", "p", ["l_returnflag"]).unpivot("l_returnflag", ["r2", "rmse", "mae"], "metric", "value")
    path = artifacts.save_table(round_columns(long, ["value"]), folder(spark), "metrics")
    stored = artifacts.read_table(spark, path, "l_returnflag string, metric string, value double")
    return round_columns(evaluate.largest_difference(stored, round_columns(long, ["value"]), ["l_returnflag", "metric"]), ["max_difference"])
