import hashlib
import json

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators import features, models
from fieldloom.sources import artifacts, tables
from fieldloom.sources.contracts import CAFE, CONTRACTS, REVIEWS, STUDENT, Contract, ContractError


@pytest.fixture
def small(spark, tmp_path):
    path = tmp_path / "small.csv"
    path.write_text('id,text,score\n1,"two\nlines, quoted ""word""",2.5\n2,plain,\n')
    return str(path), Contract(
        "small", "small.csv", "regression", T.StructType().add("id", T.IntegerType()).add("text", T.StringType()).add("score", T.DoubleType()), 2,
        hashlib.sha256(path.read_bytes()).hexdigest(), "score", numeric=("id",), text=("text",))


def test_typed_scan_with_quoted_line_breaks(spark, small):
    path, contract = small
    rows = tables.load_raw(spark, contract, path).orderBy("id").collect()
    assert rows[0]["text"] == 'two\nlines, quoted "word"' and rows[1]["score"] is None


@pytest.mark.parametrize("verify", [True, False])
def test_wrong_file_is_refused(spark, tmp_path, verify):
    path = tmp_path / "wrong.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ContractError):
        tables.load_raw(spark, STUDENT, str(path), verify)


def test_row_count_is_checked(spark, small):
    path, c = small
    other = Contract(c.key, c.filename, c.task, c.schema, 3, c.sha256)
    assert tables.violations(tables.scan_csv(spark, path, other), other) == ["rows: got 2, expected 3"]


def test_contracts_are_consistent():
    assert set(CONTRACTS) == {"student_performance", "restaurant_reviews", "cafe_sales"}
    assert [len(c.columns) for c in (STUDENT, REVIEWS, CAFE)] == [6, 8, 8]
    for c in (STUDENT, REVIEWS):
        assert not set(c.excluded) & set(c.feature_columns)
        assert "UNASSIGNED" not in [c.role(x) for x in c.columns]
    assert STUDENT.typed_schema()["Performance Index"].metadata["role"] == "target"


def test_roles_and_features(spark, small):
    path, contract = small
    df = tables.load_raw(spark, contract, path)
    assert [r["role"] for r in tables.column_roles(df, contract).orderBy("position").collect()] == ["numeric", "text", "target"]
    assert tables.feature_frame(df, contract).columns == ["id", "text"]
    with pytest.raises(ContractError):
        tables.column_roles(df.withColumn("extra", F.lit(1)), contract)


def test_provenance(spark, small, tmp_path):
    path, contract = small
    tables.write_provenance(spark, {path: contract}, str(tmp_path / "prov"))
    row = spark.read.json(str(tmp_path / "prov")).first()
    assert row["sha256_matches_contract"] and row["rows"] == 2 and row["columns"] == 3 and row["bytes"] > 0


def test_many_files_are_one_dataset(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    df = spark.createDataFrame([(i, f'line "{i}"\nand more') for i in range(40)], schema).repartition(5)
    df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "many"))
    path = f"{tmp_path}/many/*.csv"
    files = sorted((tmp_path / "many").glob("*.csv"))
    own = sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in files)
    whole = tables.dataset_digest(tables.file_digests(spark, path)).first()
    assert len(files) == 5 == whole["files"] and whole["sha256"] == hashlib.sha256("".join(own).encode()).hexdigest()
    contract = Contract("many", "many", "regression", schema, 40, whole["sha256"])
    assert sorted(map(tuple, tables.load_raw(spark, contract, path).collect())) == sorted(map(tuple, df.collect()))
    assert tables.provenance(spark, contract, path).first()["files"] == 5
    (tmp_path / "changed").mkdir()
    for i, f in enumerate(files):
        (tmp_path / "changed" / f.name).write_text(f.read_text().replace("id,note", "id,other" if i == 2 else "id,note"))
    with pytest.raises(ContractError, match="checksum.*headers: 2"):
        tables.load_raw(spark, contract, f"{tmp_path}/changed/*.csv")


def test_result_tables_and_run_mode(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 0.5)], "model string, r2 double")
    path = artifacts.save_table(df, str(tmp_path), "t", "dev")
    assert path.endswith("t_dev") and artifacts.read_table(spark, path, df.schema).collect() == df.collect()
    with pytest.raises(ValueError):
        artifacts.suffix("other")


def test_split_table_round_trip(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 2, "test").otherwise("train"))
    artifacts.save_split(df, str(tmp_path / "s"), "id")
    assert artifacts.read_split(spark.range(10), str(tmp_path / "s"), "id").where("split = 'test'").count() == 2


def test_saved_and_refitted_models_agree(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), float(i % 7), "Yes" if i % 2 else "No", 3.0 * i - i % 7) for i in range(100)],
                               "id long, a double, b double, k string, y double")
    pipeline = Pipeline(stages=[features.TabularPreprocessor(numeric=["a", "b"], categorical=["k"], splitCol=""),
                                models.linear({"p": 3})])
    model = pipeline.fit(df)
    artifacts.save_model(model, str(tmp_path / "m"))
    row = artifacts.reload_difference(model, str(tmp_path / "m"), df, "id").first()
    assert row["n_unmatched"] == 0 and row["max_difference"] <= 1e-9
    assert artifacts.refit_difference(pipeline.fit, df, df, "id").first()["max_difference"] <= 1e-9
    artifacts.write_manifest(spark, str(tmp_path / "manifest"), {"seed": "42"}, "abc", {"linear": {"params": {"alpha": 0}, "metrics": {"r2": 1.0}}})
    assert artifacts.read_manifest(spark, str(tmp_path / "manifest")).first()["metrics"] == {"r2": 1.0}
    assert json.loads(next((tmp_path / "manifest").glob("part-*")).read_text())["split_fingerprint"] == "abc"


def test_stream_scoring(spark, tmp_path):
    from fieldloom.streaming import score_stream

    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "a double, y double")
    model = Pipeline(stages=[features.TabularPreprocessor(numeric=["a"], splitCol=""), models.linear({"p": 1})]).fit(df)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = score_stream(stream, model).select("y", "prediction").writeStream.format("memory").queryName("scored").option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    rows = spark.table("scored").collect()
    assert len(rows) == 20 and all(abs(r["y"] - r["prediction"]) < 1e-6 for r in rows)
    with pytest.raises(ValueError):
        score_stream(df, model)


def test_malformed_cells_are_named(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,score\n1,2.5\noops,Like\n3,4.0\n")
    contract = Contract("bad", "bad.csv", "regression", T.StructType([T.StructField("id", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    with pytest.raises(ContractError, match="oops"):
        tables.load_raw(spark, contract, str(path), verify_checksum=False)
    path.write_text("id,score\n1,2.5\n,\n3,4.0\n")
    assert [tuple(r) for r in tables.load_raw(spark, contract, str(path), verify_checksum=False).collect()] == [(1, 2.5), (None, None), (3, 4.0)]
