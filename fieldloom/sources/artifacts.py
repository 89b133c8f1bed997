"""Result tables, split tables, fitted models and manifests on storage."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.evaluate import largest_difference

RUN_MODES = ("full", "dev")


def suffix(mode: str | None = None) -> str:
    """'' for reported runs, '_dev' for quick ones, so that the two are never mixed up."""
    mode = (mode or os.environ.get("FIELDLOOM_MODE", "full")).strip().lower()
    if mode not in RUN_MODES:
        raise ValueError(f"run mode must be one of {RUN_MODES}, got {mode!r}")
    return "" if mode == "full" else "_dev"


def save_table(df: DataFrame, root: str, name: str, mode: str | None = None) -> str:
    """A result table (a few rows) as one CSV file with a header."""
    path = f"{root}/{name}{suffix(mode)}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stored result table under ``schema``; without one every column is text, since nothing is guessed from the cells."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def save_search(table: DataFrame, root: str, name: str, mode: str | None = None) -> str:
    """Grid-search details; the setting is written as JSON text."""
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in table.schema]
    return save_table(table.select(*flat), root, f"{name}_grid", mode)


def save_split(df: DataFrame, path: str, key: str, stratum: Sequence[str] = ()) -> None:
    """(id, split[, fold]) as a Parquet table; ids are never gathered."""
    columns = [key, "split", *(["fold"] if "fold" in df.columns else []), *stratum]
    df.select(*columns).write.mode("overwrite").parquet(path)


def read_split(df: DataFrame, path: str, key: str) -> DataFrame:
    """Attach a stored split; rows the split does not know are left out."""
    return df.join(df.sparkSession.read.parquet(path), key)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def reload_difference(model: PipelineModel, path: str, rows: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """Largest difference between the predictions of a model and of its stored copy."""
    fresh = model.transform(rows).select(key, F.col(prediction).alias("value"))
    stored = load_model(path).transform(rows).select(key, F.col(prediction).alias("value"))
    return largest_difference(stored, fresh, [key])


def refit_difference(fit, train: DataFrame, rows: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """Largest difference between two independent fits on the same training rows."""
    a = fit(train).transform(rows).select(key, F.col(prediction).alias("value"))
    b = fit(train).transform(rows).select(key, F.col(prediction).alias("value"))
    return largest_difference(a, b, [key])


def write_manifest(
    spark: SparkSession, path: str, run: Mapping[str, str], fingerprint: str, models: Mapping[str, Mapping]
) -> None:
    """Run settings, split fingerprint and per model its parameters and metrics, as JSON lines."""
    rows = [(dict(run), fingerprint, name, {k: str(v) for k, v in m.get("params", {}).items()},
             {k: float(v) for k, v in m.get("metrics", {}).items()}) for name, m in models.items()]
    spark.createDataFrame(
        rows, "run map<string,string>, split_fingerprint string, model string, params map<string,string>, metrics map<string,double>",
    ).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "run map<string,string>, split_fingerprint string, model string, params map<string,string>, metrics map<string,double>").json(path)
