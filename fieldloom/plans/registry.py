"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero, for comparison with another engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def round_columns(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[rounded(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])
