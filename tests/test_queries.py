"""Every registered query against its SQL twin on the smallest tables.

FIELDLOOM_QUICK=1 runs a selection; ``python -m tests.oracle`` does the same at any scale. The
corpus queries have tests of their own in tests/llm.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUICK = ["column_audit", "describe", "outliers", "spearman_matrix", "drop_duplicates", "cleaning_steps", "stratified_split", "kfold",
         "tfidf_model", "classification_metrics", "ols", "grid_search", "knn_classify_cosine"]
LIBRARY = [n for n in entry.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUICK if os.environ.get("FIELDLOOM_QUICK") else LIBRARY)
def test_query_equals_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) is None


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["r2"] > 0.98
