"""Duplicates, labels, cleaning steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.operators import clean, duplicates
from fieldloom.plans.registry import query, round_columns, table

_KEY = ["l_orderkey", "l_linenumber"]
_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("""
SELECT 'order line' AS key, 'l_orderkey, l_linenumber' AS "columns", count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates FROM lineitem
UNION ALL SELECT 'with part', 'l_orderkey, l_linenumber, l_partkey', count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)) FROM lineitem
UNION ALL SELECT 'whole row', 'all columns', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) FROM lineitem""")
def duplicate_report(spark, sf_dir):
    return duplicates.duplicate_report(_lineitem(spark, sf_dir), {
        "order line": _KEY, "with part": [*_KEY, "l_partkey"], "whole row": None})


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) = 1""")
def drop_duplicates(spark, sf_dir):
    return duplicates.drop_duplicates(_lineitem(spark, sf_dir), _KEY, _ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""SELECT doc_id, lang, md5(text) AS digest FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def drop_duplicate_documents(spark, sf_dir):
    return duplicates.drop_duplicates(_documents(spark, sf_dir), ["text"], ["doc_id"]).select(
        "doc_id", "lang", F.md5("text").alias("digest"))


@query("""WITH d AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT 'l_orderkey, l_linenumber' AS key, count(*) AS rows_before, count(*) - n AS duplicates_removed, n AS rows_after,
 CAST(0 AS BIGINT) AS duplicates_remaining_under_key FROM lineitem, d GROUP BY n""")
def drop_duplicates_report(spark, sf_dir):
    df = _lineitem(spark, sf_dir)
    return duplicates.drop_duplicates_report(df, duplicates.drop_duplicates(df, _KEY, _ORDER), _KEY)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
def duplicate_members(spark, sf_dir):
    return duplicates.duplicate_members(_lineitem(spark, sf_dir), _KEY).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""WITH g AS (SELECT count(DISTINCT l_partkey) > 1 AS a, count(DISTINCT l_returnflag) > 1 AS b, count(DISTINCT l_tax) > 1 AS c
 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT 'l_partkey' AS "column", count(*) FILTER (a) AS n_groups_differing, count(*) AS n_groups FROM g
UNION ALL SELECT 'l_returnflag', count(*) FILTER (b), count(*) FROM g
UNION ALL SELECT 'l_tax', count(*) FILTER (c), count(*) FROM g""")
def differing_columns(spark, sf_dir):
    return duplicates.differing_columns(
        _lineitem(spark, sf_dir).select(*_KEY, "l_partkey", "l_returnflag", "l_tax"), _KEY)


@query("""WITH g AS (SELECT count(*) AS n, count(DISTINCT l_linestatus) > 1 AS conflict FROM lineitem
 GROUP BY l_quantity, l_discount, l_tax, l_returnflag)
SELECT count(*) AS n_combinations, count(*) FILTER (n > 1) AS n_repeated, CAST(sum(n - 1) AS BIGINT) AS n_repeat_rows,
 count(*) FILTER (conflict) AS n_conflicting FROM g""")
def conflicting_targets(spark, sf_dir):
    return duplicates.conflicting_targets(
        _lineitem(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "l_returnflag"], "l_linestatus")


@query(r"""WITH g AS (SELECT count(*) AS n, count(DISTINCT quality) > 1 AS mixed FROM documents JOIN labels USING (doc_id)
 GROUP BY lower(regexp_replace(text, '^\s+|\s+$', '', 'g')) HAVING count(*) > 1)
SELECT count(*) AS n_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) FILTER (mixed) AS n_groups_with_both_labels FROM g""")
def duplicate_texts(spark, sf_dir):
    df = _documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return duplicates.duplicate_texts(df, "text", "quality")


# ---------------------------------------------------------------- labels

# The digit at the start of the priority plays the rating. Cheap orders have none and dear ones keep
# the whole, unreadable text, some a digit with a type suffix, so that every outcome occurs; no row is left out.
_RATING = """CASE WHEN o_totalprice < 50000 THEN NULL WHEN o_totalprice > 350000 THEN o_orderpriority
 WHEN o_totalprice > 330000 THEN left(o_orderpriority, 1) || 'd' WHEN o_totalprice > 310000 THEN left(o_orderpriority, 1) || 'F' ELSE left(o_orderpriority, 1) END"""
_LABEL = "CASE WHEN try_cast(rating AS DOUBLE) >= 4 THEN 'positive' WHEN try_cast(rating AS DOUBLE) <= 2 THEN 'negative' END"


def _rated(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("rating", F.expr(_RATING))


@query(f"SELECT o_orderkey, {_LABEL} AS label FROM (SELECT *, {_RATING} AS rating FROM orders)")
def derive_label(spark, sf_dir):
    return clean.derive_label(_rated(spark, sf_dir), "rating").select("o_orderkey", "label")


@query(f"""SELECT coalesce(rating, '<missing>') AS raw_value, CASE WHEN rating IS NULL THEN 'dropped: missing rating'
 WHEN try_cast(rating AS DOUBLE) IS NULL THEN 'dropped: non-numeric rating'
 ELSE coalesce({_LABEL}, 'dropped: ambiguous middle rating') END AS outcome, count(*) AS n
 FROM (SELECT *, {_RATING} AS rating FROM orders) GROUP BY 1, 2""")
def label_report(spark, sf_dir):
    return clean.label_report(_rated(spark, sf_dir), "rating")


_POSTS = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, {_RATING} AS rating,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS post FROM orders)"""


def _posts(spark, sf_dir):
    return _rated(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "rating",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("post"))


@query(f"""WITH p AS (SELECT *, {_LABEL} AS label FROM {_POSTS}),
s AS (SELECT 0 AS step, 'raw table' AS description, count(*) AS r FROM p
 UNION ALL SELECT 1, 'drop rows without post', count(post) FROM p
 UNION ALL SELECT 2, 'keep rows with a label', count(*) FILTER (post IS NOT NULL AND label IS NOT NULL) FROM p
 UNION ALL SELECT 3, 'drop re-posts (o_custkey + post)', (SELECT count(*) FROM (SELECT DISTINCT o_custkey, post FROM p WHERE post IS NOT NULL AND label IS NOT NULL)) FROM (SELECT 1))
SELECT CAST(step AS BIGINT) AS step, description, r AS "rows", coalesce(lag(r) OVER (ORDER BY step) - r, 0) AS removed FROM s""")
def cleaning_steps(spark, sf_dir):
    return clean.clean_labelled_text(_posts(spark, sf_dir), "post", "rating", ["o_custkey", "post"], ["o_orderkey"], ["7514"])[1]


@query(f"""SELECT o_orderkey, o_custkey, post, rating, label FROM (SELECT *, {_LABEL} AS label FROM {_POSTS})
 WHERE post IS NOT NULL AND label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey, post ORDER BY o_orderkey) = 1""")
def cleaned_rows(spark, sf_dir):
    cleaned, _ = clean.clean_labelled_text(
        _posts(spark, sf_dir), "post", "rating", ["o_custkey", "post"], ["o_orderkey"], ["7514", "o_orderstatus"])
    return cleaned


@query(f"""WITH p AS (SELECT *, {_LABEL} AS label FROM (SELECT *, {_RATING} AS rating FROM orders)), k AS (SELECT * FROM p WHERE label IS NOT NULL),
g AS (SELECT avg((label = 'negative')::INT) AS s FROM k GROUP BY o_orderstatus)
SELECT (SELECT round(avg((CASE WHEN try_cast(rating AS DOUBLE) >= 4 THEN 'positive' ELSE 'negative' END = label)::INT), 6) FROM k) AS share_rederived,
 count(*) AS n_groups, round(min(s), 6) AS min_share, round(max(s), 6) AS max_share FROM g""")
def label_source_leakage(spark, sf_dir):
    df = clean.derive_label(_rated(spark, sf_dir), "rating").where(F.col("label").isNotNull())
    again = F.when(S.to_number("rating") >= S.POSITIVE_MIN, S.LABEL_POSITIVE).otherwise(S.LABEL_NEGATIVE)
    return round_columns(clean.label_source_leakage(df, again, "label", "o_orderstatus"),
                         ["share_rederived", "min_share", "max_share"])
