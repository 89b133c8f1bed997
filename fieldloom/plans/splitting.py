"""Strata, splits, folds and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.operators import split
from fieldloom.operators.duplicates import drop_duplicates as first_rows
from fieldloom.plans.registry import query, round_columns, table
from fieldloom.session import materialise

PRICE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
KEY = ["l_orderkey", "l_linenumber"]
ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]

# SQL: order lines without repeats, with an id and the target.
LINES_SQL = f"""lines AS (SELECT *, l_orderkey * 10 + l_linenumber AS id, {PRICE} AS y FROM
 (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) = 1))"""


def quantile_bins_sql(source: str, column: str, bins: int) -> str:
    edges = ", ".join(str(k / bins) for k in range(1, bins))
    return f"""edges AS (SELECT list_distinct(quantile_cont({column}::DOUBLE, [{edges}])) AS e, min({column}) AS lo, max({column}) AS hi FROM {source}),
binned AS (SELECT *, CAST(len(list_filter(e, lambda x: x < {column} AND x > lo AND x < hi)) AS BIGINT) AS bin FROM {source}, edges)"""


def split_sql(source: str, stratum: str, name: str = "split_rows") -> str:
    """Largest-remainder quotas of ceil(0.2 n) rows, then the first rows of each stratum by hash."""
    return f"""{name}_q AS (SELECT s, c, floor(t * c / n) + (row_number() OVER (ORDER BY round(t * c / n - floor(t * c / n), 9) DESC, s)
   <= t - sum(floor(t * c / n)) OVER ())::INT AS quota FROM
   (SELECT {stratum} AS s, count(*) AS c, sum(count(*)) OVER ()::DOUBLE AS n, ceil(sum(count(*)) OVER () * 0.2::DOUBLE - 1e-9) AS t FROM {source} GROUP BY 1)),
{name} AS (SELECT x.*, CASE WHEN row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42|' || id)) <= quota THEN 'test' ELSE 'train' END AS split
   FROM {source} x JOIN {name}_q ON s = {stratum})"""


def kfold_sql(source: str, partition: str = "", name: str = "folded") -> str:
    return f"{name} AS (SELECT *, CAST(ntile(5) OVER ({partition} ORDER BY md5('42|' || id)) AS INT) AS fold FROM {source})"


def lines(spark, sf_dir):
    """Order lines without repeats, with the row id, its place in hash order and the target."""
    df = table(spark, sf_dir, "lineitem").select(
        *KEY, "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    return materialise(first_rows(df, KEY, ORDER).withColumns({
        "id": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "y": F.expr(PRICE)}).withColumn("id_hash", split.stored_hash("id")).drop("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"))


# SQL: labelled documents; the rare class is the positive class of the metrics.
REVIEWS_SQL = """reviews AS (SELECT doc_id AS id, text, lang, source, CASE WHEN quality = 0 THEN 'negative' ELSE 'positive' END AS label
 FROM documents JOIN labels USING (doc_id))"""


def reviews(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").alias("id"), "text", "lang", "source",
        F.when(F.col("quality") == 0, "negative").otherwise("positive").alias("label"))


_SPLIT = f"WITH {LINES_SQL}, {quantile_bins_sql('lines', 'y', 10)}, {split_sql('binned', 'bin')}"


def ids_differ(df):
    """Whether the ids of ``lines`` tell its rows apart for sure: a row a key, no key NULL, the line number one digit. One pass, no grouping."""
    digit = F.col("l_linenumber").between(0, 9) & F.col("id").isNotNull()
    return df.where(~F.coalesce(digit, F.lit(False))).isEmpty()


def split_lines(spark, sf_dir):
    df = lines(spark, sf_dir)
    return split.split_on_target(df, "id", "y", checked=ids_differ(df), hashed="id_hash")


@query(f"WITH {LINES_SQL}, {quantile_bins_sql('lines', 'y', 10)} SELECT id, bin FROM binned")
def quantile_bins(spark, sf_dir):
    return split.quantile_bins(lines(spark, sf_dir), "y", 10).select("id", "bin")


@query(f"WITH src AS (SELECT event_id AS id, floor(\"value\" / 100) AS v FROM events), {quantile_bins_sql('src', 'v', 10)} SELECT id, bin FROM binned")
def quantile_bins_merged(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.floor(F.col("value") / 100).cast("double").alias("v"))
    return split.quantile_bins(df, "v", 10).select("id", "bin")


@query(f"{_SPLIT} SELECT id, split FROM split_rows")
def stratified_split(spark, sf_dir):
    return split_lines(spark, sf_dir).select("id", "split")


@query(f"WITH src AS (SELECT o_orderkey AS id, 0 AS one FROM orders), {split_sql('src', 'one')} SELECT id, split FROM split_rows")
def plain_split(spark, sf_dir):
    return split.split_on_target(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice"),
                                 "id", "o_totalprice", None).select("id", "split")


@query(f"WITH {REVIEWS_SQL}, {split_sql('reviews', 'label')} SELECT id, split FROM split_rows")
def class_split(spark, sf_dir):
    return split.train_test_split(reviews(spark, sf_dir), "id", "label").select("id", "split")


@query(f"WITH src AS (SELECT o_orderkey AS id FROM orders), {kfold_sql('src')} SELECT id, fold FROM folded")
def kfold(spark, sf_dir):
    return split.kfold(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), "id")


@query(f"WITH src AS (SELECT event_id AS id, event_type FROM events), {kfold_sql('src', 'PARTITION BY event_type')} SELECT id, fold FROM folded")
def stratified_kfold(spark, sf_dir):
    return split.kfold(table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type"), "id",
                       stratum="event_type").select("id", "fold")


@query(f"""{_SPLIT}, c AS (SELECT bin, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM split_rows GROUP BY bin)
SELECT bin AS stratum, a AS n_train, b AS n_test, round(a / (sum(a) OVER ())::DOUBLE, 6) AS share_train,
 round(b / (sum(b) OVER ())::DOUBLE, 6) AS share_test FROM c""")
def split_balance(spark, sf_dir):
    binned = split.quantile_bins(lines(spark, sf_dir), "y", 10)
    return round_columns(split.split_balance(split.train_test_split(binned, "id", "bin"), "bin"), ["share_train", "share_test"])


@query(f"""{_SPLIT} SELECT split, count(y) AS n, round(avg(y), 4) AS mean, round(stddev_samp(y), 4) AS std, round(min(y), 4) AS "min",
 round(max(y), 4) AS "max" FROM split_rows GROUP BY split""")
def split_target_summary(spark, sf_dir):
    return round_columns(split.target_summary(split_lines(spark, sf_dir), "y"), ["mean", "std", "min", "max"], 4)


@query(f"""{_SPLIT}, f AS (SELECT l_quantity, l_discount, l_tax, l_returnflag, split FROM split_rows),
hit AS (SELECT * FROM f WHERE split = 'test' AND (l_quantity, l_discount, l_tax, l_returnflag) IN
 (SELECT (l_quantity, l_discount, l_tax, l_returnflag) FROM f WHERE split = 'train'))
SELECT count(*) AS test_rows, (SELECT count(*) FROM hit) AS test_rows_seen_in_train,
 round_even(100.0::DOUBLE * (SELECT count(*) FROM hit) / count(*), 2) AS pct_test_rows_seen_in_train FROM f WHERE split = 'test'""")
def row_overlap(spark, sf_dir):
    return split.row_overlap(split_lines(spark, sf_dir), ["l_quantity", "l_discount", "l_tax", "l_returnflag"])


@query(rf"""WITH {REVIEWS_SQL}, {split_sql('reviews', 'label')},
f AS (SELECT lower(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS t, split FROM split_rows),
hit AS (SELECT * FROM f WHERE split = 'test' AND t IN (SELECT t FROM f WHERE split = 'train'))
SELECT count(*) AS test_rows, (SELECT count(*) FROM hit) AS test_rows_seen_in_train,
 round_even(100.0::DOUBLE * (SELECT count(*) FROM hit) / count(*), 2) AS pct_test_rows_seen_in_train FROM f WHERE split = 'test'""")
def text_overlap(spark, sf_dir):
    return split.text_overlap(split.train_test_split(reviews(spark, sf_dir), "id", "label"), "text")


@query(f"{_SPLIT} SELECT count(*) AS n_shared FROM (SELECT id FROM split_rows GROUP BY id HAVING count(DISTINCT split) > 1)")
def disjoint_check(spark, sf_dir):
    return split.id_overlap(split_lines(spark, sf_dir), "id")


@query(f"""{_SPLIT} SELECT split, count(*) AS n, CAST(sum(('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT) AS VARCHAR) AS sum_a,
 CAST(sum(('0x' || substr(md5(id::VARCHAR), 9, 8))::BIGINT) AS VARCHAR) AS sum_b FROM split_rows GROUP BY split""")
def split_fingerprint(spark, sf_dir):
    return split.split_fingerprint(split_lines(spark, sf_dir), "id")
