"""Imputation, scaling, encoding, polynomial and engineered columns, weights."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldloom.operators import features as P
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import LINES_SQL, quantile_bins_sql, split_sql, split_lines
from fieldloom.session import materialise

SPLIT_SQL = f"{LINES_SQL}, {quantile_bins_sql('lines', 'y', 10)}, {split_sql('binned', 'bin')}"

# Cells (not rows) are blanked by a rule on another column, so that there is something to fill.
_HOLES = """holes AS (SELECT id, split, CASE WHEN l_tax > 0.065 THEN NULL ELSE l_quantity END AS quantity,
 CASE WHEN l_discount < 0.015 THEN NULL ELSE l_extendedprice END AS price, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS flag,
 l_linestatus AS status FROM split_rows)"""


def _holes(spark, sf_dir):
    hole = lambda blank, c: F.when(~blank, F.col(c))
    return materialise(split_lines(spark, sf_dir).select(
        "id", "split", hole(F.col("l_tax") > 0.065, "l_quantity").alias("quantity"), hole(F.col("l_discount") < 0.015, "l_extendedprice").alias("price"),
        hole(F.col("l_linenumber") == 3, "l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")))


def _train(df):
    return df.where(F.col("split") == "train")


_FILL = f"""{SPLIT_SQL}, {_HOLES}, m AS (SELECT quantile_cont(quantity::DOUBLE, 0.5) AS mq, quantile_cont(price::DOUBLE, 0.5) AS mp FROM holes WHERE split = 'train'),
f AS (SELECT flag AS mf FROM holes WHERE split = 'train' AND flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
filled AS (SELECT id, split, coalesce(quantity, mq) AS quantity, coalesce(price, mp) AS price, coalesce(flag, mf) AS flag, status FROM holes, m, f)"""


@query(f"WITH {_FILL} SELECT id, quantity, round(price, 4) AS price, flag FROM filled")
def impute(spark, sf_dir):
    df = _holes(spark, sf_dir)
    known = P.learn(_train(df), ["quantity", "price"], ["flag"])
    return round_columns(P.impute(df, known).select("id", "quantity", "price", "flag"), ["price"], 4)


@query("SELECT l_returnflag AS \"value\", count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1")
def most_frequent(spark, sf_dir):
    return P.most_frequent(table(spark, sf_dir, "lineitem"), "l_returnflag")


_SCALED = f"""{_FILL}, s AS (SELECT avg(quantity) AS aq, stddev_pop(quantity) AS sq, avg(price) AS ap, stddev_pop(price) AS sp FROM filled WHERE split = 'train')"""


@query(f"WITH {_SCALED} SELECT id, round((quantity - aq) / sq, 6) + 0.0 AS quantity, round((price - ap) / sp, 6) + 0.0 AS price FROM filled, s")
def standardize(spark, sf_dir):
    df = _holes(spark, sf_dir)
    known = P.learn(_train(df), ["quantity", "price"])
    return df.select("id", rounded(known.standardised("quantity")).alias("quantity"), rounded(known.standardised("price")).alias("price"))


@query(f"""WITH {_FILL} SELECT id, (flag = 'A')::DOUBLE AS "flag_A", (flag = 'N')::DOUBLE AS "flag_N", (flag = 'R')::DOUBLE AS "flag_R",
 (status = 'O')::DOUBLE AS "status_O" FROM filled""")
def one_hot(spark, sf_dir):
    df = _holes(spark, sf_dir)
    known = P.learn(_train(df), [], ["flag", "status"])
    return df.select("id", *[c.alias(n) for n, c in known.columns()])


@query(f"""WITH {_SCALED} SELECT id, round((quantity - aq) / sq, 6) + 0.0 AS x0, round((price - ap) / sp, 6) + 0.0 AS x1,
 (flag = 'A')::DOUBLE AS x2, (flag = 'N')::DOUBLE AS x3, (flag = 'R')::DOUBLE AS x4, (status = 'O')::DOUBLE AS x5 FROM filled, s""")
def assembled_features(spark, sf_dir):
    """The fitted pipeline stage: fill, scale, encode, assemble."""
    df = _holes(spark, sf_dir)
    model = P.TabularPreprocessor(numeric=["quantity", "price"], categorical=["flag", "status"]).fit(_train(df))
    v = vector_to_array("features")
    return model.transform(df).select("id", *[rounded(v[i]).alias(f"x{i}") for i in range(6)])


@query("""SELECT l_orderkey, l_linenumber, round(l_discount, 6) AS a, round(l_tax, 6) AS b, round(l_quantity, 6) AS c,
 round(l_discount * l_discount, 6) AS aa, round(l_discount * l_tax, 6) AS ab, round(l_discount * l_quantity, 6) AS ac,
 round(l_tax * l_tax, 6) AS bb, round(l_tax * l_quantity, 6) AS bc, round(l_quantity * l_quantity, 6) AS cc FROM lineitem""")
def poly_features(spark, sf_dir):
    df, names = P.polynomial(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("a"), F.col("l_tax").alias("b"), F.col("l_quantity").alias("c")),
        ["a", "b", "c"], 2)
    return df.select("l_orderkey", "l_linenumber", *[rounded(n).alias(n.replace(" ", "")) for n in names])


@query("""SELECT l_orderkey, l_linenumber, round(l_discount * l_tax, 6) AS ab, round(l_discount * l_quantity, 6) AS ac,
 round(l_tax * l_quantity, 6) AS bc, round(l_discount * l_tax * l_quantity, 6) AS abc FROM lineitem""")
def poly_interactions(spark, sf_dir):
    df, names = P.polynomial(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("a"), F.col("l_tax").alias("b"), F.col("l_quantity").alias("c")),
        ["a", "b", "c"], 3, interaction_only=True)
    return df.select("l_orderkey", "l_linenumber", *[rounded(n).alias(n.replace(" ", "")) for n in names if " " in n])


@query("""WITH m AS (SELECT max(abs(l_quantity)) AS q, max(abs(l_tax)) AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price, round(l_quantity / q, 6) AS quantity, round(l_tax / t, 6) AS tax FROM lineitem, m""")
def engineered_features(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    made = P.UserColumns(expressions={"unit_price": "l_extendedprice / l_quantity"}).transform(df)
    scaled = P.max_abs_scaled(df, ["l_quantity", "l_tax"], split=None)
    return made.select("l_orderkey", "l_linenumber", "unit_price",
                       rounded(scaled["l_quantity"]).alias("quantity"), rounded(scaled["l_tax"]).alias("tax"))


@query(f"""WITH {SPLIT_SQL} SELECT 'l_quantity' AS "column", round(avg(l_quantity) FILTER (split = 'train'), 4) AS train_mean,
 round(avg(l_quantity), 4) AS full_mean, round(avg(l_quantity) FILTER (split = 'train'), 4) AS learned_mean,
 round(stddev_pop(l_quantity) FILTER (split = 'train'), 4) AS learned_std FROM split_rows
UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice) FILTER (split = 'train'), 4),
 round(avg(l_extendedprice), 4), round(avg(l_extendedprice) FILTER (split = 'train'), 4),
 round(stddev_pop(l_extendedprice) FILTER (split = 'train'), 4) FROM split_rows""")
def learned_stats(spark, sf_dir):
    df = split_lines(spark, sf_dir)
    known = P.learn(_train(df), ["l_quantity", "l_extendedprice"])
    return round_columns(P.learned_statistics(df, _train(df), known), ["train_mean", "full_mean", "learned_mean", "learned_std"], 4)


@query("""WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)::DOUBLE, 6) AS weight FROM c""")
def class_weights(spark, sf_dir):
    return round_columns(P.class_weights(table(spark, sf_dir, "labels"), "quality"), ["weight"])
